"""Queries over layout-shaped inputs, made from the tables by fixed rules, and the SQL that states their results."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leafmill import schemas
from leafmill.config import Config
from leafmill.functions import geometry, text
from leafmill.operators import figures, layout, paragraphs, tables
from leafmill.plans.catalog import query, table
from leafmill.streaming import lifecycle


def order_layout(spark, sf_dir):
    """One document a customer: each order is a paragraph and a word, some are tables and figures."""
    i = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    o = table(spark, sf_dir, "orders").withColumn("i", i).withColumn("k", F.col("o_orderkey")).withColumn("page", (F.col("o_orderkey") % 2 + 1).cast("int"))
    k, at = F.col("k"), F.col("i")
    span = F.struct((at * 100).cast("int").alias("offset"), F.lit(50).alias("length"))
    box = lambda page, x: F.struct(page.cast("int").alias("page_number"), F.transform(F.array(x, x, x + 2, x, x + 2, x + 1, x, x + 1), lambda v: v.cast("double")).alias("polygon"))
    regions = F.when(k % 11 > 0, F.when(k % 7 == 0, F.array(box(F.col("page"), at), box(F.lit(3), at))).otherwise(F.array(box(F.col("page"), at))))
    words = F.struct("o_orderstatus", ((50 + k % 50) / 100).alias("confidence"), F.struct((at * 100).cast("int").alias("offset"), F.lit(5).alias("length")))
    paragraph = F.struct(F.when(k % 5 == 0, "pageHeader").alias("role"), F.concat(F.lit("Order "), k.cast("string")).alias("content"), F.array(span).alias("spans"), regions.alias("bounding_regions"))
    places = F.when(k % 9 > 0, F.array(box(F.col("page"), at)))
    figure = F.struct(F.when(k % 8 > 0, F.concat(F.lit("f"), k.cast("string"))).alias("id"), F.struct(F.when(k % 3 == 0, "See it").alias("content")).alias("caption"), F.array(box(F.lit(1), at), box(F.lit(1), at + 1), box(F.lit(2), at)).alias("bounding_regions"))
    listed = lambda c, when=F.lit(True): F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("i", c.alias("x"))))), lambda x: x["x"])
    one = F.struct(F.lit(1).alias("row_count"), F.lit(1).alias("column_count"), F.struct(F.lit("").alias("content")).alias("caption"), F.array(span).alias("spans"), places.alias("bounding_regions"), F.expr("CAST(NULL AS " + schemas.TABLES.partition("cells ")[2][:-2] + ")").alias("cells"))
    page = lambda n: F.struct(F.lit(n).alias("page_number"), F.lit(8.5).alias("width"), F.lit(11.0).alias("height"), F.lit("inch").alias("unit"), F.lit(0.0).alias("angle"), listed(words, F.col("page") == n).alias("words"))
    made = o.groupBy(F.col("o_custkey").cast("string").alias("doc_id")).agg(F.array(page(1), page(2)).alias("pages"), listed(paragraph).alias("paragraphs"), listed(one, k % 3 == 0).alias("tables"), listed(figure, k % 4 == 0).alias("figures"))
    return made.select("doc_id", F.lit("").alias("content"), F.col("pages").cast(schemas.PAGES), F.col("paragraphs").cast(schemas.PARAGRAPHS), F.col("tables").cast(schemas.TABLES), F.col("figures").cast(schemas.FIGURES))


ORDERS = "o AS (SELECT o_custkey::VARCHAR AS doc_id, o_orderkey AS k, o_orderkey % 2 + 1 AS page, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)"
BOXES = f"""{ORDERS}, b AS (
  SELECT doc_id, i AS ord, CASE WHEN k % 5 = 0 THEN 'pageHeader' ELSE 'paragraph' END AS role, 'Order ' || k AS content, page, k FROM o WHERE k % 11 > 0
  UNION ALL SELECT doc_id, i, CASE WHEN k % 5 = 0 THEN 'pageHeader' ELSE 'paragraph' END, 'Order ' || k, 3, k FROM o WHERE k % 11 > 0 AND k % 7 = 0)"""


@query(f"WITH {ORDERS} SELECT doc_id, o_orderstatus AS content, (50 + k % 50) / 100.0::DOUBLE AS confidence, (i * 100)::INT AS start, (i * 100 + 5)::INT AS stop FROM o")
def layout_words(spark, sf_dir):
    return layout.words(order_layout(spark, sf_dir))


@query(f"WITH {BOXES} SELECT doc_id, ord::INT AS ord, role, content, page::INT AS page FROM b")
def layout_boxes(spark, sf_dir):
    return layout.bounding_boxes(order_layout(spark, sf_dir)).drop("polygon")


@query(f"WITH {BOXES} SELECT doc_id, page::INT AS page, string_agg(content, chr(10) ORDER BY ord) AS raw_content FROM b GROUP BY doc_id, page")
def layout_page_texts(spark, sf_dir):
    return layout.page_texts(layout.bounding_boxes(order_layout(spark, sf_dir)))


@query(f"""WITH {ORDERS}, t AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS table_index, CASE WHEN k % 9 = 0 THEN 1 ELSE page END AS page, k % 9 = 0 AS page_defaulted FROM o WHERE k % 3 = 0)
SELECT doc_id, table_index::INT AS table_index, page::INT AS page, page_defaulted, (row_number() OVER (PARTITION BY doc_id, page ORDER BY table_index) - 1)::INT AS local_index FROM t""")
def layout_tables(spark, sf_dir):
    return layout.tables(order_layout(spark, sf_dir)).select("doc_id", "table_index", "page", "page_defaulted", "local_index")


@query(f"""WITH {ORDERS}, f AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS n, k, i FROM o WHERE k % 4 = 0)
SELECT doc_id, n::INT AS figure_index, CASE WHEN k % 8 > 0 THEN 'f' || k ELSE 'fig-' || n END AS figure_id, page::INT AS page, i::DOUBLE AS x0 FROM f, (SELECT unnest([1, 2]) AS page)""")
def layout_figures(spark, sf_dir):
    return layout.figures(order_layout(spark, sf_dir)).select("doc_id", "figure_index", "figure_id", "page", F.get("polygon", F.lit(0)).alias("x0"))


@query(f"""WITH {BOXES}, f AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS n, k, i FROM o WHERE k % 4 = 0),
g AS (SELECT doc_id, n, k, i::DOUBLE AS x0, i + 2.0 AS x1, i::DOUBLE AS y0, i + 1.0 AS y1, page FROM f, (SELECT unnest([1, 2]) AS page)),
p AS (SELECT doc_id, page, role, content, ord::DOUBLE AS x0, ord + 2.0 AS x1, ord::DOUBLE AS y0, ord + 1.0 AS y1 FROM b),
h AS (SELECT g.doc_id, g.n, g.page, coalesce(max(greatest(0, least(g.x1, p.x1) - greatest(g.x0, p.x0)) * greatest(0, least(g.y1, p.y1) - greatest(g.y0, p.y0)) / 2), 0) AS over, any_value(k) AS k
  FROM g LEFT JOIN p ON g.doc_id = p.doc_id AND g.page = p.page AND p.role = 'pageHeader' GROUP BY 1, 2, 3)
SELECT doc_id, n::INT AS figure_index, page::INT AS page, CASE WHEN over >= 0.3 AND k % 3 > 0 THEN 'structural_noise' END AS rejection_reason, round(over, 6) AS header_overlap_ratio FROM h""")
def layout_qualified(spark, sf_dir):
    """Figures straight from the layout: page sizes, furniture and nearby texts are looked up in it. No order's text has a reference term, captions have one."""
    done = figures.qualified_layout(order_layout(spark, sf_dir))
    return done.select("doc_id", "figure_index", "page", "rejection_reason", F.round("header_overlap_ratio", 6).alias("header_overlap_ratio"))


@query("SELECT o_orderkey AS order_key, o_orderstatus AS status_now, o_totalprice AS html_price FROM orders")
def layout_keys(spark, sf_dir):
    nested = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderKey"), F.array(F.struct(F.col("o_orderstatus").alias("statusNow"), F.col("o_totalprice").alias("htmlPrice"))).alias("allOf"))
    flat = layout.normalized(layout.normalized(nested))
    return flat.select("order_key", F.explode("all_of").alias("x")).select("order_key", "x.status_now", "x.html_price")


# ---- the table path of both readers

PATH = """
n AS (SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, l_returnflag AS f, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY l_orderkey) AS m, first_value(l_returnflag) OVER (PARTITION BY l_orderkey, rn // 2 ORDER BY l_linenumber, l_partkey, l_suppkey) AS pair
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS rn FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
lay AS (SELECT *, CASE WHEN p % 4 = 3 THEN '' WHEN p % 4 = 0 THEN s::VARCHAR WHEN p % 4 = 2 THEN 'zz' ELSE 'p' || p END AS v1, (i + 1)::VARCHAR AS v2 FROM n),
chg AS (SELECT *, coalesce((pair <> lag(pair) OVER (PARTITION BY k ORDER BY i))::INT, 1) AS new FROM lay),
run AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY i) AS r FROM chg),
nrm AS (SELECT *, CASE WHEN count(*) OVER q > 1 AND count_if(v1 <> '') OVER q = 1 THEN max(v1) OVER q ELSE v1 END AS n1, v2 AS n2 FROM run WINDOW q AS (PARTITION BY k, r)),
occ AS (SELECT *, CASE WHEN p % 4 = 0 THEN f || ' ' || s WHEN p % 3 = 0 AND p % 5 > 0 THEN '' ELSE f END AS a0, CASE WHEN p % 2 = 0 THEN '' ELSE 'p' || p END AS a1, CASE WHEN p % 5 = 0 THEN '' ELSE (i + 1)::VARCHAR END AS a2 FROM nrm WHERE k % 3 > 0 AND k % 5 > 0 AND (k % 4 > 0 OR i = 0)),
f1 AS (SELECT *, CASE WHEN a1 = '' AND a0 <> '' AND v1 <> '' AND v1 <> a0 AND contains(a0, v1) THEN a0 ELSE a1 END AS b1 FROM occ),
f2 AS (SELECT *, CASE WHEN a2 = '' AND b1 <> '' AND v2 <> b1 AND contains(b1, v2) THEN b1 ELSE a2 END AS b2, i % 2 = 1 OR i + 1 < least(m, count(*) OVER (PARTITION BY k)) AS sp FROM f1),
dn AS (SELECT *, coalesce(last_value(CASE WHEN sp THEN pair WHEN a0 <> '' THEN a0 END IGNORE NULLS) OVER w, '') AS c0, coalesce(last_value(nullif(b1, '') IGNORE NULLS) OVER w, '') AS c1, coalesce(last_value(nullif(b2, '') IGNORE NULLS) OVER w, '') AS c2 FROM f2 WINDOW w AS (PARTITION BY k ORDER BY i)),
sz AS (SELECT k, max(m) AS m, CASE WHEN k % 4 > 0 THEN max(m) ELSE 1 END AS ocr FROM n GROUP BY k),
ch AS (SELECT k, m, CASE WHEN k % 3 > 0 AND k % 5 = 0 AND k % 11 = 0 THEN 'none' WHEN k % 3 > 0 AND k % 5 > 0 AND NOT (k % 13 = 0 OR k % 7 = 0 OR ocr / m < 0.6) THEN 'ocr' ELSE 'layout' END AS source,
  CASE WHEN k % 3 > 0 AND k % 5 = 0 AND k % 11 = 0 THEN 'image_artifact' WHEN k % 3 > 0 AND k % 5 > 0 AND (k % 13 = 0 OR k % 7 = 0 OR ocr / m < 0.6) THEN concat_ws(',', CASE WHEN ocr / m < 0.6 THEN 'row_count_mismatch' END, CASE WHEN k % 7 = 0 THEN 'multi_header' END) ELSE '' END AS flags FROM sz),
hd AS (SELECT k, source, flags, CASE WHEN k % 2 = 1 THEN 'order ' || k WHEN k % 7 = 0 THEN 'H0 / X | H1 | H2' ELSE 'H0 | H1 | H2' END AS label, CASE WHEN source = 'ocr' AND k % 6 <> 1 THEN ['A', 'B', 'C'] WHEN k % 7 = 0 THEN ['H0 / X', 'H1', 'H2'] ELSE ['H0', 'H1', 'H2'] END AS h FROM ch),
al AS (
  SELECT hd.k, i, source, h, label, c0, c1, c2, CASE WHEN (SELECT count_if(p % 5 > 0) FROM occ x WHERE x.k = hd.k) = 0 THEN 2 ELSE 3 END AS wide FROM dn JOIN hd ON dn.k = hd.k WHERE source = 'ocr'
  UNION ALL SELECT hd.k, i, source, h, label, pair, n1, n2, 3 FROM nrm JOIN hd ON nrm.k = hd.k WHERE source = 'layout')
"""


def two_readings(spark, sf_dir):
    """(layout tables, cells, paragraphs, confidence, markdown) of one table an order, read twice with differences. No row is blank throughout, as such a line parts headers from data."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    n = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_returnflag").alias("f"), (F.row_number().over(w) - 1).alias("i"), F.count("*").over(Window.partitionBy("l_orderkey")).cast("int").alias("m"))
    k, p, i, none = F.col("k"), F.col("p"), F.col("i"), F.array().cast("array<double>")
    keys = n.select("k").distinct()
    caption = F.when(k % 2 == 1, F.concat(F.lit("order "), k.cast("string"))).otherwise("")
    t = keys.select(k.alias("doc_id"), F.lit(0).alias("table_index"), F.lit(1).alias("page"), F.lit(0).alias("local_index"), caption.alias("caption"), F.lit(0).alias("start"))
    cell = lambda kind, row, col, span, content: F.struct(F.lit(kind).alias("kind"), row.cast("int").alias("row"), F.lit(col).alias("col"), span.cast("int").alias("row_span"), content.cast("string").alias("content"))
    one = F.lit(1)
    heads = keys.select("k", F.lit(99).alias("m"), F.explode(F.filter(F.array(*[cell("columnHeader", F.lit(0), c, one, F.lit(f"H{c}")) for c in range(3)], F.when(k % 7 == 0, cell("columnHeader", F.lit(2), 0, one, F.lit("X")))), lambda x: x.isNotNull())).alias("c"))
    first = F.when(p % 4 == 3, "").when(p % 4 == 0, F.col("s").cast("string")).when(p % 4 == 2, "zz").otherwise(F.concat(F.lit("p"), p.cast("string")))
    body = n.select("k", "m", F.explode(F.filter(F.array(F.when(i % 2 == 0, cell("content", i + 3, 0, F.lit(2), F.col("f"))), cell("content", i + 3, 1, one, first), cell("content", i + 3, 2, one, i + 1)), lambda x: x.isNotNull())).alias("c"))
    cells = heads.unionByName(body).select(k.alias("doc_id"), F.lit(0).alias("table_index"), F.lit(1).alias("page"), F.lit(0).alias("local_index"), F.lit(99).alias("row_count"), F.lit(3).alias("column_count"), (F.col("c.row") * 3 + F.col("c.col")).alias("cell"), "c.kind", "c.row", "c.col", "c.row_span", F.lit(1).alias("column_span"), "c.content", none.alias("polygon"))
    a0 = F.when(p % 4 == 0, F.concat("f", F.lit(" "), F.col("s").cast("string"))).when((p % 3 == 0) & (p % 5 > 0), "").otherwise(F.col("f"))
    line = F.concat(F.lit("| "), a0, F.lit(" | "), F.when(p % 2 == 0, "").otherwise(F.concat(F.lit("p"), p.cast("string"))), F.when(p % 5 == 0, " |").otherwise(F.concat(F.lit(" | "), (i + 1).cast("string"), F.lit(" |"))))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.when((k % 4 > 0) | (i == 0), F.struct("i", line.alias("l"))))), lambda x: x["l"]), "\n")
    told = F.when(k % 5 == 0, "no table here").otherwise(F.concat(F.when(k % 6 == 1, "").otherwise("| A | B | C |\n"), F.lit("|---|---|---|\n"), F.col("lines"), F.lit("\n")))
    markdown = n.where(k % 3 > 0).groupBy("k").agg(lines.alias("lines")).select(k.alias("doc_id"), F.lit(1).alias("page"), told.alias("markdown"))
    sure = keys.select(k.alias("doc_id"), F.lit(1).alias("page"), F.lit(0).alias("local_index"), F.when(k % 11 == 0, 0.1).otherwise(0.9).alias("min_cell_confidence"), F.when(k % 13 == 0, F.array(F.lit("rotated cells (1 cell(s) with h/w>5)"))).otherwise(F.array().cast("array<string>")).alias("complexity_reasons"))
    texts = spark.createDataFrame([], f"doc_id bigint, ord int, role string, content string, spans {schemas.SPANS}, regions {schemas.REGIONS}")
    return t, cells, texts, sure, markdown


@query(f"""WITH {PATH}, said AS (SELECT k, i, source, label, h, [c0, c1, c2][1:wide] AS c FROM al)
SELECT k AS document_id, (i + 3)::INT AS row_index, source, array_to_string(list_filter(['[Table: ' || label || ']'] || list_transform(range(1, len(c) + 1), lambda j: CASE WHEN c[j] <> '' THEN h[j] || ': ' || c[j] ELSE h[j] END), lambda x: x <> ''), ' | ') AS text_for_embedding FROM said""")
def table_path(spark, sf_dir):
    chunks, _ = tables.table_path(*two_readings(spark, sf_dir), F.lit("orders.pdf"))
    return chunks.select("document_id", "row_index", "source", "text_for_embedding")


@query(f"""WITH {PATH}, e AS (SELECT k, sum((c0 = '')::INT + (c1 = '')::INT + (wide = 3 AND c2 = '')::INT) / sum(wide) AS ratio FROM al GROUP BY k)
SELECT ch.k AS doc_id, ch.source, CASE WHEN coalesce(ratio, 0) > 0.25 THEN concat_ws(',', nullif(flags, ''), 'high_empty_ratio') ELSE flags END AS flags, round(coalesce(ratio, 0), 6) AS empty_ratio FROM ch LEFT JOIN e ON ch.k = e.k""")
def table_report(spark, sf_dir):
    """With a quarter as the bound of blanks, which some tables here pass."""
    _, report = tables.table_path(*two_readings(spark, sf_dir), F.lit("orders.pdf"), Config(empty_ratio=0.25))
    return report.select("doc_id", "source", F.array_join("flag_types", ",").alias("flags"), F.round("empty_ratio", 6).alias("empty_ratio"))


# ---- scalars

@query("SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'checked' WHEN 1 THEN 'unchecked' WHEN 2 THEN 'a b ' || o_orderkey ELSE o_orderpriority END AS content FROM orders")
def checkbox_text(spark, sf_dir):
    k = F.col("o_orderkey")
    raw = F.when(k % 4 == 0, ":selected:").when(k % 4 == 1, " :unselected:\n").when(k % 4 == 2, F.concat(F.lit("a  :selected:\tb "), k.cast("string"))).otherwise(F.concat("o_orderpriority", F.lit(" ")))
    return table(spark, sf_dir, "orders").select(k.alias("k"), text.checkbox_text(raw).alias("content"))


@query("""WITH s AS (SELECT o_orderkey AS k, list_transform(range(o_orderkey % 5), lambda j: 'Sentence ' || j || ' of ' || o_orderkey || CASE WHEN j % 2 = 0 THEN '.' ELSE '?!' END) AS s FROM orders)
SELECT k, CASE WHEN length(array_to_string(s, ' ')) < 30 THEN '' ELSE array_to_string(s[greatest(len(s) - 1, 1):], ' ') END AS last FROM s""")
def last_sentences(spark, sf_dir):
    k = F.col("o_orderkey")
    each = F.transform(F.slice(F.array(*map(F.lit, range(4))), F.lit(1), (k % 5).cast("int")), lambda j: F.concat(F.lit("Sentence "), j.cast("string"), F.lit(" of "), k.cast("string"), F.when(j % 2 == 0, ".").otherwise("?!")))
    return table(spark, sf_dir, "orders").select(k.alias("k"), text.last_sentences(F.array_join(each, "  "), 2).alias("last"))


@query("SELECT page_id, substr(sha256(url), 1, 32) AS key, CASE WHEN length(url) > 40 THEN left(url, 22) || '…' || right(url, 17) ELSE url END AS short FROM pages")
def name_keys(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.name_key(F.col("url")).alias("key"), text.short_name(F.col("url")).alias("short"))


@query("SELECT p_partkey AS id, printf('%.2f', p_size / 8.0) || ':' || printf('%.2f', p_partkey % 1000 / 200.0) || ':' || printf('%.2f', 1.0) || ':' || printf('%.2f', p_size / 16.0) AS position FROM part")
def position_groups(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.position_group(size / 8, F.col("p_partkey") % 1000 / 200, F.lit(1.0), size / 16).alias("position"))


@query("""SELECT p_partkey AS id, concat_ws(chr(10), 'Page: ' || p_partkey % 25, 'Layout caption: ' || CASE WHEN p_partkey % 3 = 0 THEN '(none detected)' ELSE p_name END,
  CASE WHEN p_partkey % 2 = 0 THEN 'Routing signals: caption_missing, full_page_graphic' END, CASE WHEN p_partkey % 5 > 0 THEN 'Occupies ' || printf('%.1f', p_size / 64.0 * 100) || '% of the page (aspect ratio ' || printf('%.1f', p_size / 4.0) || ')' END) AS context FROM part""")
def vision_contexts(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    signals = F.when(k % 2 == 0, F.array(F.lit("caption_missing"), F.lit("full_page_graphic"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "part").select(k.alias("id"), text.vision_context(k % 25, F.when(k % 3 == 0, "").otherwise(F.col("p_name")), signals, F.when(k % 5 > 0, size / 64), size / 4).alias("context"))


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 6 = 0 THEN '[Figure] ' || p_name || ' (Page 3)' ELSE concat_ws(' ', '[Figure]', p_name, 'Shows ' || p_brand, CASE WHEN p_partkey % 2 = 0 THEN 'Visible Labels: A, B' END, CASE WHEN p_partkey % 3 = 0 THEN 'Warnings Or Constraints: hot' END, CASE WHEN p_partkey % 5 > 0 THEN 'Category: diagram' END, '(Page 3)') END AS text FROM part""")
def figure_texts(spark, sf_dir):
    k, none = F.col("p_partkey"), F.array().cast("array<string>")
    listed = lambda when, *v: F.when(when, F.array(*map(F.lit, v))).otherwise(none)
    said = F.struct(F.lit(True).alias("is_meaningful"), F.when(k % 5 > 0, "diagram").otherwise("unknown").alias("category"), F.lit("high").alias("model_confidence_label"), F.lit(True).alias("contains_text"), F.concat(F.lit(" Shows "), "p_brand").alias("short_description"), listed(k % 2 == 0, "A", " ", "B ").alias("visible_labels"), none.alias("device_or_component_terms"), none.alias("procedure_actions"), listed(k % 3 == 0, "hot").alias("warnings_or_constraints"), none.alias("search_keywords"), none.alias("uncertainty"), F.lit(False).alias("needs_larger_context_crop"))
    return table(spark, sf_dir, "part").select(k.alias("id"), text.figure_text(F.col("p_name"), F.lit(3), F.when(k % 6 > 0, said)).alias("text"))


@query("""SELECT p_partkey AS id, CASE p_partkey % 7 WHEN 0 THEN 'retain' WHEN 1 THEN 'reject' WHEN 2 THEN 'retain_low_confidence' ELSE 'retain_unverified' END AS outcome FROM part""")
def understanding_parse(spark, sf_dir):
    """Whole replies, one with an unknown category, one with a field too many, one that lacks most, and one that is no JSON."""
    k = F.col("p_partkey")
    rest = '"contains_text": false, "short_description": "", "visible_labels": [], "device_or_component_terms": [], "procedure_actions": [], "warnings_or_constraints": [], "search_keywords": [], "uncertainty": [], "needs_larger_context_crop": false'
    whole = lambda ok, category, sure, more="": F.lit(f'{{"is_meaningful": {ok}, "category": "{category}", "model_confidence_label": "{sure}", {rest}{more}}}')
    reply = F.when(k % 7 == 0, whole("true", "logo", "low")).when(k % 7 == 1, whole("false", "logo", "high")).when(k % 7 == 2, whole("false", "chart", "medium")).when(k % 7 == 3, whole("true", "cat", "low")).when(k % 7 == 4, whole("true", "logo", "low", ', "x": 1')).when(k % 7 == 5, F.lit('{"is_meaningful": true}')).otherwise(F.lit("no"))
    return table(spark, sf_dir, "part").select(k.alias("id"), figures.vision_outcome(figures.parsed_understanding(reply)).alias("outcome"))


@query("""SELECT p_partkey AS id, replace(replace('see img-0.jpeg and img-1.jpeg and img-0.jpeg', 'img-0.jpeg', 'p' || p_partkey % 9 || '-img-0.jpeg'), '-1.jpeg', '-1.jpeg') AS first_only FROM part""")
def renamed_images(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("id"), text.rename_images(F.lit("see img-0.jpeg and img-1.jpeg and img-0.jpeg"), k % 9, F.array(F.lit("img-0.jpeg"))).alias("first_only"))


@query("""SELECT p_partkey AS id, CASE WHEN least(612.0, (x + w + 0.06) * 72) - greatest(0.0, (x - 0.06) * 72) > 1 THEN round(least(612.0, (x + w + 0.06) * 72) - greatest(0.0, (x - 0.06) * 72), 6) END AS width
FROM (SELECT p_partkey, p_partkey % 12 AS x, p_size / 16.0 AS w FROM part)""")
def crop_rects(spark, sf_dir):
    x, w = F.col("p_partkey") % 12, F.col("p_size") / 16
    box = F.struct(x.cast("double").alias("x0"), F.lit(1.0).alias("y0"), (x + w).alias("x1"), F.lit(2.0).alias("y1"))
    rect = geometry.crop_rect(box, F.lit(8.5), F.lit(11.0), 0.06)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.round(rect["x1"] - rect["x0"], 6).alias("width"))


@query("""SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'Cap' WHEN 1 THEN 'H | J' WHEN 2 THEN o_orderpriority ELSE '' END AS label FROM orders""")
def table_labels(spark, sf_dir):
    k, none = F.col("o_orderkey"), F.array(F.lit(""), F.lit(""))
    heads = F.when(k % 4 < 2, F.array(F.lit("H"), F.lit(""), F.lit("J"))).otherwise(none)
    return table(spark, sf_dir, "orders").select(k.alias("k"), tables.table_label(F.when(k % 4 == 0, " Cap ").otherwise(" "), heads, F.when(k % 4 == 2, F.array(F.lit(""), F.col("o_orderpriority"))).otherwise(none)).alias("label"))


@query("""WITH p AS (SELECT l_orderkey AS k, l_linenumber AS r, min(l_suppkey % 9)::DOUBLE AS a, min(l_partkey % 7)::DOUBLE AS b, max(l_suppkey % 9 + 1.5) AS c, max(l_partkey % 7 + 0.5) AS d FROM lineitem GROUP BY 1, 2)
SELECT k AS doc_id, r AS "row", a || ',' || b || ',' || c || ',' || d AS box FROM p""")
def row_polygons(spark, sf_dir):
    x, y = (F.col("l_suppkey") % 9).cast("double"), (F.col("l_partkey") % 7).cast("double")
    polygon = F.array(x, y, x + 1.5, y, x + 1.5, y + 0.5, x, y + 0.5)
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("row")).agg(F.collect_list(polygon).alias("polygons"))
    u = geometry.union_polygon(F.col("polygons"))
    return rows.select("doc_id", "row", F.concat_ws(",", *[F.get(u, F.lit(i)).cast("string") for i in (0, 1, 2, 5)]).alias("box"))


# ---- joins, routing and state

@query("""WITH p AS (SELECT o_custkey AS d, o_orderkey AS k, 40 * (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) AS at FROM orders)
SELECT p.d AS doc_id, p.k AS ord, 'text' || coalesce(' [Table: ' || arg_min('order ' || t.k, t.k) || ']', '') AS content FROM p LEFT JOIN p t ON t.d = p.d AND t.k % 3 = 0 AND abs(t.at + 7 - p.at) < 200 GROUP BY p.d, p.k""")
def table_pointers(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    p = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("ord"), (40 * (F.row_number().over(w) - 1)).alias("offset"))
    labels = p.where("ord % 3 = 0").select("doc_id", (F.col("offset") + 7).alias("offset"), F.col("ord").alias("table_index"), F.lit(0).alias("nth"), F.concat(F.lit("order "), F.col("ord").cast("string")).alias("label"))
    return paragraphs.with_table_pointers(p.withColumn("content", F.lit("text")), labels).select("doc_id", "ord", "content")


@query("""WITH p AS (SELECT o_custkey AS d, o_orderkey AS k, o_orderkey % 3 AS page, 100 * (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) AS at FROM orders)
SELECT t.d AS doc_id, t.k AS table_index, coalesce((SELECT 'Order number ' || q.k || ' is described in this text.' FROM p q WHERE q.d = t.d AND q.page = t.page AND q.k % 5 > 0 AND q.k % 4 > 0 AND q.at + 50 < t.at ORDER BY q.at DESC LIMIT 1), '') AS lead_in FROM p t WHERE t.k % 2 = 0""")
def table_lead_ins(spark, sf_dir):
    """Short paragraphs (each fourth order) and page headers (each fifth) lead nothing in."""
    w, k = Window.partitionBy("o_custkey").orderBy("o_orderkey"), F.col("o_orderkey")
    p = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), k.alias("k"), (k % 3).cast("int").alias("page"), (100 * (F.row_number().over(w) - 1)).cast("int").alias("at"))
    k = F.col("k")
    content = F.when(k % 4 == 0, "short").otherwise(F.concat(F.lit("Order number "), k.cast("string"), F.lit(" is described in this text.")))
    texts = p.select("doc_id", k.alias("ord"), F.when(k % 5 == 0, "pageFooter").otherwise("").alias("role"), content.alias("content"), F.array(F.struct(F.col("at").alias("offset"), F.lit(50).alias("length"))).alias("spans"), F.array(F.struct(F.col("page").alias("page_number"), F.array().cast("array<double>").alias("polygon"))).alias("regions"))
    return tables.lead_ins(p.where("k % 2 = 0").select("doc_id", k.alias("table_index"), "page", F.col("at").alias("start")), texts)


@query("""SELECT o_custkey AS doc_id, count(*)::INT AS total_pages, coalesce(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FILTER (o_orderkey % 3 = 0), '') AS pages_for_ocr, coalesce(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) FILTER (o_orderkey % 3 > 0), '') AS layout_only_pages, sum(o_orderkey % 4)::INT AS low_conf_tables FROM orders GROUP BY o_custkey""")
def document_routing(spark, sf_dir):
    k = F.col("o_orderkey")
    routed = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), k.alias("page"), (k % 3 == 0).alias("needs_ocr"), (k % 4).alias("low_conf_tables"))
    return layout.route_documents(routed).withColumns({c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",") for c in ("pages_for_ocr", "layout_only_pages")})


@query("""WITH r AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events), l AS (SELECT * FROM r WHERE k = 1)
SELECT user_id AS doc_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM (SELECT user_id, event_type, event_id % 3 AS n FROM l) GROUP BY user_id""")
def last_record_counts(spark, sf_dir):
    """Of the records of a figure (here user and type) the last one counts; then a histogram."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.lit(1).alias("page"), F.col("event_type").alias("figure_index"), "event_id", F.struct("ts", "event_id").alias("at"))
    last = figures.latest_records(e, "at")
    counts = figures.outcome_counts(last.withColumn("n", F.explode(F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int")))).where("n > 0"), ["doc_id"], "figure_index")
    kinds = last.groupBy("doc_id").agg(F.array_sort(F.collect_set("figure_index")).alias("kinds")).join(counts, "doc_id", "left")
    listed = F.transform("kinds", lambda t: F.concat(t, F.lit("="), F.coalesce(F.try_element_at("counts", t), F.lit(0)).cast("string")))
    return kinds.select("doc_id", F.array_join(listed, ",").alias("counts"))


@query("""WITH i AS (SELECT c_custkey AS name, c_nationkey AS doc_id FROM customer WHERE c_custkey % 3 > 0), l AS (SELECT o_custkey AS name, min(o_orderkey) AS doc_id FROM orders GROUP BY o_custkey)
SELECT c_custkey AS name, coalesce(i.doc_id, l.doc_id) AS doc_id FROM customer LEFT JOIN i ON i.name = c_custkey LEFT JOIN l ON l.name = c_custkey""")
def name_lookup(spark, sf_dir):
    """Names by the index; what it lacks by the documents' own records."""
    c = table(spark, sf_dir, "customer")
    index = c.where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("name"), F.col("c_nationkey").cast("bigint").alias("doc_id"))
    legacy = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("name"), F.col("o_orderkey").alias("doc_id"))
    return lifecycle.resolved(c.select(F.col("c_custkey").alias("name")), index, legacy)[0]


@query("""WITH n AS (SELECT user_id AS id, arg_max(event_id, (ts, event_id)) AS v FROM events WHERE event_type = 'purchase' GROUP BY user_id), o AS (SELECT c_custkey AS id, -1 AS v FROM customer)
SELECT coalesce(n.id, o.id) AS id, coalesce(n.v, o.v) AS v, n.id IS NOT NULL AND o.id IS NULL AS inserted FROM o FULL JOIN n ON o.id = n.id""")
def index_upsert(spark, sf_dir):
    """The last purchase of each user over a table of customers; which keys are new."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit(-1).cast("bigint").alias("v"))
    new = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("id"), F.col("event_id").alias("v"), "ts")
    whole, _ = lifecycle.upserted_with_counts(old, new, ["id"], ["ts", "v"])
    return whole.join(old.select("id", F.lit(False).alias("inserted")), "id", "left").select("id", "v", F.coalesce("inserted", F.lit(True)).alias("inserted"))
