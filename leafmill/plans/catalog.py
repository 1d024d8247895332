"""Registry of the queries and of the SQL that states the same result.

The tables at hand hold no layout results, so layout-shaped inputs are derived from them by
fixed rules; each query runs over all rows of its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill import schemas
from leafmill.config import Config
from leafmill.functions import geometry, text
from leafmill.operators import figures, layout, paragraphs, search, tables
from leafmill.sources import artifacts
from leafmill.streaming import lifecycle

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TOKENS = f"len(list_filter(regexp_split_to_array(text, '{text.SPACE_SQL}+'), lambda x: x <> ''))"


@query(f"SELECT doc_id, coalesce({TOKENS}, 0)::INT AS tokens FROM documents")
def token_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).alias("tokens"))


@query(f"SELECT lang, sum(coalesce({TOKENS}, 0))::BIGINT AS tokens, count(*) AS n FROM documents GROUP BY lang")
def token_totals(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(text.token_count(F.col("text"))).alias("tokens"), F.count("*").alias("n"))


@query("SELECT substr(sha256(text), 1, 16) AS document_id, doc_id, length(text)::INT AS size, (length(trim(text)) / greatest(1 + length(text) // 3000, 1)) > 50 AS has_text FROM documents")
def pre_analysis(spark, sf_dir):
    d, pages = table(spark, sf_dir, "documents"), F.greatest(F.floor(F.length("text") / 3000) + 1, F.lit(1))
    return d.select(text.document_id(F.col("text")).alias("document_id"), "doc_id", F.length("text").alias("size"), (F.length(F.trim("text")) / pages > 50).alias("has_text"))


LINES = """
lines AS (
  SELECT doc_id, i AS ord, line AS content FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL)),
placed AS (SELECT *, coalesce(sum(length(content) + 1) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS off, (ord // 20 + 1)::INT AS page FROM lines)
"""


@query(f"WITH {LINES} SELECT doc_id::VARCHAR AS doc_id, ord::INT AS ord, off AS \"offset\", page, length(content)::INT AS size FROM placed WHERE content <> ''")
def paragraph_explode(spark, sf_dir):
    return paragraphs.text_paragraphs(table(spark, sf_dir, "documents")).where("content <> ''").select("doc_id", "ord", "offset", "page", F.length("content").alias("size"))


@query(f"""
WITH RECURSIVE {LINES},
clean AS (SELECT doc_id, page, ord, off, regexp_replace(content, '^{text.SPACE_SQL}+|{text.SPACE_SQL}+$', '', 'g') AS content FROM placed),
sized AS (SELECT *, len(list_filter(regexp_split_to_array(content, '{text.SPACE_SQL}+'), lambda x: x <> '')) AS t, row_number() OVER (PARTITION BY doc_id, page ORDER BY ord) AS k FROM clean WHERE content <> ''),
runs AS (
  SELECT doc_id, page, count(*) AS n, list(content ORDER BY k) AS contents, list(off ORDER BY k) AS offs, list(s ORDER BY k) AS ps
  FROM (SELECT *, sum(t) OVER (PARTITION BY doc_id, page ORDER BY k) AS s FROM sized) GROUP BY doc_id, page),
w(doc_id, page, lo, hi, after) AS (
  SELECT doc_id, page, 0::BIGINT, 0::BIGINT, 1::BIGINT FROM runs
  UNION ALL
  SELECT doc_id, page, lo, hi, CASE WHEN hi = n AND total < 500 THEN n + 1 ELSE hi + 1 - len(list_filter(range(1, hi + 1), lambda m: m >= lo AND ps[hi] - coalesce(ps[m - 1], 0) <= 100)) END
  FROM (
    SELECT r.doc_id, r.page, r.n, r.ps, w.after AS lo,
      coalesce(list_filter(range(w.after, r.n + 1), lambda m: r.ps[m] - coalesce(r.ps[w.after - 1], 0) >= 500)[1], r.n) AS hi,
      r.ps[coalesce(list_filter(range(w.after, r.n + 1), lambda m: r.ps[m] - coalesce(r.ps[w.after - 1], 0) >= 500)[1], r.n)] - coalesce(r.ps[w.after - 1], 0) AS total
    FROM w JOIN runs r ON w.doc_id = r.doc_id AND w.page = r.page WHERE w.after <= r.n))
SELECT substr(sha256(w.doc_id || '-para-' || w.page || '-' || offs[lo]), 1, 32) AS chunk_id, w.doc_id::VARCHAR AS document_id, w.page, (hi - lo + 1)::INT AS n_paragraphs,
  (ps[hi] - coalesce(ps[lo - 1], 0))::INT AS tokens, array_to_string(contents[lo:hi], ' ') AS text_for_embedding
FROM w JOIN runs r ON w.doc_id = r.doc_id AND w.page = r.page WHERE lo > 0
""")
def paragraph_chunks(spark, sf_dir):
    chunks = paragraphs.paragraph_chunks(paragraphs.text_paragraphs(table(spark, sf_dir, "documents")))
    return chunks.select("chunk_id", "document_id", "page", "n_paragraphs", "tokens", "text_for_embedding")


@query("""
SELECT substr(sha256(l_orderkey || '-table-0-row-' || l_linenumber), 1, 32) AS chunk_id, l_orderkey AS document_id, l_linenumber AS row_index,
  '[Table: order ' || l_orderkey || '] | Part: ' || l_partkey || ' | Supplier: ' || l_suppkey || ' | Quantity: ' || l_quantity::BIGINT || ' | ' || l_returnflag AS text_for_embedding
FROM lineitem
""")
def table_row_chunks(spark, sf_dir):
    cell = lambda c: F.col(c).cast("bigint").cast("string")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.lit("layout").alias("source"), F.lit("lineitem").alias("source_file"), F.lit(1).alias("page"), F.lit(0).alias("table_index"), F.col("l_linenumber").alias("row"),
        F.array(cell("l_partkey"), cell("l_suppkey"), cell("l_quantity"), "l_returnflag").alias("cells"), F.array(*map(F.lit, ("Part", "Supplier", "Quantity", ""))).alias("headers"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("label"), F.lit("").alias("lead_in"), F.array().cast("array<array<double>>").alias("polygons"),
    )
    return tables.row_chunks(rows).select("chunk_id", "document_id", "row_index", "text_for_embedding")


@query("""
WITH g AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS r, o_orderstatus AS label, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '' END AS v FROM orders),
f AS (SELECT *, coalesce((label <> lag(label) OVER (PARTITION BY o_custkey ORDER BY r))::INT, 1) AS new FROM g),
i AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY r) AS run FROM f)
SELECT o_custkey AS doc_id, r::INT AS "row", label, CASE WHEN count(*) OVER w > 1 AND count_if(v <> '') OVER w = 1 THEN max(v) OVER w ELSE v END AS value
FROM i WINDOW w AS (PARTITION BY o_custkey, run)
""")
def cell_grid_fill(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.lit(0).alias("table_index"), (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("row"), "o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise("").alias("v")
    )
    grid = o.select("doc_id", "table_index", "row", F.explode(F.array(F.struct(F.lit(0).alias("col"), F.col("o_orderstatus").alias("text")), F.struct(F.lit(1).alias("col"), F.col("v").alias("text")))).alias("c")).select("doc_id", "table_index", "row", "c.col", "c.text")
    filled = tables.fill_label_runs(grid)
    return filled.groupBy("doc_id", "row").agg(F.max(F.when(F.col("col") == 0, F.col("text"))).alias("label"), F.max(F.when(F.col("col") == 1, F.col("text"))).alias("value"))


@query("""
SELECT o_custkey AS doc_id, k.r::INT AS "row", c.c::INT AS col, coalesce(max(txt), '') AS "text", coalesce(bool_or(spanned), false) AS spanned FROM (
  SELECT o_custkey, unnest(range(least(count(*), 6))) AS r FROM orders GROUP BY o_custkey) k CROSS JOIN (SELECT unnest(range(3)) AS c) c LEFT JOIN (
  SELECT o_custkey AS ck, n, arg_max(o_orderstatus, o_orderkey) AS txt, rr, cc, bool_or(rr > first) AS spanned FROM (
    SELECT *, unnest(range(first, least(first + span, n))) AS rr FROM (
      SELECT o_custkey, o_orderkey, o_orderstatus, 1 + o_orderkey % 2 AS span, o_orderkey % 3 AS cc, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) % 6 AS first, least(count(*) OVER (PARTITION BY o_custkey), 6) AS n FROM orders))
  GROUP BY o_custkey, n, rr, cc) g ON g.ck = k.o_custkey AND g.rr = k.r AND g.cc = c.c GROUP BY 1, 2, 3
""")
def cell_grid(spark, sf_dir):
    w = Window.partitionBy("o_custkey")
    cells = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.lit(0).alias("table_index"), F.col("o_orderkey").alias("cell"), ((F.row_number().over(w.orderBy("o_orderkey")) - 1) % 6).alias("row"), (F.col("o_orderkey") % 3).cast("int").alias("col"),
        (F.col("o_orderkey") % 2 + 1).cast("int").alias("row_span"), F.lit(1).alias("column_span"), F.least(F.count("*").over(w), F.lit(6)).cast("int").alias("row_count"), F.lit(3).alias("column_count"), F.col("o_orderstatus").alias("content"),
    )
    return tables.cell_grid(cells).select("doc_id", "row", "col", "text", "spanned")


@query("SELECT event_id, user_id, coalesce(last_value(CASE WHEN value >= 50 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id), '') AS filled FROM events")
def forward_fill(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("value") >= 50, F.col("event_type")).otherwise("").alias("text"), F.lit("").alias("layout"), F.lit(False).alias("spanned"))
    return tables.fill_down(e, ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "filled")


@query("SELECT l_orderkey AS doc_id, l_linenumber AS \"row\", CASE WHEN l_partkey % 2 = 0 THEN 'a b' ELSE 'c' END AS c0, CASE WHEN l_partkey % 2 = 0 THEN 'a b' ELSE '' END AS c1, 'x' AS c2 FROM lineitem")
def ocr_fill_right(spark, sf_dir):
    first = F.when(F.col("l_partkey") % 2 == 0, "a b").otherwise("c")
    cells = tables.fill_right(F.array(first, F.lit(" "), F.lit("x")), F.array(F.lit("a"), F.lit("a"), F.lit("")))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("row"), cells.alias("c")).select("doc_id", "row", *[F.get("c", F.lit(i)).alias(f"c{i}") for i in range(3)])


@query("""
WITH h AS (SELECT n_regionkey AS r, n_nationkey AS k, n_name AS t, n_nationkey % 4 AS c FROM nation),
s AS (SELECT r, k, t, unnest(CASE WHEN k % 2 = 0 AND c < 3 THEN [c, c + 1] ELSE [c] END) AS c FROM h)
SELECT r::BIGINT AS doc_id, array_to_string(list_transform(range(4), i -> coalesce((SELECT string_agg(t, ' / ' ORDER BY k) FROM s WHERE s.r = x.r AND s.c = i), '')), ' | ') AS headers
FROM (SELECT DISTINCT r FROM h) x
""".replace("list_transform(range(4), i -> coalesce((SELECT string_agg(t, ' / ' ORDER BY k) FROM s WHERE s.r = x.r AND s.c = i), ''))", "[" + ", ".join(f"coalesce((SELECT string_agg(t, ' / ' ORDER BY k) FROM s WHERE s.r = x.r AND s.c = {i}), '')" for i in range(4)) + "]"))
def header_fusion(spark, sf_dir):
    cells = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").cast("bigint").alias("doc_id"), F.lit(0).alias("table_index"), F.lit("columnHeader").alias("kind"), F.col("n_nationkey").alias("row"), (F.col("n_nationkey") % 4).alias("col"),
        F.when(F.col("n_nationkey") % 2 == 0, 2).otherwise(1).alias("column_span"), F.lit(4).alias("column_count"), F.col("n_name").alias("content"),
    )
    return tables.fused_headers(cells).select("doc_id", F.array_join("headers", " | ").alias("headers"))


WORDS_SQL = """
words AS (SELECT l_orderkey AS d, 100 * l_linenumber + (l_partkey + 13 * k) % 60 AS a, 100 * l_linenumber + (l_partkey + 13 * k) % 60 + l_suppkey % 7 + 1 AS b, (50 + (l_partkey + k) % 50) / 100.0::DOUBLE AS conf
  FROM lineitem, (SELECT unnest(range(3)) AS k)),
cells AS (SELECT l_orderkey AS d, l_linenumber AS c, 100 * l_linenumber AS a, 100 * l_linenumber + max(l_quantity)::INT AS b FROM lineitem GROUP BY l_orderkey, l_linenumber),
means AS (SELECT cells.d, cells.c, avg(conf) AS m FROM cells LEFT JOIN words ON cells.d = words.d AND words.a >= cells.a AND words.b <= cells.b GROUP BY cells.d, cells.c),
confident AS (SELECT d, coalesce(avg(m), 1.0) AS average, coalesce(min(m), 1.0) AS least, count(*)::INT AS cell_count, count_if(m IS NULL)::INT AS unmatched FROM means GROUP BY d)
"""


def order_cells(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    k = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    start = 100 * F.col("l_linenumber") + (F.col("l_partkey") + 13 * F.col("k")) % 60
    words = k.select(F.col("l_orderkey").alias("doc_id"), start.cast("int").alias("start"), (start + F.col("l_suppkey") % 7 + 1).cast("int").alias("stop"), ((50 + (F.col("l_partkey") + F.col("k")) % 50) / 100).alias("confidence"))
    span = F.array(F.struct((100 * F.col("l_linenumber")).alias("offset"), F.col("l_quantity").cast("int").alias("length")))
    cells = li.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity")).select(
        F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("table_index"), F.lit(1).alias("page"), F.lit(0).alias("local_index"), F.col("l_linenumber").alias("cell"), F.lit("content").alias("kind"), F.col("l_linenumber").alias("row"), F.lit(0).alias("col"),
        F.lit(1).alias("row_span"), F.lit(1).alias("column_span"), F.lit("text").alias("content"), span.alias("spans"), F.array().cast("array<double>").alias("polygon"),
    )
    return layout.table_confidence(layout.cell_confidence(cells, words))


@query(f"WITH {WORDS_SQL} SELECT d AS doc_id, round(average + 1e-9, 6) AS average_cell_confidence, round(least + 1e-9, 6) AS min_cell_confidence, cell_count, unmatched AS unmatched_cells, round(least + 1e-9, 6) < 0.75 AS requires_ocr FROM confident")
def table_confidence(spark, sf_dir):
    least = F.round(F.col("min_cell_confidence") + 1e-9, 6)
    return order_cells(spark, sf_dir).select("doc_id", F.round(F.col("average_cell_confidence") + 1e-9, 6).alias("average_cell_confidence"), least.alias("min_cell_confidence"), "cell_count", "unmatched_cells", (least < 0.75).alias("requires_ocr"))


@query("""
WITH c AS (SELECT l_orderkey AS d, l_linenumber % 3 AS col, CASE WHEN l_linenumber % 4 = 1 THEN 1 + l_partkey % 2 ELSE 1 END AS span, (1 + l_suppkey % 40) / 4.0 AS w, (1 + l_partkey % 37) / 4.0 AS h FROM lineitem),
k AS (SELECT d, col, max(w) AS w, count_if(span > 1) AS merged, count_if(h > 5 * w) AS rotated FROM c GROUP BY d, col),
t AS (SELECT d, sum(merged)::BIGINT AS merged, sum(rotated)::BIGINT AS rotated, count(*) AS n, max(w) AS hi, min(w) AS lo FROM k GROUP BY d)
SELECT d AS doc_id, concat_ws('; ', CASE WHEN merged > 0 THEN 'rowSpan>1 on ' || merged || ' cell(s)' END, CASE WHEN rotated > 0 THEN 'rotated cells (' || rotated || ' cell(s) with h/w>5)' END,
  CASE WHEN n > 1 AND hi / lo > 10 AND hi > 3 THEN 'column width disparity (' || round_even(hi / lo, 0)::BIGINT || ':1 ratio)' END) AS reasons FROM t
""")
def table_complexity(spark, sf_dir):
    w, h = (1 + F.col("l_suppkey") % 40) / 4, (1 + F.col("l_partkey") % 37) / 4
    zero = F.lit(0.0)
    cells = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("table_index"), F.lit(1).alias("page"), F.lit(0).alias("local_index"), F.col("l_linenumber").alias("cell"), F.lit("content").alias("kind"), (F.col("l_linenumber") % 3).alias("col"),
        F.when(F.col("l_linenumber") % 4 == 1, 1 + F.col("l_partkey") % 2).otherwise(1).alias("row_span"), F.lit("text").alias("content"), F.lit(1.0).alias("confidence"), F.array(zero, zero, w, zero, w, h, zero, h).alias("polygon"),
    )
    return layout.table_confidence(cells).select("doc_id", F.array_join("complexity_reasons", "; ").alias("reasons"))


@query("""
WITH t AS (SELECT o_custkey AS d, (o_orderkey % 3 + 1)::INT AS page, o_orderkey % 7 = 0 AS low, o_orderkey % 10 AS x, o_orderkey // 10 % 10 AS y FROM orders),
f AS (SELECT c_custkey AS d, (c_custkey % 3 + 1)::INT AS page, c_custkey % 10 + 0.5 AS x, c_custkey // 7 % 10 + 0.5 AS y FROM customer)
SELECT t.d AS doc_id, t.page, bool_or(low) OR count(f.d) > 0 AS needs_ocr, count(DISTINCT CASE WHEN low THEN k END)::INT AS low_conf_tables
FROM (SELECT *, row_number() OVER () AS k FROM t) t LEFT JOIN f ON t.d = f.d AND t.page = f.page AND t.x < f.x + 1.5 AND f.x < t.x + 2 AND t.y < f.y + 1.5 AND f.y < t.y + 2 GROUP BY t.d, t.page
""")
def page_routing(spark, sf_dir):
    box = lambda x, y, s: F.struct(x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + s).cast("double").alias("x1"), (y + s).cast("double").alias("y1"))
    o = F.col("o_orderkey")
    t = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), (o % 3 + 1).cast("int").alias("page"), (o % 7 == 0).alias("requires_ocr"), box(o % 10, F.floor(o / 10) % 10, 2).alias("box"))
    c = F.col("c_custkey")
    f = table(spark, sf_dir, "customer").select(c.alias("doc_id"), (c % 3 + 1).cast("int").alias("page"), box(c % 10 + 0.5, F.floor(c / 7) % 10 + 0.5, 1.5).alias("box"))
    return layout.route_pages(t.select("doc_id", "page").distinct(), t, f, Config(ocr_enabled=True))


FIGURES_SQL = """
f AS (SELECT p_partkey AS k, p_partkey % 25 AS page, CASE WHEN p_partkey % 9 = 0 THEN 'part ' || p_partkey ELSE '' END AS caption, (p_partkey % 7)::DOUBLE AS x0, (p_partkey // 7 % 10)::DOUBLE AS y0, p_size / 8.0 AS w, (1 + p_partkey % 16) / 4.0 AS h FROM part),
o AS (SELECT n_nationkey AS page, (1 + n_nationkey % 3) / 1.0 AS h FROM nation),
s AS (SELECT s_suppkey % 25 AS page, (s_suppkey % 8)::DOUBLE AS x0, (s_suppkey // 8 % 10)::DOUBLE AS y0, CASE WHEN s_suppkey % 6 = 0 THEN 'See figure' ELSE s_name END AS content FROM supplier),
m AS (SELECT k, max(greatest(0, least(x0 + w, 8.5) - greatest(x0, 0)) * greatest(0, least(y0 + f.h, o.h) - greatest(y0, 0)) / (w * f.h)) AS over FROM f LEFT JOIN o ON f.page = o.page GROUP BY k),
r AS (SELECT DISTINCT k FROM f JOIN s ON f.page = s.page AND s.x0 + 1.5 >= f.x0 - 1 AND s.x0 <= f.x0 + w + 1 AND s.y0 + 0.25 >= f.y0 - 1 AND s.y0 <= f.y0 + h + 1 AND regexp_matches(lower(content), 'figure|fig\\.|see |shown|illustrat|diagram|warning|caution|danger|note|legend|symbol')),
q AS (SELECT f.*, coalesce(over, 0) AS over, caption <> '' OR r.k IS NOT NULL AS ref, w * h / (8.5 * 11) AS area, greatest(w, h) / least(w, h) AS aspect FROM f JOIN m ON f.k = m.k LEFT JOIN r ON f.k = r.k),
j AS (SELECT *, CASE WHEN over >= 0.3 AND NOT ref THEN 'structural_noise' WHEN area < 0.01 AND NOT ref THEN 'low_value_graphic' WHEN aspect > 8 AND NOT ref THEN 'decorative_geometry' END AS reason FROM q)
"""


def part_figures(spark, sf_dir):
    k, zero = F.col("p_partkey"), F.lit(0.0)
    box = lambda x, y, w, h: F.struct(x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + w).cast("double").alias("x1"), (y + h).cast("double").alias("y1"))
    f = table(spark, sf_dir, "part").select(
        F.lit("parts").alias("doc_id"), (k % 25).cast("int").alias("page"), k.alias("figure_index"), F.when(k % 9 == 0, F.concat(F.lit("part "), k.cast("string"))).otherwise("").alias("caption"),
        box(k % 7, F.floor(k / 7) % 10, F.col("p_size") / 8, (1 + k % 16) / 4).alias("box"), F.lit(8.5).alias("page_width"), F.lit(11.0).alias("page_height"),
    )
    n, s = F.col("n_nationkey"), F.col("s_suppkey")
    furniture = table(spark, sf_dir, "nation").select(F.lit("parts").alias("doc_id"), n.alias("page"), box(zero, zero, F.lit(8.5), 1.0 + n % 3).alias("box"))
    texts = table(spark, sf_dir, "supplier").select(F.lit("parts").alias("doc_id"), (s % 25).cast("int").alias("page"), F.when(s % 6 == 0, "See figure").otherwise(F.col("s_name")).alias("content"), box(s % 8, F.floor(s / 8) % 10, F.lit(1.5), F.lit(0.25)).alias("box"))
    return figures.qualified(figures.with_features(figures.with_references(figures.furniture_overlap(f, furniture), texts)))


@query(f"""WITH {FIGURES_SQL} SELECT k AS figure_index, page::INT AS page, CASE WHEN reason IS NULL THEN 'candidate' ELSE 'rejected' END AS status, reason AS rejection_reason,
CASE WHEN reason IS NOT NULL THEN '' ELSE concat_ws(',', CASE WHEN caption = '' THEN 'caption_missing' END, CASE WHEN area < 0.01 THEN 'small_figure_with_reference' END, CASE WHEN area > 0.9 THEN 'full_page_graphic' END, CASE WHEN over >= 0.3 THEN 'furniture_overlap_with_reference' END) END AS signals FROM j""")
def figure_qualify(spark, sf_dir):
    return part_figures(spark, sf_dir).select("figure_index", "page", "status", "rejection_reason", F.array_join("routing_signals", ",").alias("signals"))


@query(f"WITH {FIGURES_SQL} SELECT reason, count(*) AS n FROM j WHERE reason IS NOT NULL GROUP BY reason")
def rejected_by_reason(spark, sf_dir):
    return part_figures(spark, sf_dir).where("status = 'rejected'").groupBy(F.col("rejection_reason").alias("reason")).agg(F.count("*").alias("n"))


def part_records(spark, sf_dir):
    k = F.col("p_partkey")
    said = table(spark, sf_dir, "part").where(k % 5 > 0).select(F.lit("parts").alias("doc_id"), (k % 25).cast("int").alias("page"), k.alias("figure_index"), F.when(k % 5 > 1, F.struct((k % 2 == 0).alias("is_meaningful"), F.when(k % 3 == 0, "high").otherwise("low").alias("model_confidence_label"))).alias("u"))
    return said.withColumn("outcome", figures.vision_outcome(F.col("u")))


OUTCOME_SQL = "CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN 'retain_unverified' WHEN k % 2 = 0 THEN 'retain' WHEN k % 3 = 0 THEN 'reject' ELSE 'retain_low_confidence' END"


@query(f"""WITH {FIGURES_SQL}, v AS (SELECT CASE WHEN reason IS NOT NULL THEN 'rejected' ELSE CASE WHEN {OUTCOME_SQL} = 'reject' THEN 'rejected_by_vision' ELSE coalesce({OUTCOME_SQL}, 'not_analyzed') END END AS stage FROM j)
SELECT stage, count(*) AS n, round(count(*) * 100 / sum(count(*)) OVER (), 1) AS share FROM v GROUP BY stage""")
def verdict_counts(spark, sf_dir):
    return figures.verdict_counts(figures.verdicts(part_figures(spark, sf_dir), part_records(spark, sf_dir)))


@query(f"""WITH {FIGURES_SQL} SELECT substr(sha256('parts-fig-' || k || '-p' || page), 1, 32) AS chunk_id, page::INT AS page, k AS figure_index, '[Figure] ' || caption || ' (Page ' || page || ')' AS text_for_embedding,
CASE WHEN k % 4 = 0 THEN 'crop-' || k ELSE 'p' || page || '-layout-fig-0.jpeg' END AS image_blob FROM j WHERE reason IS NULL AND ({OUTCOME_SQL}) IS DISTINCT FROM 'reject'""")
def figure_chunks(spark, sf_dir):
    f = part_figures(spark, sf_dir).withColumn("crop", F.when(F.col("figure_index") % 4 == 0, F.concat(F.lit("crop-"), F.col("figure_index").cast("string"))))
    all_figures = f.select("doc_id", "page", "figure_index", "caption", F.lit("parts.pdf").alias("source_file"), F.lit(None).cast("string").alias("layout_image"), F.array().cast("array<double>").alias("polygon"))
    records = part_records(spark, sf_dir).select("doc_id", "page", "figure_index", F.lit(None).cast(schemas.UNDERSTANDING).alias("understanding"), "outcome", F.lit(None).cast("string").alias("record_crop"))
    return figures.figure_chunks(all_figures, f, records).select("chunk_id", "page", "figure_index", "text_for_embedding", "image_blob")


@query("SELECT o_custkey AS doc_id, o_orderkey AS figure FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k <= 5")
def vision_budget(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("figure"), "o_orderdate")
    return figures.first_per_document(o, 5, ["o_orderdate", "figure"]).select("doc_id", "figure")


@query("""
SELECT e.event_id, coalesce((SELECT event_type FROM events p WHERE p.user_id = e.user_id AND p.ts < e.ts AND p.event_type <> 'error' AND p.event_type <> 'purchase' ORDER BY p.ts DESC, p.event_id LIMIT 1), '') AS found
FROM events e WHERE e.event_type = 'purchase'
""")
def lead_in_asof(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return tables.nearest_before(e.where("event_type = 'purchase'").select("event_id", "user_id", "at"), e.where("event_type not in ('error', 'purchase')"), ["user_id"], "at", F.col("event_type"), "event_id").select("event_id", "found")


@query("SELECT e.event_id, min(r.event_id) AS first_error FROM events e LEFT JOIN events r ON r.user_id = e.user_id AND r.event_type = 'error' AND abs(epoch_us(r.ts) - epoch_us(e.ts)) < 86400000000 GROUP BY e.event_id")
def band_join_first(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    errors = e.where("event_type = 'error'").select("user_id", "at", F.col("event_id").alias("first_error"))
    return paragraphs.band_first(e.select("event_id", "user_id", "at"), errors, ["user_id"], "at", 86_400_000_000, ["first_error"], "first_error").select("event_id", "first_error")


@query("""
SELECT n_regionkey::BIGINT AS doc_id, local_index, is_header, "row", cells FROM (
  SELECT n_regionkey, 0 AS local_index, true AS is_header, 0 AS "row", 'Key,Name' AS cells FROM (SELECT DISTINCT n_regionkey FROM nation)
  UNION ALL SELECT n_regionkey, 0, false, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INT, n_nationkey || ',' || n_name || CASE WHEN n_nationkey % 2 = 1 THEN ' (odd)' ELSE '' END FROM nation
  UNION ALL SELECT n_regionkey, 1, true, 0, 'Total ' || count(*) FROM nation GROUP BY n_regionkey)
""")
def pipe_table_parse(spark, sf_dir):
    odd = F.when(F.col("n_nationkey") % 2 == 1, "\n  (odd)  ").otherwise("")  # an odd nation's row is broken off within its last cell
    row = F.concat(F.lit("| "), F.col("n_nationkey").cast("string"), F.lit(" | "), F.col("n_name"), odd, F.lit(" |"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("r")))), lambda x: x["r"]), "\n")
    pages = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").cast("bigint").alias("doc_id")).agg(
        F.concat(F.lit("Nations\n\n| Key | Name |\n|:---|---:|\n"), rows, F.lit("\nand\n| Total "), F.count("*").cast("string"), F.lit(" |\n|---|\n")).alias("markdown")
    )
    return tables.pipe_tables(pages, ["doc_id"]).select("doc_id", "local_index", "is_header", "row", F.array_join("cells", ",").alias("cells"))


@query("""
WITH t AS (SELECT o_orderkey AS k, o_orderkey % 4 > 0 AS md, o_orderkey % 3 AS n_ocr, o_orderkey % 5 > 0 AS has, o_orderkey % 10 / 10.0 AS conf, o_orderkey % 11 = 0 AS rot, o_orderkey % 4 AS lvl, o_orderkey % 9 AS ocr, o_orderkey % 8 AS lay FROM orders),
u AS (SELECT *, md AND n_ocr = 0 AND conf < 0.2 AS art, md AND has AND n_ocr > 0 AS o, CASE WHEN lay > 0 THEN ocr / lay ELSE 1 END < 0.6 AS few FROM t)
SELECT k, CASE WHEN art THEN 'none' WHEN o AND NOT (rot OR lvl >= 2 OR few) THEN 'ocr' ELSE 'layout' END AS source,
  CASE WHEN art THEN 'image_artifact' WHEN o AND (rot OR lvl >= 2 OR few) THEN concat_ws(',', CASE WHEN few THEN 'row_count_mismatch' END, CASE WHEN lvl >= 2 THEN 'multi_header' END) ELSE '' END AS flags FROM u
""")
def reader_choice(spark, sf_dir):
    k = F.col("o_orderkey")
    t = table(spark, sf_dir, "orders").select(
        k.alias("k"), (k % 4 > 0).alias("has_markdown"), (k % 3).alias("page_ocr_tables"), ((k % 5 > 0) & (k % 3 > 0)).alias("has_ocr_table"), (k % 10 / 10).alias("min_cell_confidence"), (k % 11 == 0).alias("rotated"), (k % 4).alias("max_header_row"), (k % 9).alias("ocr_rows"), (k % 8).alias("layout_rows")
    )
    return tables.choose_reader(t).select("k", "source", F.array_join("flag_types", ",").alias("flags"))


@query("SELECT o_orderstatus AS status, count(*) AS total, count_if(o_orderkey % 3 = 0) AS ocr_tables, round_even(count_if(o_orderkey % 3 = 0) * 100 / count(*), 0)::INT || '%' AS ocr_share, count_if(o_orderkey % 8 = 0) AS flagged FROM orders GROUP BY o_orderstatus")
def table_stats(spark, sf_dir):
    k = F.col("o_orderkey")
    return tables.table_stats(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.when(k % 3 == 0, "ocr").otherwise("layout").alias("source"), (k % 8 == 0).alias("flagged")), ["status"])


KNN_SQL = """
SELECT query_id, id, score, rank, CASE WHEN score >= 0.86 THEN 'strong' WHEN score >= 0.82 THEN 'weak' ELSE 'none' END AS band FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)) WHERE rank <= 5
"""


@query(KNN_SQL)
def knn_cosine(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return search.knn_cosine(e, e, 5, "vec_id", "vec_id", skip_self=True).withColumn("band", text.match_band(F.col("score")))


BM25_SQL = """
d AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM documents),
st AS (SELECT count(*) AS n, avg(len(t)) AS al FROM d),
q AS (SELECT DISTINCT item_id AS query_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM benchmark),
p AS (SELECT id, len, term, count(*) AS tf FROM (SELECT id, len(t) AS len, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY id, len, term),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
s AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / al))), 6) AS score FROM p JOIN f USING (term) JOIN q USING (term), st GROUP BY query_id, id),
lex AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
"""


def lexical(spark, sf_dir, most):
    return search.bm25(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "doc_id", most)


@query(f"WITH {BM25_SQL} SELECT query_id, id, round(score, 4) AS score FROM lex WHERE rank <= 8")
def bm25(spark, sf_dir):
    return lexical(spark, sf_dir, 8).select("query_id", "id", F.round("score", 4).alias("score"))


@query(f"""WITH {BM25_SQL},
vec AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (SELECT i.item_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
  FROM benchmark i JOIN embeddings a ON i.item_id = a.vec_id, embeddings b)),
u AS (SELECT query_id, id, rank FROM lex WHERE rank <= 50 UNION ALL SELECT query_id, id, rank FROM vec WHERE rank <= 50),
z AS (SELECT query_id, id, round(sum(1.0 / (60 + rank)), 9) AS score FROM u GROUP BY query_id, id)
SELECT query_id, id, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM z) WHERE rank <= 8""")
def hybrid_rrf(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.join(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("vec_id")), "vec_id", "left_semi")
    return search.fused(lexical(spark, sf_dir, 50), search.knn_cosine(q, e, 50, "vec_id", "vec_id"), 8).select("query_id", "id", "rank")


@query("""
WITH v AS (SELECT vec_id AS id, unnest(range(64))::INT AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
e AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM v GROUP BY dim)
SELECT id, dim, (CASE WHEN hi > lo THEN floor((x - lo) / (hi - lo) * 255 + 0.5) ELSE 0 END - 128)::INT AS q FROM v JOIN e USING (dim)
""")
def int8_quantize(spark, sf_dir):
    return search.quantized(table(spark, sf_dir, "embeddings"), "vec_id")


@query("SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def facet_counts(spark, sf_dir):
    return search.facets(table(spark, sf_dir, "documents"), "lang", "source")


@query("""
SELECT conv_id, string_agg(coalesce(role, '') || ': ' || left(coalesce(text, ''), 300), chr(10) ORDER BY turn) AS history
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations) WHERE k <= 4 GROUP BY conv_id
""")
def chat_history(spark, sf_dir):
    return search.recent_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query(f"""SELECT query_id, string_agg('[' || rank || '] (vector, page ' || id % 7 || ', ' || id || '.pdf)' || chr(10) || 'label ' || label, chr(10) || chr(10) ORDER BY rank) AS context
FROM ({KNN_SQL}) k JOIN embeddings ON id = vec_id GROUP BY query_id""")
def context_blocks(spark, sf_dir):
    e, i = table(spark, sf_dir, "embeddings"), F.col("id")
    hits = knn_cosine(spark, sf_dir).join(e.select(F.col("vec_id").alias("id"), "label"), "id")
    return search.context_blocks(hits.select("query_id", "rank", F.lit("vector").alias("type"), (i % 7).alias("page"), F.concat(F.lit("a/b/"), i.cast("string"), F.lit(".pdf")).alias("source_file"), F.concat(F.lit("label "), F.col("label").cast("string")).alias("text_for_embedding")))


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g')) AS content FROM pages""")
def page_text(spark, sf_dir):
    """The article's blocks are body paragraphs, navigation a page header; page_texts() puts the body together."""
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), "[ \\t\\n\\r]+", " "))
    boxes = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.lit(1).alias("page"), F.array(F.struct(F.lit("pageHeader").alias("role"), plain(F.regexp_extract("html", "(?s)<nav>(.*?)</nav>", 1)).alias("content")), F.struct(F.lit("").alias("role"), plain(F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1)).alias("content"))).alias("p"))
    body = boxes.select("doc_id", "page", F.posexplode("p").alias("ord", "p")).select("doc_id", "page", "ord", "p.role", "p.content").where(~F.col("role").isin(*Config().noise_roles))
    return layout.page_texts(body).select(F.col("doc_id").alias("page_id"), F.col("raw_content").alias("content"))


@query("SELECT page_id, regexp_replace(url, '^.*?/en/', '') AS name, ends_with(lower(url), '.pdf') AS is_pdf FROM (SELECT page_id, replace(url, '.html', CASE WHEN page_id % 2 = 0 THEN '.PDF' ELSE '.html' END) AS url FROM pages)")
def name_from_url(spark, sf_dir):
    own = F.replace("url", F.lit(".html"), F.when(F.col("page_id") % 2 == 0, ".PDF").otherwise(".html"))
    name = text.blob_name(F.regexp_replace(own, "/en/", "/documents/"))
    return table(spark, sf_dir, "pages").select("page_id", name.alias("name"), text.is_pdf(name).alias("is_pdf"))


@query("SELECT substr(sha256(text), 1, 16) AS content_id, min(doc_id) AS doc_id, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY sha256(text)")
def dedup_content(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", text.document_id(F.col("text")).alias("content_id"))
    return d.groupBy("content_id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS run_id FROM events GROUP BY user_id")
def newest_run(spark, sf_dir):
    steps = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("run_id"), F.struct("ts", "event_id").alias("ts"))
    return artifacts.newest_runs(steps).select(F.col("doc_id").alias("user_id"), "run_id")


@query("SELECT user_id AS id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def upsert_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_id", "event_type", "ts")
    return lifecycle.latest(e, ["id"], ["ts", "event_id"]).select("id", "event_id", "event_type")


@query("SELECT o_orderkey AS chunk_id, o_custkey AS document_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def delete_cascade(spark, sf_dir):
    chunks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chunk_id"), F.col("o_custkey").alias("document_id"))
    gone = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("document_id"))
    return lifecycle.without_documents(chunks, gone)


@query("""SELECT event_id, CASE WHEN p IS NULL THEN 'run' WHEN p = event_type THEN 'skip' ELSE 'replace' END AS decision
FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)""")
def ingest_decision(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("known", F.lag("event_type").over(w))
    return e.select("event_id", lifecycle.decision(F.col("event_type"), F.col("known"), F.lit("done")).alias("decision"))


@query("""
SELECT p_partkey AS id, round(greatest(0, least(x1, 5) - greatest(x0, 2)) * greatest(0, least(y1, 5) - greatest(y0, 2)) / greatest((x1 - x0) * (y1 - y0), 1e-9), 6) AS ratio, x0 < 5 AND 2 < x1 AND y0 < 5 AND 2 < y1 AS hit,
  array_to_string([x0, y0, x1, y0, x1, y1, x0, y1]::INT[], ',') AS union_polygon
FROM (SELECT p_partkey, p_partkey % 6 AS x0, p_partkey % 5 AS y0, p_partkey % 6 + 1 + p_size % 4 AS x1, p_partkey % 5 + 2 AS y1 FROM part)
""")
def rectangle_overlap(spark, sf_dir):
    k = F.col("p_partkey")
    x0, y0 = (k % 6).cast("double"), (k % 5).cast("double")
    x1, y1 = x0 + 1 + F.col("p_size") % 4, y0 + 2
    polygon = F.array(x0, y0, x1, y0, x1, y1, x0, y1)
    other = geometry.bbox(F.array(*[F.lit(v) for v in (2.0, 2.0, 5.0, 5.0)]))
    parts = F.array(F.array(x0, y0, x1, y0), F.array(x1, y1, x0, y1))
    return table(spark, sf_dir, "part").select(
        k.alias("id"), F.round(geometry.overlap_ratio(geometry.bbox(polygon), other), 6).alias("ratio"), geometry.overlaps(geometry.bbox(polygon), other).alias("hit"), F.array_join(geometry.union_polygon(parts).cast("array<int>"), ",").alias("union_polygon")
    )
