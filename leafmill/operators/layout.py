"""The nested layout result as child tables, and the confidence of its tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.config import DEFAULT, Config
from leafmill.functions.geometry import bbox, overlaps, xs, ys
from leafmill.functions.text import all_of, formatted, snake, strip

BUCKET = 512


def snake_type(kind: T.DataType) -> T.DataType:
    """The type with every nested field's name in snake_case."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(snake_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(snake(f.name), snake_type(f.dataType), f.nullable) for f in kind.fields])
    return kind


def normalized(raw: DataFrame) -> DataFrame:
    """All field names, nested ones too, in snake_case; idempotent."""
    return raw.select(*[F.col(f"`{f.name}`").cast(snake_type(f.dataType)).alias(snake(f.name)) for f in raw.schema.fields])


def first_region(regions: Column, field: str, default: Column) -> Column:
    return F.coalesce(F.get(regions, F.lit(0))[field], default)


def pages(layout: DataFrame) -> DataFrame:
    p = F.col("p")
    return layout.select("doc_id", F.explode("pages").alias("p")).select("doc_id", p["page_number"].alias("page"), F.coalesce(p["width"], F.lit(0.0)).alias("width"), F.coalesce(p["height"], F.lit(0.0)).alias("height"), F.coalesce(p["angle"], F.lit(0.0)).alias("angle"))


def words(layout: DataFrame) -> DataFrame:
    w = F.col("w")
    return layout.select("doc_id", F.explode(F.flatten(F.transform("pages", lambda p: p["words"]))).alias("w")).select(
        "doc_id", w["content"].alias("content"), w["confidence"].alias("confidence"), w["span"]["offset"].alias("start"), (w["span"]["offset"] + w["span"]["length"]).alias("stop")
    )


def paragraphs(layout: DataFrame) -> DataFrame:
    """(doc_id, ord, role, content, page, polygon, spans, regions); page and polygon of the first region."""
    p = F.col("p")
    return layout.select("doc_id", F.posexplode("paragraphs").alias("ord", "p")).select(
        "doc_id", "ord", F.coalesce(p["role"], F.lit("")).alias("role"), p["content"].alias("content"), first_region(p["bounding_regions"], "page_number", F.lit(1)).alias("page"),
        first_region(p["bounding_regions"], "polygon", F.array().cast("array<double>")).alias("polygon"), p["spans"].alias("spans"), p["bounding_regions"].alias("regions"),
    )


def bounding_boxes(layout: DataFrame) -> DataFrame:
    """One row for each paragraph and region."""
    r = F.col("r")
    return paragraphs(layout).select("doc_id", "ord", F.coalesce(F.nullif("role", F.lit("")), F.lit("paragraph")).alias("role"), "content", F.explode("regions").alias("r")).select("doc_id", "ord", "role", "content", r["page_number"].alias("page"), r["polygon"].alias("polygon"))


def page_texts(boxes: DataFrame) -> DataFrame:
    """The contents of a page's paragraphs in document order, one a line."""
    each = boxes.dropDuplicates(["doc_id", "page", "ord"])
    return each.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("content", F.lit("")).alias("content")))), lambda x: x["content"]), "\n").alias("raw_content"))


def tables(layout: DataFrame) -> DataFrame:
    """One row a table with its page and its ordinal on that page."""
    t = F.col("t")
    flat = layout.select("doc_id", F.posexplode("tables").alias("table_index", "t")).select(
        "doc_id", "table_index", first_region(t["bounding_regions"], "page_number", F.lit(1)).alias("page"), t["bounding_regions"].isNull().alias("page_defaulted"), F.coalesce(t["caption"]["content"], F.lit("")).alias("caption"),
        first_region(t["bounding_regions"], "polygon", F.array().cast("array<double>")).alias("polygon"), t["row_count"].alias("row_count"), t["column_count"].alias("column_count"),
        F.get(t["spans"], F.lit(0))["offset"].alias("start"), t["spans"].alias("spans"), t["cells"].alias("cells"),
    )
    w = Window.partitionBy("doc_id", "page").orderBy("table_index")
    return flat.withColumn("local_index", F.row_number().over(w) - 1)


def cells(table_rows: DataFrame) -> DataFrame:
    c = F.col("c")
    return table_rows.select("doc_id", "table_index", "page", "local_index", "row_count", "column_count", F.posexplode("cells").alias("cell", "c")).select(
        "doc_id", "table_index", "page", "local_index", "row_count", "column_count", "cell", c["kind"].alias("kind"), F.coalesce(c["row_index"], F.lit(0)).alias("row"), F.coalesce(c["column_index"], F.lit(0)).alias("col"),
        F.coalesce(c["row_span"], F.lit(1)).alias("row_span"), F.coalesce(c["column_span"], F.lit(1)).alias("column_span"), c["content"].alias("content"), c["spans"].alias("spans"),
        first_region(c["bounding_regions"], "polygon", F.array().cast("array<double>")).alias("polygon"),
    )


def figures(layout: DataFrame) -> DataFrame:
    """One row for each figure and page that it has a region on, with the first region there."""
    f, r = F.col("f"), F.col("r")
    flat = layout.select("doc_id", F.posexplode("figures").alias("figure_index", "f")).select(
        "doc_id", "figure_index", F.coalesce(f["id"], F.concat(F.lit("fig-"), F.col("figure_index").cast("string"))).alias("figure_id"), f["caption"]["content"].alias("caption"), F.posexplode(f["bounding_regions"]).alias("nth", "r")
    )
    w = Window.partitionBy("doc_id", "figure_index", "page").orderBy("nth")
    return flat.select("doc_id", "figure_index", "figure_id", "caption", "nth", r["page_number"].alias("page"), r["polygon"].alias("polygon")).withColumn("k", F.row_number().over(w)).where("k = 1").drop("k", "nth")


def page_sizes(figure_rows: DataFrame, page_rows: DataFrame) -> DataFrame:
    """figure_rows with page_width and page_height of the page's first entry, 0 where the layout has none."""
    sizes = page_rows.groupBy("doc_id", "page").agg(F.first("width").alias("page_width"), F.first("height").alias("page_height"))
    return figure_rows.join(sizes, ["doc_id", "page"], "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("page_width", "page_height")})


def furniture(boxes: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, box) of the regions of headers, footers and page numbers. boxes: bounding_boxes()."""
    return boxes.where(F.col("role").isin(*config.noise_roles)).select("doc_id", "page", bbox(F.col("polygon")).alias("box")).where("box is not null")


def page_paragraphs(boxes: DataFrame) -> DataFrame:
    """(doc_id, page, box, content): where each paragraph stands and its lower-cased text."""
    return boxes.select("doc_id", "page", bbox(F.col("polygon")).alias("box"), F.lower(F.coalesce("content", F.lit(""))).alias("content")).where("box is not null")


def contained(spans: DataFrame, word_rows: DataFrame) -> DataFrame:
    """spans (doc_id, key..., start, stop) with each word inside, by a bucket of the word's offset; spans without words stay, with nulls.

    A word has one bucket, a span all the buckets it touches, so no pair comes twice and the
    range predicate is only tried within a document's bucket.
    """
    keys = spans.columns
    wide = spans.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start") / BUCKET), F.floor(F.greatest("start", "stop") / BUCKET))))
    w = word_rows.select(F.col("doc_id").alias("w_doc"), F.floor(F.col("start") / BUCKET).alias("w_bucket"), F.col("start").alias("w_start"), F.col("stop").alias("w_stop"), "confidence")
    inside = wide.join(w, (F.col("doc_id") == F.col("w_doc")) & (F.col("bucket") == F.col("w_bucket")) & (F.col("w_start") >= F.col("start")) & (F.col("w_stop") <= F.col("stop")), "left")
    return inside.select(*keys, "confidence")


def cell_confidence(cell_rows: DataFrame, word_rows: DataFrame) -> DataFrame:
    """Each cell with the mean confidence of the words in its spans, null without any."""
    key = ["doc_id", "table_index", "cell"]
    spans = cell_rows.select(*key, F.explode("spans").alias("s")).select(*key, F.col("s.offset").alias("start"), (F.col("s.offset") + F.col("s.length")).alias("stop"))
    means = contained(spans, word_rows).groupBy(*key).agg(F.avg("confidence").alias("confidence"))
    return cell_rows.join(means, key, "left")


def table_confidence(measured: DataFrame, angles: DataFrame | None = None, config: Config = DEFAULT) -> DataFrame:
    """Per table: mean and least of the cells' means (1.0 without words), unmatched cells, reasons of complexity, whether a second reading is due."""
    key = ["doc_id", "table_index", "page", "local_index"]
    if angles is None:
        own = measured.withColumn("angle", F.lit(0.0))
    else:
        own = measured.join(angles.groupBy("doc_id", "page").agg(F.first("angle").alias("angle")), ["doc_id", "page"], "left").withColumn("angle", F.coalesce("angle", F.lit(0.0)))
    size = F.length(strip(F.coalesce("content", F.lit(""))))
    w, h = F.array_max(xs(F.col("polygon"))) - F.array_min(xs(F.col("polygon"))), F.array_max(ys(F.col("polygon"))) - F.array_min(ys(F.col("polygon")))
    shaped = own.withColumn("size", size).withColumn("w", F.when(F.size("polygon") >= 8, w)).withColumn("h", F.when(F.size("polygon") >= 8, h))
    columns = shaped.groupBy(*key, "col").agg(
        F.max("w").alias("widest"), F.sum("confidence").alias("total"), F.count("confidence").alias("n"), F.min("confidence").alias("least"), F.count("*").alias("cells"),
        F.count_if(F.col("confidence").isNull() & (F.col("size") > 0)).alias("unmatched"), F.count_if((F.col("row_span") > 1) & ~F.col("kind").eqNullSafe("columnHeader")).alias("merged"),
        F.count_if((F.abs("angle") < 45) & (F.col("w") > 0) & (F.col("h") > 5 * F.col("w")) & (F.col("size") > 3)).alias("rotated"), F.count_if(F.col("size") > 500).alias("long"),
    )
    t = columns.groupBy(*key).agg(
        F.coalesce(F.try_divide(F.sum("total"), F.sum("n")), F.lit(1.0)).alias("average_cell_confidence"), F.coalesce(F.min("least"), F.lit(1.0)).alias("min_cell_confidence"), F.sum("cells").cast("int").alias("cell_count"),
        F.sum("unmatched").cast("int").alias("unmatched_cells"), F.sum("merged").alias("merged"), F.sum("rotated").alias("rotated"), F.sum("long").alias("long"), F.count("widest").alias("columns"), F.max("widest").alias("max_w"), F.min("widest").alias("min_w"),
    )
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    ratio = F.try_divide("max_w", "min_w")
    reasons = all_of([
        (F.col("merged") > 0, text("rowSpan>1 on ", F.col("merged"), " cell(s)")),
        (F.col("rotated") > 0, text("rotated cells (", F.col("rotated"), " cell(s) with h/w>5)")),
        (F.col("long") > 0, text("paragraph-length cells (", F.col("long"), " cell(s) >500 chars)")),
        ((F.col("columns") > 1) & (F.col("min_w") > 0) & (ratio > 10) & (F.col("max_w") > 3.0), text("column width disparity (", formatted(ratio, "0"), ":1 ratio)")),
    ])
    done = t.withColumn("complexity_reasons", reasons).withColumn("has_complex_structure", F.size("complexity_reasons") > 0)
    done = done.withColumn("requires_ocr", (F.col("min_cell_confidence") < config.table_confidence) | F.col("has_complex_structure"))
    return done.select(*key, "average_cell_confidence", "min_cell_confidence", "cell_count", "unmatched_cells", "requires_ocr", "has_complex_structure", "complexity_reasons")


def route_pages(page_rows: DataFrame, table_rows: DataFrame, figure_rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Pages (doc_id, page) with needs_ocr and the number of tables of low confidence.

    table_rows: (doc_id, page, requires_ocr, box); figure_rows: (doc_id, page, box). Without a
    second reader no page needs it, but low tables are still counted.
    """
    low = table_rows.groupBy("doc_id", "page").agg(F.bool_or("requires_ocr").alias("low"), F.count_if("requires_ocr").cast("int").alias("low_conf_tables"))
    f = figure_rows.select(F.col("doc_id").alias("f_doc"), F.col("page").alias("f_page"), F.col("box").alias("f_box"))
    hit = table_rows.join(f, (F.col("doc_id") == F.col("f_doc")) & (F.col("page") == F.col("f_page")) & overlaps(F.col("box"), F.col("f_box")), "left_semi").select("doc_id", "page").distinct().withColumn("hit", F.lit(True))
    both = page_rows.join(low, ["doc_id", "page"], "left").join(hit, ["doc_id", "page"], "left")
    due = F.coalesce("low", F.lit(False)) | (F.coalesce("hit", F.lit(False)) & F.lit(config.ocr_figure_routing))
    return both.select("doc_id", "page", (due & F.lit(config.ocr_enabled)).alias("needs_ocr"), F.coalesce("low_conf_tables", F.lit(0)).alias("low_conf_tables"))


def route_documents(routed: DataFrame) -> DataFrame:
    listed = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("page"))))
    return routed.groupBy("doc_id").agg(F.count("*").cast("int").alias("total_pages"), listed(F.col("needs_ocr")).alias("pages_for_ocr"), listed(~F.col("needs_ocr")).alias("layout_only_pages"), F.sum("low_conf_tables").cast("int").alias("low_conf_tables"))
