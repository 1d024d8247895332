"""Tables as rows of text: dense grids, fills, headers, pipe tables, lead-ins, the choice of the reader."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from leafmill.config import DEFAULT, Config
from leafmill.functions import grids
from leafmill.functions.geometry import union_polygon
from leafmill.functions.text import SPACE, all_of, checkbox_text, last_sentences, percent, row_text, strip, table_chunk_id

TABLE = ["doc_id", "table_index"]


def cell_grid(cells: DataFrame) -> DataFrame:
    """(doc_id, table_index, row, col, text, spanned): spans laid out within the bounds; of several texts at a place the last non-empty one stays."""
    spread = cells.where("row_count > 0 and column_count > 0 and row < row_count and col < column_count").select(
        *TABLE, "cell", F.col("row").alias("first_row"), "row_span", checkbox_text(F.col("content")).alias("text"), "col", "column_span", "column_count",
        F.explode(F.sequence("row", F.least(F.col("row") + F.greatest("row_span", F.lit(1)), F.col("row_count")) - 1)).alias("row"),
    ).withColumn("col", F.explode(F.sequence("col", F.least(F.col("col") + F.greatest("column_span", F.lit(1)), F.col("column_count")) - 1)))
    laid = spread.groupBy(*TABLE, "row", "col").agg(F.max_by("text", F.when(F.col("text") != "", F.col("cell"))).alias("text"), F.bool_or((F.col("row_span") > 1) & (F.col("row") > F.col("first_row"))).alias("spanned"))
    scaffold = cells.where("row_count > 0 and column_count > 0").select(*TABLE, "row_count", "column_count").distinct().select(*TABLE, F.explode(F.sequence(F.lit(0), F.col("row_count") - 1)).alias("row"), "column_count").select(*TABLE, "row", F.explode(F.sequence(F.lit(0), F.col("column_count") - 1)).alias("col"))
    return scaffold.join(laid, [*TABLE, "row", "col"], "left").select(*TABLE, "row", "col", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("spanned", F.lit(False)).alias("spanned"))


def fill_label_runs(grid: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Within a run of rows of one non-empty label in column 0, a column with a single non-blank cell gets it in all rows."""
    keys = keys or TABLE
    label = F.max(F.when(F.col("col") == 0, F.col("text"))).over(Window.partitionBy(*keys, "row"))
    by_col = Window.partitionBy(*keys, "col").orderBy("row")
    marked = grid.withColumn("label", label)
    marked = marked.withColumn("new", F.coalesce((F.col("label") != F.lag("label").over(by_col)).cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(by_col))
    run = Window.partitionBy(*keys, "col", "run")
    filled = F.col("text").rlike(f"[^{SPACE[1:-1]}]")
    only = (F.count("*").over(run) > 1) & (F.col("label") != "") & (F.col("col") > 0) & (F.count_if(filled).over(run) == 1)
    return marked.withColumn("text", F.when(only, F.max(F.when(filled, F.col("text"))).over(run)).otherwise(F.col("text"))).select(*grid.columns)


def fill_right(cells: Column, layout: Column) -> Column:
    """From left to right a blank cell takes its left neighbour's text if the layout's own text there is another one contained in it."""

    def step(acc: Column, x: Column) -> Column:
        left, own = F.coalesce(F.element_at(F.when(F.size(acc) > 0, acc), -1), F.lit("")), strip(F.coalesce(x["cell"], F.lit("")))
        there = strip(F.coalesce(x["layout"], F.lit("")))
        take = (own == "") & (left != "") & (there != "") & (there != left) & F.contains(left, there)
        return F.concat(acc, F.array(F.when(take, left).otherwise(own)))

    return F.aggregate(F.transform(cells, lambda c, i: F.struct(c.alias("cell"), F.get(layout, i).alias("layout"))), F.array().cast("array<string>"), step)


def fill_down(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds filled: a spanned cell takes the layout's text, others their own, blanks the last one seen in the column.

    rows: keys name a column of a table; text, layout, spanned (true on a span's later rows).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    spanned = F.col("spanned") | F.coalesce(F.lead("spanned").over(w), F.lit(False))
    own = F.when(spanned & (strip(F.coalesce("layout", F.lit(""))) != ""), strip(F.col("layout"))).when(F.col("text") != "", F.col("text"))
    return rows.withColumn("seen", own).withColumn("filled", F.coalesce(F.last("seen", True).over(w), F.lit(""))).drop("seen")


def fused_headers(cells: DataFrame) -> DataFrame:
    """(doc_id, table_index, headers): per column the header cells' texts from top to bottom, joined by ' / '."""
    text = F.regexp_replace(strip(F.coalesce("content", F.lit(""))), f"{SPACE}+", " ")
    head = cells.where("kind = 'columnHeader'").select(*TABLE, "row", "col", "column_count", text.alias("text"), F.explode(F.sequence("col", F.col("col") + F.greatest("column_span", F.lit(1)) - 1)).alias("at")).where("text <> '' and at < column_count")
    each = head.groupBy(*TABLE, "at").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "col", "text"))), lambda x: x["text"]), " / ").alias("text"))
    whole = each.groupBy(*TABLE).agg(F.map_from_entries(F.collect_list(F.struct("at", "text"))).alias("by_col"))
    sized = cells.select(*TABLE, "column_count").distinct().join(whole, TABLE, "left")
    none = F.array().cast("array<string>")
    return sized.select(*TABLE, F.when(F.col("column_count") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("column_count") - 1, F.lit(0))), lambda i: F.coalesce(F.try_element_at("by_col", i), F.lit("")))).otherwise(none).alias("headers"))


def table_label(caption: Column, headers: Column, first_row: Column) -> Column:
    """Caption, else the non-empty headers, else the first row's cells."""
    some = lambda a: F.array_join(F.filter(a, lambda x: x != ""), " | ")
    return F.coalesce(F.nullif(strip(F.coalesce(caption, F.lit(""))), F.lit("")), F.nullif(some(headers), F.lit("")), some(first_row), F.lit(""))


def pipe_lines(markdown: Column) -> Column:
    """Lines, with a row that was broken off put together again: what follows an open pipe row without beginning a row belongs to it."""

    def step(acc: Column, line: Column) -> Column:
        t, last = strip(line), strip(F.coalesce(F.element_at(F.when(F.size(acc) > 0, acc), -1), F.lit("")))
        open_row = last.startswith("|") & ~last.endswith("|") & ~t.startswith("|")
        whole = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.concat(F.regexp_replace(F.element_at(F.when(F.size(acc) > 0, acc), -1), f"{SPACE}+$", ""), F.lit(" "), t)))
        return F.when(open_row, whole).otherwise(F.concat(acc, F.array(line)))

    return F.aggregate(F.split(markdown, "\n", -1), F.array().cast("array<string>"), step)


def pipe_tables(pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., local_index, is_header, row, cells) of the pipe tables in markdown; tables without rows don't count."""
    lines = pages.select(*keys, F.posexplode(pipe_lines(F.col("markdown"))).alias("ord", "line")).withColumn("line", strip(F.col("line")))
    w = Window.partitionBy(*keys).orderBy("ord")
    row = F.col("line").startswith("|") & F.col("line").endswith("|") & (F.length("line") > 1)
    marked = lines.withColumn("is_row", row).withColumn("island", F.sum(F.when(F.col("is_row"), 0).otherwise(1)).over(w)).where("is_row")
    inside = Window.partitionBy(*keys, "island").orderBy("ord")
    separator = F.col("line").rlike(f"^\\|(?:{SPACE}|[-|:])+\\|$")
    told = marked.withColumn("separator", separator).withColumn("past", F.coalesce(F.max("separator").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))).where("not separator")
    kinds = Window.partitionBy(*keys, "island", "past").orderBy("ord")
    return told.select(
        *keys, (F.dense_rank().over(Window.partitionBy(*keys).orderBy("island")) - 1).alias("local_index"), (~F.col("past")).alias("is_header"), (F.row_number().over(kinds) - 1).alias("row"),
        F.transform(F.slice(F.split("line", "\\|", -1), F.lit(2), F.greatest(F.size(F.split("line", "\\|", -1)) - 2, F.lit(0))), strip).alias("cells"),
    )


def nearest_before(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: Column, order: str) -> DataFrame:
    """left with found: the value of the right row of greatest `at` strictly below its own, of equal ones the least order.

    An as-of join as one sort per key: both sides in one stream, no pair is ever made. Right
    rows whose value is '' don't count. `at` must be a whole number on both sides.
    """
    cand = right.select(*keys, F.col(at).cast("bigint").alias("at"), F.struct(F.col(at).cast("bigint").alias("at"), (-F.col(order)).alias("o"), value.alias("v")).alias("c")).where("c.v <> ''")
    rows = left.withColumn("row__", F.struct(*left.columns))
    both = rows.select(*keys, F.col(at).cast("bigint").alias("at"), F.lit(None).cast(cand.schema["c"].dataType).alias("c"), "row__").unionByName(cand.withColumn("row__", F.lit(None).cast(rows.schema["row__"].dataType)))
    w = Window.partitionBy(*keys).orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    return both.withColumn("c", F.max("c").over(w)).where("row__ is not null").select("row__.*", F.coalesce(F.col("c.v"), F.lit("")).alias("found"))


def lead_in_candidates(paragraphs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(doc_id, page, start, ord, value): where each paragraph of the body ends, on each of its pages, and its last two sentences."""
    last = F.element_at(F.when(F.size("spans") > 0, F.col("spans")), -1)
    own = paragraphs.where(~F.col("role").isin(*config.noise_roles) & (F.size("spans") > 0)).withColumn("value", last_sentences(F.col("content"), 2, config.lead_in_min_chars))
    return own.select("doc_id", F.explode(F.array_distinct(F.transform("regions", lambda r: r["page_number"]))).alias("page"), (last["offset"] + last["length"]).alias("start"), "ord", "value")


def lead_ins(tables: DataFrame, paragraphs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(doc_id, table_index, lead_in): the last two sentences of the nearest earlier paragraph of the page that has any."""
    far = tables.select("doc_id", "table_index", "page", F.coalesce(F.col("start").cast("bigint"), F.lit(1 << 62)).alias("start"))
    own = lead_in_candidates(paragraphs, config)
    return nearest_before(far, own, ["doc_id", "page"], "start", F.col("value"), "ord").select("doc_id", "table_index", F.col("found").alias("lead_in"))


def choose_reader(t: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds source (layout, ocr, none) and flag_types.

    t: has_markdown, page_ocr_tables, has_ocr_table, min_cell_confidence, rotated,
    max_header_row, ocr_rows, layout_rows.
    """
    artifact = F.col("has_markdown") & (F.col("page_ocr_tables") == 0) & F.coalesce(F.col("min_cell_confidence") < config.artifact_confidence, F.lit(False))
    ratio = F.when(F.col("layout_rows") > 0, F.col("ocr_rows") / F.col("layout_rows")).otherwise(1.0)
    ocr, levels, few = F.col("has_markdown") & F.col("has_ocr_table"), F.col("max_header_row") >= 2, ratio < config.fragmentation
    kept = ocr & ~(F.col("rotated") | levels | few)
    flags = F.when(artifact, F.array(F.lit("image_artifact"))).when(ocr & ~kept, all_of([(few, "row_count_mismatch"), (levels, "multi_header")])).otherwise(F.array().cast("array<string>"))
    return t.withColumn("source", F.when(artifact, "none").when(kept, "ocr").otherwise("layout")).withColumn("flag_types", flags)


def row_chunks(rows: DataFrame) -> DataFrame:
    """Chunks of table rows: (doc_id, source, source_file, page, table_index, row, cells, headers, label, lead_in, polygons) in, blank rows out."""
    text = row_text(F.col("cells"), F.col("headers"), F.col("label"), F.col("lead_in"))
    done = rows.withColumn("text_for_embedding", text).where(strip(F.col("text_for_embedding")) != "")
    return done.select(
        table_chunk_id(F.col("doc_id"), F.col("table_index"), F.col("row")).alias("chunk_id"), F.lit("table_row").alias("type"), "source", "source_file", "text_for_embedding", F.lit(None).cast("string").alias("image_blob"),
        F.col("doc_id").alias("document_id"), "page", union_polygon(F.col("polygons")).alias("bounding_polygon"), "table_index", F.col("row").alias("row_index"), F.lit(None).cast("int").alias("figure_index"),
    )


def described_tables(layout_tables: DataFrame, cells: DataFrame, paragraphs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(doc_id, table_index, page, local_index, caption, headers, label, lead_in, max_header_row) of each table."""
    none = F.array().cast("array<string>")
    top = cells.where("row = 0").groupBy(*TABLE).agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "cell", checkbox_text(F.col("content")).alias("text")))), lambda x: x["text"]).alias("first_row"))
    levels = cells.where("kind = 'columnHeader'").groupBy(*TABLE).agg(F.max("row").alias("max_header_row"))
    told = layout_tables.select(*TABLE, "page", "local_index", "caption").join(fused_headers(cells), TABLE, "left").join(top, TABLE, "left").join(lead_ins(layout_tables, paragraphs, config), TABLE, "left").join(levels, TABLE, "left")
    told = told.withColumn("headers", F.coalesce("headers", none)).withColumn("max_header_row", F.coalesce("max_header_row", F.lit(0)))
    return told.withColumn("label", table_label(F.col("caption"), F.col("headers"), F.coalesce("first_row", none))).drop("first_row")


def body_rows(cells: DataFrame) -> DataFrame:
    """(doc_id, table_index, row, nth, polygons): the rows that have a cell of the body, counted from 0 in nth."""
    body = cells.where("not kind <=> 'columnHeader'")
    rows = body.groupBy(*TABLE, "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "polygon"))), lambda x: x["polygon"]).alias("polygons"))
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*TABLE).orderBy("row")) - 1)


def body_grid(cells: DataFrame) -> DataFrame:
    """cell_grid() of the body's cells, down to its last row."""
    body = cells.where("not kind <=> 'columnHeader'")
    last = body.groupBy(*TABLE).agg((F.max("row") + 1).alias("row_count"))
    return cell_grid(body.drop("row_count").join(last, TABLE))


def by_row(grid: DataFrame, value: str) -> DataFrame:
    """(doc_id, table_index, row, cells) of a grid's column named value."""
    return grid.groupBy(*TABLE, "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", F.col(value).alias("v")))), lambda x: x["v"]).alias("cells"))


def layout_row_chunks(layout_tables: DataFrame, cells: DataFrame, paragraphs: DataFrame, source_file: Column, config: Config = DEFAULT) -> DataFrame:
    """Row chunks of layout tables, without a second reader."""
    told = described_tables(layout_tables, cells, paragraphs, config)
    rows = by_row(fill_label_runs(body_grid(cells)), "text").join(body_rows(cells), [*TABLE, "row"])
    return row_chunks(rows.join(told, TABLE).withColumn("source", F.lit("layout")).withColumn("source_file", source_file))


def second_reader_rows(chosen: DataFrame, second: DataFrame, rows: DataFrame, grid: DataFrame) -> DataFrame:
    """(doc_id, table_index, row, cells, polygons) of the tables that the second reader gives, filled to the right and down.

    Its rows meet the layout's by their place in the table; one beyond the last has blank layout
    values and its place for a row number. Rows are padded to the table's widest.
    """
    theirs = chosen.where("source = 'ocr'").select(*TABLE, "page", "local_index").join(second.where("not is_header").withColumnRenamed("row", "nth"), ["doc_id", "page", "local_index"])
    widest = theirs.groupBy(*TABLE).agg(F.max(F.size("cells")).alias("width"))
    lines = grid.groupBy(*TABLE, "row").agg(F.array_sort(F.collect_list(F.struct("col", "text", "spanned"))).alias("line"))
    met = theirs.join(widest, TABLE).join(rows, [*TABLE, "nth"], "left").join(lines, [*TABLE, "row"], "left")
    columns = F.sequence(F.lit(0), F.col("width") - 1)
    layout = F.transform(columns, lambda i: F.coalesce(F.get(F.col("line"), i)["text"], F.lit("")))
    spans = F.transform(columns, lambda i: F.coalesce(F.get(F.col("line"), i)["spanned"], F.lit(False)))
    padded = F.transform(columns, lambda i: F.coalesce(F.get(F.col("cells"), i), F.lit("")))
    right = met.where("width > 0").withColumn("layout", layout).withColumn("cells", fill_right(padded, layout)).withColumn("spans", spans)
    flat = right.select(*TABLE, "nth", F.coalesce("row", "nth").alias("row"), F.posexplode(F.arrays_zip("cells", "layout", "spans")).alias("col", "x")).select(*TABLE, "nth", "row", "col", F.col("x.cells").alias("text"), F.col("x.layout").alias("layout"), F.col("x.spans").alias("spanned"))
    down = fill_down(flat, [*TABLE, "col"], ["nth"])
    done = down.groupBy(*TABLE, "nth", "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "filled"))), lambda x: x["filled"]).alias("cells"))
    return done.join(rows.select(*TABLE, "nth", "polygons"), [*TABLE, "nth"], "left").select(*TABLE, "row", "cells", F.coalesce("polygons", F.array().cast("array<array<double>>")).alias("polygons"))


_ROWS = "rows: array<struct<row: int, cells: array<string>, polygons: array<array<double>>>>, blanks: bigint, n: bigint"
_READ = f"table_index int, page int, local_index int, caption string, headers array<string>, first_row array<string>, lead_in string, max_header_row int, has_markdown boolean, page_ocr_tables int, has_ocr_table boolean, ocr_rows int, ocr_headers array<string>, layout_rows int, min_cell_confidence double, rotated boolean, layout struct<{_ROWS}>, ocr struct<{_ROWS}>"
_PART = "part int, doc_id {}, table_index int, page int, local_index int, cell int, head boolean, row int, col int, row_span int, column_span int, column_count int, at bigint, text string, polygon array<double>, confidence double, rotated boolean"
_TABLE, _CELL, _MARKDOWN, _CONFIDENCE, _LEAD = range(5)


def _read_document(doc: object, parts: list[tuple]) -> Iterator[dict]:
    """One row of doc_id and _READ for each table of a document; parts: rows of _PART without part and doc_id."""
    own, cells, markdown, sure, leads = [], {}, {}, {}, {}
    for part, _, table_index, page, local_index, cell, head, row, col, row_span, column_span, column_count, at, text, polygon, confidence, rotated in parts:
        if part == _CELL:
            cells.setdefault(table_index, []).append(grids.Cell(cell, bool(head), row, col, row_span, column_span, column_count, text, polygon))
        elif part == _TABLE:
            own.append((table_index, page, local_index, text, at))
        elif part == _MARKDOWN:
            markdown.setdefault(page, []).append(text)
        elif part == _CONFIDENCE:
            sure[page, local_index] = (confidence, bool(rotated))
        else:
            leads.setdefault(page, []).append(((at is not None, at), (cell is not None, -(cell or 0)), text))
    pages = {page: [t for text in texts for t in grids.pipe_tables(text)] for page, texts in markdown.items() if page is not None}
    for found in leads.values():
        found.sort()
    for table_index, page, local_index, caption, start in own:
        here, second = cells.get(table_index, []), pages.get(page, [])
        met = local_index is not None and 0 <= local_index < len(second)
        heads, theirs = second[local_index] if met else ([], [])
        confidence, rotated = sure.get((page, local_index), (None, False)) if page is not None and local_index is not None else (None, False)
        before = leads.get(page, [])
        nearest = bisect_left(before, ((True, start),)) - 1
        columns = max((c.column_count for c in here if c.column_count is not None), default=0)
        body = [c for c in here if not c.head]
        rows = grids.body_rows(body)
        height = max((r + 1 for r, _ in rows if r is not None), default=0) if columns > 0 else 0
        texts, spanned = grids.grid(body, max(0, height), columns)
        filled = grids.fill_label_runs(texts)
        laid = [(r, filled[r], polygons) for r, polygons in rows if r is not None and 0 <= r < len(filled)]
        read = grids.second_rows(theirs, rows, texts, spanned)
        sized = [{"rows": [{"row": r, "cells": c, "polygons": p} for r, c, p in x], "blanks": sum(not v.strip() for _, c, _ in x for v in c), "n": sum(len(c) for _, c, _ in x)} for x in (laid, read)]
        yield {
            "doc_id": doc, "table_index": table_index, "page": page, "local_index": local_index, "caption": caption, "headers": grids.headers(here, columns), "first_row": grids.first_row(here), "lead_in": before[nearest][2] if nearest >= 0 else "",
            "max_header_row": max((c.row for c in here if c.head and c.row is not None), default=0), "has_markdown": page in pages, "page_ocr_tables": len(second), "has_ocr_table": met, "ocr_rows": len(theirs), "ocr_headers": heads[-1] if heads else None,
            "layout_rows": len(rows), "min_cell_confidence": confidence, "rotated": rotated, "layout": sized[0], "ocr": sized[1],
        }


def both_readings(layout_tables: DataFrame, cells: DataFrame, paragraphs: DataFrame, confidence: DataFrame, markdown: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row a table with what choose_reader() asks for and its rows by either reader; tables of the two meet by their place on the page.

    All parts of a document come together in one shuffle and are read there, a document at a
    time; no other shuffle or sort is needed, and a task holds one document.
    """
    kind = layout_tables.schema["doc_id"].dataType
    columns = [c.split() for c in _PART.format(kind.simpleString()).split(", ")]

    def part(df: DataFrame, number: int, **given: Column | str) -> DataFrame:
        given |= {"part": F.lit(number)} | ({} if number == _TABLE else {"doc_id": "doc_id"})
        blank = lambda t: F.array() if t.startswith("array") else F.lit("") if t == "string" else F.lit(False) if t == "boolean" else F.lit(0)  # noqa: E731  never read, and cheaper than nulls
        return df.select(*[(F.col(v) if isinstance(v := given.get(n, blank(t)), str) else v).cast(t).alias(n) for n, t in columns])

    parts = [
        part(layout_tables, _TABLE, doc_id="doc_id", table_index="table_index", page="page", local_index="local_index", text="caption", at=F.coalesce(F.col("start").cast("bigint"), F.lit(1 << 62))),
        part(cells, _CELL, table_index="table_index", cell="cell", head=F.col("kind").eqNullSafe("columnHeader"), row="row", col="col", row_span="row_span", column_span="column_span", column_count="column_count", text="content", polygon="polygon"),
        part(markdown.where("markdown <> ''"), _MARKDOWN, page="page", text="markdown"),
        part(confidence, _CONFIDENCE, page="page", local_index="local_index", confidence="min_cell_confidence", rotated=F.exists("complexity_reasons", lambda r: F.contains(r, F.lit("rotated")))),
        part(lead_in_candidates(paragraphs, config).where("value <> ''"), _LEAD, page="page", at="start", cell="ord", text="value"),
    ]
    out = f"doc_id {kind.simpleString()}, {_READ}"
    schema = to_arrow_schema(StructType.fromDDL(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, held, done, size = None, [], [], 0
        for batch in batches:
            values = zip(*[grids.plain_values(c) for c in batch.columns], strict=True)
            for of, rows in groupby(values, key=itemgetter(1)):
                if held and of != doc:
                    done.extend(_read_document(doc, held))
                    size, held = size + len(held), []
                    if size >= 20_000:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done, size = [], 0
                doc = of
                held.extend(rows)
        if held:
            done.extend(_read_document(doc, held))
        yield pa.RecordBatch.from_pylist(done, schema)

    return reduce(DataFrame.union, parts).repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(run, out)


def table_path(layout_tables: DataFrame, cells: DataFrame, paragraphs: DataFrame, confidence: DataFrame, markdown: DataFrame, source_file: Column, config: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(chunks, report) of the tables read by either reader.

    chunks as row_chunks(); report: (doc_id, page, table_index, local_index, caption, source,
    flag_types, empty_ratio, flagged), one row a table, image artifacts included.
    """
    chosen = choose_reader(both_readings(layout_tables, cells, paragraphs, confidence, markdown, config), config)
    chosen = chosen.withColumn("read", F.when(F.col("source") == "ocr", F.col("ocr")).when(F.col("source") == "layout", F.col("layout")))
    headers = F.when((F.col("source") == "ocr") & F.col("ocr_headers").isNotNull(), F.col("ocr_headers")).otherwise(F.col("headers"))
    label = table_label(F.col("caption"), F.col("headers"), F.col("first_row"))
    full = chosen.select(*TABLE, "page", "source", headers.alias("headers"), label.alias("label"), "lead_in", F.explode("read.rows").alias("r")).select("*", "r.row", "r.cells", "r.polygons").drop("r").withColumn("source_file", source_file)
    ratio = F.coalesce(F.col("read.blanks") / F.greatest("read.n", F.lit(1)), F.lit(0.0))
    report = chosen.withColumn("empty_ratio", F.when(F.col("source") == "none", 0.0).otherwise(ratio))
    flags = F.concat("flag_types", F.when(F.col("empty_ratio") > config.empty_ratio, F.array(F.lit("high_empty_ratio"))).otherwise(F.array().cast("array<string>")))
    report = report.withColumn("flag_types", flags).withColumn("flagged", F.size("flag_types") > 0)
    return row_chunks(full), report.select("doc_id", "page", "table_index", "local_index", "caption", "source", "flag_types", "empty_ratio", "flagged")


def flags_text(report: DataFrame) -> DataFrame:
    """(doc_id, text): each document's flagged tables for review, as Markdown."""
    name = F.when(F.col("caption") != "", F.concat(F.lit('"'), "caption", F.lit('"'))).otherwise(F.concat(F.lit("Table "), F.col("local_index").cast("string")))
    entry = F.concat(F.lit("## Page "), F.col("page").cast("string"), F.lit(" · Table "), F.col("local_index").cast("string"), F.lit(" · source: "), "source", F.lit("\n**"), name, F.lit("**\n\n"), F.array_join(F.transform("flag_types", lambda f: F.concat(F.lit("- `"), f, F.lit("`"))), "\n"))
    listed = F.array_sort(F.collect_list(F.when(F.col("flagged"), F.struct("page", "table_index", entry.alias("e")))))
    return report.groupBy("doc_id").agg(listed.alias("l")).select("doc_id", F.when(F.size("l") == 0, "# Flagged tables\n\nNone.\n").otherwise(F.concat(F.lit("# Flagged tables\n\n"), F.array_join(F.transform("l", lambda x: x["e"]), "\n\n"), F.lit("\n"))).alias("text"))


def table_stats(t: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., total, ocr_tables, ocr_share, flagged): counts and shares rounded half to even."""
    return t.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(F.col("source") == "ocr").alias("ocr_tables"), percent(F.count_if(F.col("source") == "ocr"), F.count("*")).alias("ocr_share"), F.count_if(F.col("flagged")).alias("flagged"))
