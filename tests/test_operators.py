"""Operators on small tables, and the sliding window against a plain loop."""

import json
import random

import pytest
from pyspark.sql import functions as F

from leafmill.operators import figures, layout, paragraphs, search, tables
from leafmill.sources import artifacts, providers


def loop(tokens, limit=500, overlap=100):
    out, lo, plo, i = [], 0, 0, 0
    for i, _ in enumerate(tokens):
        if sum(tokens[lo : i + 1]) >= limit:
            out.append((lo, i, plo))
            n = 0
            while n < i - lo + 1 and sum(tokens[i - n : i + 1]) <= overlap:
                n += 1
            lo, plo = i + 1 - n, i
    return out + ([(lo, len(tokens) - 1, plo)] if lo < len(tokens) else [])


def test_window_ranges(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1, 5, 40, 90, 100, 101, 260, 700]) for _ in range(rng.randint(1, 40))]) for i in range(120)]
    df = spark.createDataFrame(rows, "i int, t array<int>").select("i", paragraphs.window_ranges(F.col("t"), 500, 100).alias("r"))
    got = {r.i: [tuple(x) for x in r.r] for r in df.collect()}
    assert all(got[i] == loop(t) for i, t in rows)


def grid(spark, rows):
    return spark.createDataFrame([("d", 0, r, c, t) for r, row in enumerate(rows) for c, t in enumerate(row)], "doc_id string, table_index int, row int, col int, text string")


def dense(df, n, column="text"):
    got = {(r["row"], r["col"]): r[column] for r in df.collect()}
    return [[got[r, c] for c in range(n)] for r in range(len(got) // n)]


def test_label_runs(spark):
    got = dense(tables.fill_label_runs(grid(spark, [["A", "", "x"], ["A", "v", "y"], ["B", "", ""], ["", "q", ""], ["", "", ""]])), 3)
    assert got == [["A", "v", "x"], ["A", "v", "y"], ["B", "", ""], ["", "q", ""], ["", "", ""]]


def test_cell_grid(spark):
    cells = [("d", 0, 0, "content", 0, 0, 2, 2, ":selected:"), ("d", 0, 1, "content", 1, 1, 1, 1, ""), ("d", 0, 2, "content", 2, 0, 5, 5, "z")]
    df = spark.createDataFrame(cells, "doc_id string, table_index int, cell int, kind string, row int, col int, row_span int, column_span int, content string").withColumn("row_count", F.lit(3)).withColumn("column_count", F.lit(2))
    laid = tables.cell_grid(df)
    assert dense(laid, 2) == [["checked", "checked"], ["checked", "checked"], ["z", "z"]]
    assert dense(laid, 2, "spanned") == [[False, False], [True, True], [False, False]]


def test_fill_right_and_down(spark):
    row = spark.createDataFrame([(["a b", "", "", "x"], ["a", "a", "b", "x"]), (["a", "", "q"], ["a", "zz"])], "c array<string>, l array<string>")
    assert [r.v for r in row.select(tables.fill_right(F.col("c"), F.col("l")).alias("v")).collect()] == [["a b", "a b", "a b", "x"], ["a", "", "q"]]
    rows = [("t", 0, "", "L", False), ("t", 1, "x", "M", True), ("t", 2, "", "", False), ("t", 3, "y", "N", False), ("t", 4, "", "", False)]
    df = spark.createDataFrame(rows, "t string, r int, text string, layout string, spanned boolean")
    assert [r.filled for r in tables.fill_down(df, ["t"], ["r"]).orderBy("r").collect()] == ["L", "M", "M", "y", "y"]


def test_pipe_tables(spark):
    md = "intro\n| A | B |\n| --- | :-: |\n| 1 | two\nmore |\n\n| x |\ntext | not\n|---|\n"
    got = tables.pipe_tables(spark.createDataFrame([(1, md)], "id int, markdown string"), ["id"]).orderBy("local_index", F.desc("is_header"), "row").collect()
    assert [(r.local_index, r.is_header, r.row, r.cells) for r in got] == [(0, True, 0, ["A", "B"]), (0, False, 0, ["1", "two more"]), (1, True, 0, ["x"])]


def test_qualify(spark):
    rows = [(0.3, 0.5, 1.0, "", False), (0.3, 0.5, 1.0, "", True), (0.0, 0.005, 1.0, "c", False), (0.0, 0.5, 9.0, "", False), (0.0, 0.95, 9.0, "cap", False), (0.0, 0.005, 8.0, "", True)]
    df = spark.createDataFrame(rows, "header_overlap_ratio double, area_ratio double, aspect_ratio double, caption string, has_reference boolean").withColumn("footer_overlap_ratio", F.lit(0.0))
    got = [(r.rejection_reason, r.routing_signals) for r in figures.qualified(df).collect()]
    assert got == [("structural_noise", []), (None, ["caption_missing", "furniture_overlap_with_reference"]), ("low_value_graphic", []), ("decorative_geometry", []), (None, ["full_page_graphic"]), (None, ["caption_missing", "small_figure_with_reference"])]


def test_vision_outcomes(spark):
    whole = {"is_meaningful": False, "category": "logo", "model_confidence_label": "high", "contains_text": False, "short_description": "", "needs_larger_context_crop": False}
    whole |= {k: [] for k in ("visible_labels", "device_or_component_terms", "procedure_actions", "warnings_or_constraints", "search_keywords", "uncertainty")}
    replies = [whole, whole | {"model_confidence_label": "low"}, whole | {"is_meaningful": True}, whole | {"category": "cat"}, whole | {"extra": 1}, {"is_meaningful": True}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(replies)] + [(6, "no json"), (7, None)], "i int, reply string")
    got = [r.o for r in df.select("i", figures.vision_outcome(figures.parsed_understanding(F.col("reply"))).alias("o")).orderBy("i").collect()]
    assert got == ["reject", "retain_low_confidence", "retain"] + ["retain_unverified"] * 5


LAYOUT = {
    "docId": "d",
    "pages": [{"pageNumber": 1, "width": 8.5, "height": 11.0, "angle": 0.0, "words": [{"content": "a", "confidence": 0.5, "span": {"offset": 60, "length": 1}}, {"content": "b", "confidence": 0.9, "span": {"offset": 62, "length": 1}}, {"content": "c", "confidence": 1.0, "span": {"offset": 700, "length": 2}}]}],
    "paragraphs": [{"role": None, "content": "This paragraph leads in to the table below.", "spans": [{"offset": 0, "length": 40}], "boundingRegions": [{"pageNumber": 1, "polygon": [0, 0, 1, 0, 1, 1, 0, 1]}]}, {"role": "pageHeader", "content": "Head", "spans": [{"offset": 45, "length": 4}], "boundingRegions": [{"pageNumber": 1, "polygon": [0, 0, 1, 0, 1, 1, 0, 1]}]}],
    "tables": [{"rowCount": 2, "columnCount": 2, "spans": [{"offset": 60, "length": 700}], "boundingRegions": [{"pageNumber": 1, "polygon": [0, 2, 1, 2, 1, 3, 0, 3]}], "cells": [
        {"kind": "columnHeader", "rowIndex": 0, "columnIndex": 0, "content": "H", "columnSpan": 2, "spans": [{"offset": 60, "length": 3}], "boundingRegions": [{"pageNumber": 1, "polygon": [0, 2, 1, 2, 1, 2.5, 0, 2.5]}]},
        {"rowIndex": 1, "columnIndex": 0, "content": "v", "spans": [{"offset": 700, "length": 2}], "boundingRegions": [{"pageNumber": 1, "polygon": [0, 2.5, 0.5, 2.5, 0.5, 3, 0, 3]}]},
        {"rowIndex": 1, "columnIndex": 1, "content": "w", "spans": [{"offset": 720, "length": 2}], "boundingRegions": [{"pageNumber": 1, "polygon": [0.5, 2.5, 1, 2.5, 1, 3, 0.5, 3]}]}]}],
    "figures": [{"caption": {"content": "Fig"}, "boundingRegions": [{"pageNumber": 1, "polygon": [0, 0, 1, 0, 1, 1, 0, 1]}, {"pageNumber": 2, "polygon": [0, 0, 1, 0, 1, 1, 0, 1]}]}],
}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("layout") / "l.json"
    path.write_text(json.dumps(LAYOUT))
    return artifacts.layout_json(spark, str(path)).cache()


def test_layout_tables_to_chunks(raw):
    t, p = layout.tables(raw), layout.paragraphs(raw)
    c = layout.cells(t)
    conf = layout.table_confidence(layout.cell_confidence(c, layout.words(raw)), layout.pages(raw)).first()
    assert (conf.average_cell_confidence, conf.min_cell_confidence, conf.unmatched_cells, conf.requires_ocr) == (pytest.approx(0.85), pytest.approx(0.7), 1, True)
    chunks = tables.layout_row_chunks(t, c, p, F.lit("a.pdf")).collect()
    assert [r.text_for_embedding for r in chunks] == ["[Context: This paragraph leads in to the table below.] | [Table: H | H] | H: v | H: w"]
    assert chunks[0].bounding_polygon == [0, 2.5, 1, 2.5, 1, 3, 0, 3]
    assert sorted((f.page, f.figure_id) for f in layout.figures(raw).collect()) == [(1, "fig-0"), (2, "fig-0")]
    assert layout.page_texts(layout.bounding_boxes(raw)).first().raw_content.endswith("\nHead")


def test_providers(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "i int, text_for_embedding string").coalesce(1)
    got = providers.embedded(df, lambda texts: [[float(len(texts)), 1.0] for _ in texts], batch=3).collect()
    assert sorted(r.embedding[0] for r in got) == [1, 3, 3, 3, 3, 3, 3]

    def describe(row):
        if row["i"] == 2:
            raise RuntimeError
        return "ok"

    assert sorted((r.i, r.reply) for r in providers.described(df, describe).collect())[2] == (2, None)
    pauses, tries = [], iter([providers.Busy, providers.Busy, 5])

    def call():
        x = next(tries)
        if x is providers.Busy:
            raise x
        return x

    assert providers.retried(call, (1.0, 2.0), pauses.append)() == 5 and pauses == [1.0, 2.0]


def test_knn_blocks_agree(spark):
    rng = random.Random(1)
    e = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(90)], "vec_id bigint, embedding array<float>")
    one, many = (sorted(map(tuple, search.knn_cosine(e, e, 4, "vec_id", "vec_id", block=b, skip_self=True).collect())) for b in (1000, 13))
    assert one == many and len(one) == 360


def test_artifacts(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([("d1", "r1", v), ("d2", "r1", v)], "doc_id string, run_id string, v int")
    artifacts.write_artifact(rows(1), str(tmp_path), "k")
    artifacts.write_artifact(rows(2).where("doc_id = 'd2'"), str(tmp_path), "k")
    assert {(r.doc_id, r.v) for r in artifacts.read_artifact(spark, str(tmp_path), "k").collect()} == {("d1", 1), ("d2", 2)}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "B.PDF").write_bytes(b"x")
    (tmp_path / "in" / "a.txt").write_bytes(b"x")
    assert [r.name for r in artifacts.source_documents(spark, str(tmp_path / "in")).collect()] == ["B.PDF"] == [r.name for r in artifacts.listing(spark, str(tmp_path / "in")).collect()]
