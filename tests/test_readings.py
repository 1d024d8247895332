"""The tables of both readers: one document at a time, with the results of the DataFrame operators."""

import random

from pyspark.sql import functions as F

from leafmill.functions import grids
from leafmill.operators import tables
from leafmill.plans import layouts

WORDS = ["", " ", "A", "B", "A B", ":selected:", "x :unselected: y", " b\x1f", "2", "| c", "é a"]
CELLS = "doc_id string, table_index int, page int, local_index int, row_count int, column_count int, cell int, kind string, row int, col int, row_span int, column_span int, content string, polygon array<double>"


def random_cells(rng, doc, head=True):
    """Cells with overlapping, overhanging and missing spans, null contents and places outside."""
    n, columns = rng.randint(0, 14), rng.randint(1, 4)
    return [(doc, 0, 1, 0, 6, columns, i, rng.choice(["columnHeader", "content", None] if head else ["content", None]), rng.randint(0, 6), rng.randint(0, columns), rng.choice([0, 1, 1, 2, 9, None]), rng.choice([0, 1, 1, 2, 9, None]), rng.choice([*WORDS, None]), [float(i), 1.0]) for i in range(n)]


def random_markdown(rng):
    return "\n".join(rng.choice(["| A | B |", "|---|:-|", "|A|", "text", "", "| broken", "off |", " | A B | | b |", "|", "||", "| |", "A"]) for _ in range(rng.randint(0, 12)))


def test_grids_agree(spark):
    rng = random.Random(5)
    docs = {f"d{i}": random_cells(rng, f"d{i}") for i in range(60)}
    frame = spark.createDataFrame([c for d in docs.values() for c in d], CELLS)
    own = {d: [grids.Cell(c[6], c[7] == "columnHeader", c[8], c[9], c[10], c[11], c[5], c[12], c[13]) for c in cells] for d, cells in docs.items() if cells}
    heads = {r.doc_id: r.headers for r in tables.fused_headers(frame).collect()}
    assert heads == {d: grids.headers(c, c[0].column_count) for d, c in own.items()}
    at = {(r.doc_id, r.row): (r.nth, r.polygons) for r in tables.body_rows(frame).collect()}
    assert at == {(d, row): (i, p) for d, c in own.items() for i, (row, p) in enumerate(grids.body_rows([x for x in c if not x.head]))}
    grid = tables.body_grid(frame)
    want, filled = {}, {}
    for d, c in own.items():
        body = [x for x in c if not x.head]
        texts, spanned = grids.grid(body, max((x.row + 1 for x in body), default=0), c[0].column_count)
        want |= {(d, r, i): (t, spanned[r][i]) for r, line in enumerate(texts) for i, t in enumerate(line)}
        filled |= {(d, r, i): t for r, line in enumerate(grids.fill_label_runs(texts)) for i, t in enumerate(line)}
    assert {(r.doc_id, r.row, r.col): (r.text, r.spanned) for r in grid.collect()} == want
    assert {(r.doc_id, r.row, r.col): r.text for r in tables.fill_label_runs(grid).collect()} == filled


def test_pipe_tables_agree(spark):
    rng = random.Random(6)
    pages = [(i, random_markdown(rng)) for i in range(150)]
    got = sorted((r.id, r.local_index, not r.is_header, r.row, r.cells) for r in tables.pipe_tables(spark.createDataFrame(pages, "id int, markdown string"), ["id"]).collect())
    assert got == sorted((i, n, past, r, cells) for i, md in pages for n, two in enumerate(grids.pipe_tables(md)) for past, lines in enumerate(two) for r, cells in enumerate(lines))


def test_second_rows_agree(spark):
    rng = random.Random(7)
    docs = {f"d{i}": (random_cells(rng, f"d{i}", False) or random_cells(rng, f"d{i}", False), [[rng.choice(WORDS[2:5] + ["", "A B b"]) for _ in range(rng.randint(0, 4))] for _ in range(rng.randint(0, 7))]) for i in range(60)}
    frame = spark.createDataFrame([c for d, _ in docs.values() for c in d], CELLS)
    chosen = spark.createDataFrame([(d, 0, 1, 0, "ocr") for d in docs], "doc_id string, table_index int, page int, local_index int, source string")
    second = spark.createDataFrame([(d, 1, 0, False, i, c) for d, (_, lines) in docs.items() for i, c in enumerate(lines)], "doc_id string, page int, local_index int, is_header boolean, row int, cells array<string>")
    got = {}
    for r in tables.second_reader_rows(chosen, second, tables.body_rows(frame), tables.body_grid(frame)).collect():
        got.setdefault(r.doc_id, []).append((r.row, r.cells, r.polygons))
    for d, (cells, lines) in docs.items():
        own = [grids.Cell(c[6], False, c[8], c[9], c[10], c[11], c[5], c[12], c[13]) for c in cells]
        texts, spanned = grids.grid(own, max((c.row + 1 for c in own), default=0), own[0].column_count if own else 0)
        assert sorted(grids.second_rows(lines, grids.body_rows(own), texts, spanned)) == sorted(got.get(d, []))


def test_documents_over_batches(spark):
    """A document whose parts fill several Arrow batches is one document; lead-ins come from the same page, strictly before."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = [f"d{i}" for i in range(9)]
        cells = spark.createDataFrame([(d, 0, 1, 0, 9, 2, 2 * r + c, "content", r, c, 1, 1, f"{d} {r} {c}", []) for d in docs for r in range(9) for c in range(2)], CELLS)
        t = spark.createDataFrame([(d, 0, 1, 0, "", 50) for d in docs], "doc_id string, table_index int, page int, local_index int, caption string, start int")
        p = spark.createDataFrame([(d, i, "", f"Paragraph number {i} of document {d} stands here.", [(at, 5)], [(page, [])]) for d in docs for i, at, page in ((0, 10, 1), (1, 20, 1), (2, 45, 1), (3, 30, 2))], "doc_id string, ord int, role string, content string, spans array<struct<offset int, length int>>, regions array<struct<page_number int, polygon array<double>>>")
        sure = spark.createDataFrame([], "doc_id string, page int, local_index int, min_cell_confidence double, complexity_reasons array<string>")
        chunks, report = tables.table_path(t, cells, p, sure, spark.createDataFrame([], "doc_id string, page int, markdown string"), F.lit("f"))
        got = {(r.document_id, r.row_index): r.text_for_embedding for r in chunks.collect()}
        assert got == {(d, r): f"[Context: Paragraph number 1 of document {d} stands here.] | [Table: {d} 0 0 | {d} 0 1] | {d} {r} 0 | {d} {r} 1" for d in docs for r in range(9)}
        assert report.count() == len(docs)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_few_shuffles(spark, sf):
    """All parts of a document meet in one shuffle; the rest are those of the inputs."""
    for name in ("table_path", "table_report"):
        plan = getattr(layouts, name)(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 12 and "Join" not in plan
