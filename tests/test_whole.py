"""Durable state, artifact tables, chunk union, approximate search, telemetry."""

import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F
from test_operators import LAYOUT

from leafmill.operators import chunks, figures, layout, search, tables
from leafmill.sources import artifacts, providers
from leafmill.streaming.lifecycle import Store, resolved, upserted_with_counts
from leafmill.streaming.telemetry import Telemetry


class Stopped(Exception):
    pass


class Brittle:
    """A file system that stops at the n-th call of a kind that changes something."""

    def __init__(self, fs, left):
        self.fs, self.left = fs, left

    def __getattr__(self, name):
        if name in ("create", "rename", "delete"):
            if not self.left:
                raise Stopped
            self.left -= 1
        return getattr(self.fs, name)


def test_state_is_old_or_new_wherever_a_write_stops(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([(v,)], "v int")
    stopped = 0
    for n in range(9):
        path = str(tmp_path / str(n))
        store = Store(spark, path)
        for v in (1, 2, 3):
            store.write("t", rows(v))
        fs, store._fs = store._fs, Brittle(store._fs, n)
        try:
            store.write("t", rows(4))
        except Stopped:
            stopped += 1
        assert [r.v for r in Store(spark, path).read("t", "v int").collect()] in ([3], [4])
        store._fs = fs
        store.write("t", rows(5))
        again = Store(spark, path)
        assert [r.v for r in again.read("t", "v int").collect()] == [5] and len(again.pointers("t")) <= 3
    assert 3 <= stopped < 9


def test_reader_of_the_version_before(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("t", spark.range(3))
    old = store.read("t", "id bigint")
    store.write("t", spark.range(5))
    assert old.count() == 3 and store.read("t", "id bigint").count() == 5


def test_artifact_tables(spark, tmp_path):
    path = str(tmp_path)
    rows = [(f"d{i}", run, i) for i in range(12) for run in ("r1", "r2")]
    artifacts.write_artifact(spark.createDataFrame(rows, "doc_id string, run_id string, v int"), path, "k", 4)
    artifacts.write_artifact(spark.createDataFrame([("d3", "r2", 99), ("d3", "r3", 98)], "doc_id string, run_id string, v int"), path, "k", 4)
    assert sorted(r.v for r in artifacts.read_artifact(spark, path, "k", "d3", shelves=4).collect()) == [3, 98, 99]
    assert {(r.doc_id, r.run_id): r.n for r in artifacts.list_artifacts(spark, path, ["k"]).collect()}[("d3", "r3")] == 1
    steps = spark.createDataFrame([("d3", "r1", 1), ("d3", "r2", 5), ("d3", "r3", 2), ("d4", "r1", None), ("d4", "r2", None)], "doc_id string, run_id string, ts int")
    assert {(r.doc_id, r.v) for r in artifacts.pull(spark, path, "k", steps).collect()} == {("d3", 99), ("d4", 4)}
    gone = spark.createDataFrame([(f"d{i}",) for i in range(11)] + [("no",)], "doc_id string")
    assert artifacts.delete_artifacts(spark, path, ["k"], gone) == {"k": 23}
    assert {r.doc_id for r in artifacts.read_artifact(spark, path, "k").collect()} == {"d11"}


def test_names_by_index_then_by_records(spark):
    index = spark.createDataFrame([("a", "d1")], "name string, doc_id string")
    legacy = spark.createDataFrame([("a", "d9"), ("b", "d3"), ("b", "d2")], "name string, doc_id string")
    found, whole = resolved(spark.createDataFrame([("a",), ("b",), ("c",)], "name string"), index, legacy)
    assert {(r["name"], r.doc_id) for r in found.collect()} == {("a", "d1"), ("b", "d2"), ("c", None)}
    assert {(r["name"], r.doc_id) for r in whole.collect()} == {("a", "d1"), ("b", "d2")}


def test_upsert_counts(spark):
    old = spark.createDataFrame([(1, 1), (2, 1)], "id int, v int")
    new = spark.createDataFrame([(2, 5, 1), (2, 6, 2), (3, 7, 1)], "id int, v int, t int")
    whole, counts = upserted_with_counts(old, new, ["id"], ["t"])
    assert {tuple(r) for r in whole.collect()} == {(1, 1), (2, 6), (3, 7)} and tuple(counts.first()) == (1, 1)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("layout")
    snake = json.loads(re.sub(r'"(\w+)":', lambda m: '"' + re.sub("[A-Z]", lambda x: "_" + x[0].lower(), m[1]) + '":', json.dumps(LAYOUT | {"docId": "e"})))
    (path / "a.json").write_text(json.dumps(LAYOUT) + "\n" + json.dumps(snake))
    return artifacts.layout_json(spark, str(path)).cache()


def test_keys_of_either_case(raw):
    assert {r.doc_id: (len(r.tables[0].cells), r.pages[0].words[0].span.offset, r.figures[0].caption.content) for r in raw.collect()} == {"d": (3, 60, "Fig"), "e": (3, 60, "Fig")}


def test_figures_straight_from_the_layout(raw):
    got = {(r.doc_id, r.page): r for r in figures.qualified_layout(raw).collect()}
    assert set(got) == {("d", 1), ("e", 1)}  # page 2 has no size
    r = got["d", 1]
    assert r.has_reference and r.status == "candidate" and r.header_overlap_ratio == 1.0 and r.page_width == 8.5 and r.routing_signals == ["furniture_overlap_with_reference"]
    boxes = layout.bounding_boxes(raw)
    assert layout.furniture(boxes).count() == 2 and {r.content for r in layout.page_paragraphs(boxes).collect()} == {"head", "this paragraph leads in to the table below."}


def test_all_chunks_of_documents(spark, raw):
    files = spark.createDataFrame([("d", "d.pdf"), ("e", "e.pdf")], "doc_id string, source_file string")
    markdown = spark.createDataFrame([("d", 1, "| Name | Value |\n|---|---|\n| v | w2 |\n")], "doc_id string, page int, markdown string")
    records = spark.createDataFrame([("e", 1, 0, "reject", None)], "doc_id string, page int, figure_index int, outcome string, record_crop string").withColumn("understanding", F.lit(None).cast(chunks.schemas.UNDERSTANDING))
    every, report = chunks.document_chunks(raw, files, markdown, records)
    got = {(r.document_id, r.type, r.page): r for r in every.collect()}
    assert got["d", "table_row", 1].text_for_embedding.endswith("| Name: v | Value: w2") and got["d", "table_row", 1].source == "ocr" and got["d", "table_row", 1].source_file == "d.pdf"
    assert got["e", "table_row", 1].text_for_embedding.endswith("| H: v | H: w")
    assert got["d", "paragraph", 1].text_for_embedding == "This paragraph leads in to the table below. [Table: H | H]"
    assert {(d, p) for d, t, p in got if t == "figure"} == {("d", 1), ("d", 2), ("e", 2)}
    assert {(r.document_id, r.total) for r in chunks.step_counts(every).collect()} == {("d", 4), ("e", 3)}
    assert {(r.doc_id, r.source) for r in report.collect()} == {("d", "ocr"), ("e", "layout")}
    text = {r.doc_id: r.text for r in tables.flags_text(report.withColumn("flag_types", F.when(F.col("doc_id") == "d", F.array(F.lit("multi_header"))).otherwise(F.col("flag_types"))).withColumn("flagged", F.size("flag_types") > 0)).collect()}
    assert text["e"].endswith("None.\n") and "## Page 1 · Table 0 · source: ocr\n**Table 0**\n\n- `multi_header`" in text["d"]


def reading(spark, rows, ours, spans):
    cells = [("d", 0, r * 9 + c, "content", r, c, 1, v) for r, row in enumerate(ours) for c, v in enumerate(row)]
    frame = spark.createDataFrame([("d", 0, r, c, v, spans[r][c]) for r, row in enumerate(ours) for c, v in enumerate(row)], "doc_id string, table_index int, row int, col int, text string, spanned boolean")
    at = spark.createDataFrame([("d", 0, r, r, [[0.0]]) for r in range(len(ours))], "doc_id string, table_index int, row int, nth int, polygons array<array<double>>")
    chosen = spark.createDataFrame([("d", 0, 1, 0, "ocr")], "doc_id string, table_index int, page int, local_index int, source string")
    second = spark.createDataFrame([("d", 1, 0, False, i, list(r)) for i, r in enumerate(rows)], "doc_id string, page int, local_index int, is_header boolean, row int, cells array<string>")
    assert cells
    return [r["cells"] for r in tables.second_reader_rows(chosen, second, at, frame).orderBy("row").collect()]


@pytest.mark.parametrize("rows, ours, spans, want", [
    ([["Group", "Val"], ["", "Other"]], [["Group", "Val"], ["", "Other"]], [[0, 0], [0, 0]], [["Group", "Val"], ["Group", "Other"]]),
    ([["A", "1"], ["B", "2"]], [["A", "1"], ["B", "2"]], [[0, 0], [0, 0]], [["A", "1"], ["B", "2"]]),
    ([["M", "Val"], ["split", "Other"]], [["Full", "Val"], ["Full", "Other"]], [[0, 0], [1, 0]], [["Full", "Val"], ["Full", "Other"]]),
    ([["300 Cases", ""]], [["300", "Cases"]], [[0, 0]], [["300 Cases", "300 Cases"]]),
    ([["a"], ["b", "c", "d"], ["x", "", "y"]], [["a", "q"], ["b", "c"]], [[0, 0], [0, 0]], [["a", "", ""], ["b", "c", "d"], ["x", "c", "y"]]),
])
def test_second_reading(spark, rows, ours, spans, want):
    assert reading(spark, rows, ours, [[bool(x) for x in r] for r in spans]) == want


def test_approximate_search_recalls_the_exact_one(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    q = e.where("vec_id % 20 = 0")
    exact = {(r.query_id, r.id) for r in search.knn_cosine(q, e, 5, "vec_id", "vec_id", skip_self=True).collect()}
    found = search.knn_approximate(q, e, 5, "vec_id", "vec_id", skip_self=True, block=64).collect()
    assert len(exact & {(r.query_id, r.id) for r in found}) / len(exact) >= 0.9 and max(r["rank"] for r in found) == 5


def test_bm25_against_a_plain_loop(spark):
    rng = random.Random(9)
    words = [f"w{int(rng.paretovariate(0.8)) % 60}" for _ in range(4000)]
    docs = [(i, " ".join(words[i * 9 : i * 9 + rng.randint(0, 30)]) if i % 17 else None) for i in range(400)]
    queries = [(i, f"w{i} w{i + 3}, W{i + 3}; nothing") for i in range(25)] + [(99, ""), (98, None)]
    lists = [re.findall("[a-z0-9]+", (t or "").lower()) for _, t in docs]
    average = sum(map(len, lists)) / len(docs)
    want = []
    for q, t in queries:
        scores = {}
        for term in sorted(set(re.findall("[a-z0-9]+", (t or "").lower()))):
            df = sum(term in x for x in lists)
            for i, x in enumerate(lists):
                if term in x:
                    tf = x.count(term)
                    scores[i] = scores.get(i, 0) + math.log1p((400 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / average))
        best = sorted(scores.items(), key=lambda s: (-round(s[1], 6), s[0]))[:7]
        want += [(q, i, round(s, 6), n + 1) for n, (i, s) in enumerate(best)]
    frame = lambda rows: spark.createDataFrame(rows, "id bigint, text string").repartition(3)
    for block in (2048, 4):
        got = search.bm25(frame(queries), frame(docs), "id", "id", 7, block=block).collect()
        assert sorted((r.query_id, r.id, r["rank"]) for r in got) == sorted((q, i, n) for q, i, _, n in want)
        assert {(r.query_id, r.id): r.score for r in got} == pytest.approx({(q, i): s for q, i, s, _ in want}, abs=2e-6)


def test_answers_by_index_and_at_once(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "i int, text_for_embedding string").coalesce(1)
    got = providers.embedded(df, lambda texts: [{"index": i, "embedding": [float(t[1:])]} for i, t in reversed(list(enumerate(texts)))]).collect()
    assert [r.embedding[0] for r in sorted(got, key=lambda r: r.i)] == [0, 1, 2, 3, 4]
    assert providers.analyzed(df, lambda row: json.dumps({"docId": row["i"]})).count() == 5


def test_telemetry(spark, tmp_path):
    t = Telemetry(spark, str(tmp_path / "t"), "d", "r")
    with t.step("chunks", pages=2) as found:
        found["chunks"] = 7
    with pytest.raises(ValueError):
        with t.step("embed"):
            raise ValueError("no")
    t.flush()
    rows = {(r.event, r.step): r for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert set(rows) == {("start", "chunks"), ("end", "chunks"), ("start", "embed"), ("error", "embed")}
    assert json.loads(rows["end", "chunks"].metrics) == {"chunks": 7, "pages": 2} and rows["error", "embed"].error == "ValueError: no" and rows["end", "chunks"].duration_ms >= 0
