"""Chunks of paragraphs, a document at a time, against plain loops and window_ranges()."""

import random

from pyspark.sql import functions as F

from leafmill.config import Config
from leafmill.operators import paragraphs

ROW = "doc_id string, source_file string, ord int, role string, content string, page int, offset int, polygon array<double>"


def test_chunks_of_documents(spark):
    """Furniture and blanks go, a page that comes back is another run, documents go over Arrow batches, null offsets are 0."""
    rng, rows = random.Random(8), []
    for d in range(12):
        page = 1
        for i in range(rng.randint(1, 60)):
            page = rng.choice([page, page, page, 1, 2])
            rows.append((f"d{d}", "f", i, rng.choice(["", None, "pageHeader", ""]), rng.choice([None, " \x1f　", " a  b\x85c ", "w " * rng.randint(1, 30)]), page, rng.choice([None, i * 7]), rng.choice([[], [float(i), 1.0, i + 1.0, 2.0]])))
    config = Config(chunk_tokens=50, overlap_tokens=15)
    runs = {}
    for d, _, i, role, content, page, offset, polygon in rows:
        if role == "pageHeader" or not (content or "").strip():
            continue
        own = runs.setdefault(d, [])
        if not own or own[-1][0] != page:
            own.append((page, []))
        own[-1][1].append((content.strip(), offset or 0, polygon))
    flat = [(d, page, items) for d, own in runs.items() for page, items in own]
    frame = spark.createDataFrame([(i, [len(c.split()) for c, _, _ in items]) for i, (_, _, items) in enumerate(flat)], "i int, t array<int>")
    want = []
    for i, ranges in frame.select("i", paragraphs.window_ranges(F.col("t"), 50, 15)).collect():
        d, page, items = flat[i]
        for lo, hi, plo in ranges:
            xy = [p for _, _, p in items[plo : hi + 1] if p]
            box = [min(p[0] for p in xy), 1.0, max(p[2] for p in xy), 2.0] if xy else None
            want.append((d, page, " ".join(c for c, _, _ in items[lo : hi + 1]), hi - lo + 1, sum(len(c.split()) for c, _, _ in items[lo : hi + 1]), [box[0], 1.0, box[2], 1.0, box[2], 2.0, box[0], 2.0] if box else []))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = paragraphs.paragraph_chunks(spark.createDataFrame(rng.sample(rows, len(rows)), ROW), config).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted((r.document_id, r.page, r.text_for_embedding, r.n_paragraphs, r.tokens, r.bounding_polygon) for r in got) == sorted(want)


def test_lines_of_texts(spark):
    texts = ["", "\n", "a\n\nbé\r\n", None, "𝄞x\ny" * 3, "one"]
    got = paragraphs.text_paragraphs(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), 2).collect()
    want = []
    for d, t in enumerate(texts):
        at = 0
        for i, line in enumerate(t.split("\n") if t is not None else []):
            want.append((str(d), i, line, at, i // 2 + 1))
            at += len(line) + 1
    assert sorted((r.doc_id, r.ord, r.content, r.offset, r.page) for r in got) == sorted(want)


def test_one_shuffle(spark, sf):
    plan = paragraphs.paragraph_chunks(paragraphs.text_paragraphs(spark.read.parquet(f"{sf}/documents.parquet")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Aggregate" not in plan
