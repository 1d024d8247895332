"""Documents that come, change and go, in batches and in a stream."""

import datetime

import pytest
from pyspark.sql import functions as F

from leafmill import schemas
from leafmill.streaming.lifecycle import Lifecycle, indexable

EVENTS = "url string, kind string, content string, ts timestamp"


def chunked(rows):
    made = rows.select(F.concat("doc_id", F.lit("-0")).alias("chunk_id"), F.lit("paragraph").alias("type"), F.col("name").alias("source_file"), F.col("content").alias("text_for_embedding"), F.col("doc_id").alias("document_id"), F.array(F.lit(1.0).cast("float")).alias("embedding"))
    return rows.sparkSession.createDataFrame([], schemas.CHUNK).unionByName(made, allowMissingColumns=True)


def event(name, content, second, kind="created"):
    return f"https://h/documents/{name}", kind, content, datetime.datetime(2024, 1, 1, 0, 0, second)


def state(life):
    return sorted((r.source_file, r.text_for_embedding) for r in life.chunks().collect()), sorted(r["name"] for r in life.names().collect())


def test_batches(spark, tmp_path):
    life = Lifecycle(spark, str(tmp_path), chunked)
    apply = lambda n, *rows: life.apply(spark.createDataFrame(list(rows), EVENTS), n)
    apply(0, event("a.pdf", "one", 1), event("b.PDF", "two", 1), event("c.txt", "no", 1))
    want = ([("a.pdf", "one"), ("b.PDF", "two")], ["a.pdf", "b.PDF"])
    assert state(life) == want
    apply(1, event("a.pdf", "one", 2))
    assert state(life) == want
    apply(2, event("a.pdf", "three", 3))
    assert state(life) == ([("a.pdf", "three"), ("b.PDF", "two")], ["a.pdf", "b.PDF"])
    apply(3, event("b.PDF", None, 4, "deleted"), event("unknown.pdf", None, 4, "deleted"))
    assert state(life) == ([("a.pdf", "three")], ["a.pdf"])
    assert {r.batch: r.removed_chunks for r in life.store.read("metrics", "batch bigint, removed_chunks bigint").collect()} == {0: 0, 1: 0, 2: 1, 3: 1}


def test_stream(spark, tmp_path):
    source = str(tmp_path / "events")
    life = Lifecycle(spark, str(tmp_path / "state"), chunked)
    for n in range(2):
        spark.createDataFrame([event("a.pdf", "one", 1), event("b.pdf", "two", 1)], EVENTS).write.mode("append").parquet(source)
        query = life.stream(spark.readStream.schema(EVENTS).parquet(source), str(tmp_path / "checkpoint"))
        query.awaitTermination()
        assert state(life) == ([("a.pdf", "one"), ("b.pdf", "two")], ["a.pdf", "b.pdf"])


def test_empty_embedding_fails(spark):
    rows = spark.createDataFrame([("c", None)], "chunk_id string, embedding array<float>")
    with pytest.raises(Exception, match="no embedding"):
        indexable(rows).collect()
