"""Created and deleted documents: the decision for each event, upserts, deletes, and the same in a stream.

State is three Parquet tables under one folder (names, chunks, metrics). A version is written
whole and then named by a new pointer file of the next number, put in place by one rename; the
pointer of the greatest number is in force. Nothing is deleted before that, and the version before
stays for readers that have it open, so a job that dies at any point leaves the old version or the
new one in force, and a batch that comes again gives the same state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill import schemas
from leafmill.functions.text import blob_name, document_id, is_pdf

NAMES = "name STRING, doc_id STRING, status STRING, ts TIMESTAMP"
METRICS = "batch BIGINT, step STRING, documents BIGINT, removed_chunks BIGINT, added_chunks BIGINT"


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return rows.withColumn("k__", F.row_number().over(w)).where("k__ = 1").drop("k__")


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with the rows of new in place of its own of the same keys. new has one row a key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def upserted_with_counts(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The table with the last of new's rows of each key in place of its own, and (inserted, updated): how many of either. Raises, as it is read, where a row has no embedding."""
    own = latest(indexable(new) if "embedding" in new.columns else new, keys, order)
    known = old.select(*keys).withColumn("known__", F.lit(True))
    counts = own.select(*keys).join(known, keys, "left").agg(F.count_if(F.col("known__").isNull()).alias("inserted"), F.count_if(F.col("known__").isNotNull()).alias("updated"))
    return upserted(old, own.select(*old.columns), keys), counts


def resolved(wanted: DataFrame, index: DataFrame, legacy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name, doc_id) of each wanted name by the name index, else by the documents' own records, the first by (doc_id); and the index with what only those knew.

    index: (name, doc_id); legacy: (name, doc_id), scanned only for names that the index lacks.
    """
    names = wanted.select("name").distinct()
    missed = names.join(index, "name", "left_anti")
    found = legacy.join(missed, "name", "left_semi").groupBy("name").agg(F.min("doc_id").alias("doc_id"))
    whole = index.select("name", "doc_id").unionByName(found)
    return names.join(whole, "name", "left").select("name", "doc_id"), whole


def without_documents(chunks: DataFrame, gone: DataFrame) -> DataFrame:
    return chunks.join(gone.select("document_id").distinct(), "document_id", "left_anti").select(*chunks.columns)


def decision(content: Column, known: Column, status: Column, force: bool = False) -> Column:
    """run for an unknown name, skip for the same content that is done or under way, else replace."""
    same = known.eqNullSafe(content) & status.isin("done", "running") & ~F.lit(force)
    return F.when(known.isNull(), "run").when(same, "skip").when(known == content, "run").otherwise("replace")


def indexable(chunks: DataFrame) -> DataFrame:
    """The chunks, or an error if any has no embedding."""
    ok = F.size(F.coalesce("embedding", F.array().cast("array<float>"))) > 0
    return chunks.withColumn("embedding", F.when(ok, F.col("embedding")).otherwise(F.raise_error(F.concat(F.lit("no embedding: "), "chunk_id")).cast("array<float>")))


class Store:
    """Versioned Parquet tables under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def pointers(self, name: str) -> list[tuple[int, str]]:
        """(number, version) of the table's pointers, the one in force last."""
        found = self._fs.globStatus(self._path(f"{self.path}/{name}.version.*")) or []
        return sorted((int(own[2]), own[3]) for own in (f.getPath().getName().split(".") for f in found))

    def read(self, name: str, schema: str) -> DataFrame:
        found = self.pointers(name)
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{found[-1][1]}")

    def write(self, name: str, df: DataFrame) -> None:
        found, version = self.pointers(name), f"{name}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{version}")
        fresh = self._path(f"{self.path}/_new-{version}")
        self._fs.create(fresh, True).close()
        number = found[-1][0] + 1 if found else 1
        if not self._fs.rename(fresh, self._path(f"{self.path}/{name}.version.{number:012d}.{version}")):
            raise OSError(f"the pointer of {version} can't be put in place")
        for _, old in found[:-1]:  # all but the one before
            self._fs.delete(self._path(f"{self.path}/{old}"), True)
        for number, old in found[:-1]:
            self._fs.delete(self._path(f"{self.path}/{name}.version.{number:012d}.{old}"), False)


class Lifecycle:
    """Applies batches of events (url, kind, content, ts) to the state. make_chunks: (name, doc_id, content) rows to chunks."""

    def __init__(self, spark: SparkSession, path: str, make_chunks: Callable[[DataFrame], DataFrame], force: bool = False) -> None:
        self.spark, self.store, self.make_chunks, self.force = spark, Store(spark, path), make_chunks, force

    def names(self) -> DataFrame:
        return self.store.read("names", NAMES)

    def chunks(self) -> DataFrame:
        return self.store.read("chunks", schemas.CHUNK)

    def apply(self, events: DataFrame, batch: int = 0) -> None:
        """The last event of each name counts. Chunks are written before names, so a batch that dies between the two does its work again."""
        named = events.withColumn("name", blob_name(F.col("url"))).where(is_pdf(F.col("name")))
        last = latest(named, ["name"], ["ts", "kind"]).withColumn("doc_id", document_id(F.col("content")))
        known = self.names().select("name", F.col("doc_id").alias("known"), "status")
        told = last.join(known, "name", "left").withColumn("decision", F.when(F.col("kind") == "deleted", F.when(F.col("known").isNull(), "skip").otherwise("delete")).otherwise(decision(F.col("doc_id"), F.col("known"), F.col("status"), self.force)))
        told = told.where("decision <> 'skip'").persist()
        try:
            removed = told.where("known is not null").select("name", F.col("known").alias("doc_id"))
            added = told.where("decision in ('run', 'replace')")
            names = self.names().join(removed, ["name", "doc_id"], "left_anti")  # only entries that still name the removed document
            names = upserted(names, added.select("name", "doc_id", F.lit("done").alias("status"), "ts"), ["name"])
            new = indexable(self.make_chunks(added.select("name", "doc_id", "content").dropDuplicates(["doc_id"])))
            gone = removed.select(F.col("doc_id").alias("document_id")).unionByName(added.select(F.col("doc_id").alias("document_id"))).distinct()
            old = self.chunks()
            dropped = old.join(gone, "document_id", "left_semi").count()
            self.store.write("chunks", without_documents(old, gone).unionByName(new.select(*old.columns)))
            self.store.write("names", names)
            counts = self.spark.range(1).select(F.lit(batch).cast("bigint").alias("batch"), F.lit("apply").alias("step"), F.lit(told.count()).cast("bigint").alias("documents"), F.lit(dropped).cast("bigint").alias("removed_chunks"), F.lit(self.chunks().join(gone, "document_id", "left_semi").count()).cast("bigint").alias("added_chunks"))
            self.store.write("metrics", upserted(self.store.read("metrics", METRICS), counts, ["batch"]))
        finally:
            told.unpersist()

    def stream(self, events: DataFrame, checkpoint: str):
        """A query that applies each micro-batch; redelivered events change nothing."""
        return events.writeStream.foreachBatch(lambda df, i: self.apply(df, i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
