"""Source files, layout JSON and artifact tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill import schemas
from leafmill.functions.text import document_id


def source_documents(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """(name, doc_id, content, size, modified) of the files with the suffix, in either case; read as they are needed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.substring_index("path", "/", -1)
    return files.where(F.lower("path").endswith(suffix)).select(name.alias("name"), document_id(F.col("content")).alias("doc_id"), "content", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def listing(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """(name, mib) by name; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.lower("path").endswith(suffix))
    return files.select(F.substring_index("path", "/", -1).alias("name"), F.round(F.col("length") / 1048576, 2).alias("mib")).orderBy("name")


def camel(name: str) -> str:
    """snake_case to camelCase."""
    head, *rest = name.split("_")
    return head + "".join(r[:1].upper() + r[1:] for r in rest)


def camel_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(camel_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(camel(f.name), camel_type(f.dataType)) for f in kind.fields])
    return kind


def layout_json(spark: SparkSession, path: str) -> DataFrame:
    """Layout results, one JSON document a line, with camelCase or snake_case keys (one kind a document), as the snake_case schema.

    Read with either schema in one pass each, without a look at the data; a document has its
    document id in one of them.
    """
    want = T.StructType.fromDDL(schemas.LAYOUT)
    lines = spark.read.text(path)
    own, other = F.from_json("value", want), F.from_json("value", camel_type(want)).cast(want)
    return lines.select(F.when(F.get_json_object("value", "$.docId").isNotNull(), other).otherwise(own).alias("r")).where("r is not null").select("r.*")


def write_artifact(df: DataFrame, path: str, kind: str, shelves: int = 256) -> None:
    """Rows of one kind, in shelves by a hash of doc_id; a run written again replaces its own rows only.

    A shelf is rewritten only where the rows at hand belong to it, so folders are bounded whatever
    the number of documents and runs.
    """
    target = f"{path.rstrip('/')}/{kind}"
    new = df.withColumn("shelf", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(shelves)).cast("int"))
    spark = df.sparkSession
    if exists(spark, target):
        touched = [r.shelf for r in new.select("shelf").distinct().collect()]  # shelves at most
        old = spark.read.parquet(target).where(F.col("shelf").isin(touched))
        new = old.join(new.select("doc_id", "run_id").distinct(), ["doc_id", "run_id"], "left_anti").unionByName(new, allowMissingColumns=True)
    replace(new, target)


def replace(rows: DataFrame, target: str) -> None:
    """Writes rows over the shelves that they belong to. Rows may come from target: they are written beside it first."""
    spark, beside = rows.sparkSession, f"{target}-new-{uuid.uuid4().hex}"
    try:
        rows.write.partitionBy("shelf").parquet(beside)
        spark.read.parquet(beside).repartition("shelf").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shelf").parquet(target)
    finally:
        remove(spark, beside)


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _folder(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def read_artifact(spark: SparkSession, path: str, kind: str, doc_id: str | None = None, run_id: str | None = None, shelves: int = 256) -> DataFrame:
    """The shelf is pruned by doc_id, rows are filtered in the scan. Raises where the kind was never written."""
    df = spark.read.parquet(f"{path.rstrip('/')}/{kind}")
    if doc_id is not None:
        shelf = spark.range(1).select(F.pmod(F.xxhash64(F.lit(str(doc_id))), F.lit(shelves)).cast("int")).first()[0]
        df = df.where((F.col("shelf") == shelf) & (F.col("doc_id").cast("string") == str(doc_id)))
    if run_id is not None:
        df = df.where(F.col("run_id").cast("string") == run_id)
    return df.drop("shelf")


def list_artifacts(spark: SparkSession, path: str, kinds: list[str]) -> DataFrame:
    """(kind, doc_id, run_id, n): the rows that each run has of each kind."""
    out = None
    for kind in kinds:
        own = spark.read.parquet(f"{path.rstrip('/')}/{kind}").groupBy(F.lit(kind).alias("kind"), "doc_id", "run_id").agg(F.count("*").alias("n"))
        out = own if out is None else out.unionByName(own)
    return out


def delete_artifacts(spark: SparkSession, path: str, kinds: list[str], gone: DataFrame) -> dict[str, int]:
    """Removes the documents' rows of each kind, rewriting only the shelves that hold any; how many rows went."""
    removed = {}
    for kind in kinds:
        target = f"{path.rstrip('/')}/{kind}"
        own = spark.read.parquet(target)
        hit = own.join(gone.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("shelf").count().collect()  # shelves at most
        removed[kind] = sum(r["count"] for r in hit)
        if hit:
            touched = own.where(F.col("shelf").isin([r.shelf for r in hit]))
            kept = touched.join(gone.select("doc_id").distinct(), "doc_id", "left_anti")
            full = {r.shelf for r in kept.select("shelf").distinct().collect()}
            replace(kept, target)
            for r in hit:
                if r.shelf not in full:
                    remove(spark, f"{target}/shelf={r.shelf}")
    return removed


def pull(spark: SparkSession, path: str, kind: str, steps: DataFrame) -> DataFrame:
    """The rows of a kind that belong to each document's newest run."""
    return read_artifact(spark, path, kind).join(newest_runs(steps), ["doc_id", "run_id"], "left_semi")


def newest_runs(steps: DataFrame) -> DataFrame:
    """(doc_id, run_id): each document's run of the latest time; of those without a time the least run."""
    return steps.groupBy("doc_id").agg(F.coalesce(F.max_by("run_id", "ts"), F.min("run_id")).alias("run_id"))
