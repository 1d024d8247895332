"""Spark helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. In local mode, where it may be unset, a folder of our own that goes with the process."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if not told:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        told = tempfile.mkdtemp(prefix="leafmill-")
        atexit.register(shutil.rmtree, told, True)
        spark.conf.set("spark.checkpoint.dir", told)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(told)
    return told


def cut(df: DataFrame) -> DataFrame:
    """df computed once into the shared folder, its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this run wrote in the shared folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def map_rows(docs: DataFrame, run: Callable) -> DataFrame:
    """docs.mapInArrow(run) with the columns of docs, which may have dots in their names."""
    safe = [f"__leafmill_{i}" if "." in c or "`" in c else c for i, c in enumerate(docs.columns)]
    own = docs.toDF(*safe)
    return own.mapInArrow(run, own.schema).toDF(*docs.columns)


def released(run: Callable) -> Callable:
    """run, after which the memory that the worker has freed goes back to the system; workers live on, and allocators keep what they can."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
            trim(0)

    return mapped


@contextmanager
def small_batches(spark: SparkSession, limit: int = 1 << 22) -> Iterator[None]:
    """What is computed inside goes to the workers in Arrow batches of about limit bytes, or one row; a task's JVM and its worker hold several of them at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def row_hash(seed: int, *columns: str) -> Column:
    """64 bits of the values of columns and of which are null."""
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns])


def row_key(*columns: str) -> Column:
    """128 bits, as bytes, that stand for a row in narrow shuffles; equal for repeated rows only (but for collisions, of which 10**12 rows have about 10**-15)."""
    return F.unhex(F.concat(*[F.lpad(F.hex(row_hash(seed, *columns)), 16, "0") for seed in (0, 1)]))


def hashable(docs: DataFrame) -> list[str]:
    """The columns that row_hash() takes: all but those of a type that can't be compared, such as maps."""
    return [f.name for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]


def one_of_each(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of keys, that of least hash over all columns; rows that tie there are alike."""
    w = Window.partitionBy(*keys).orderBy(row_hash(2, *hashable(docs)), row_hash(3, *hashable(docs)))
    return docs.withColumn("__leafmill_nth", F.row_number().over(w)).where("__leafmill_nth = 1").drop("__leafmill_nth")


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches cut at rows so that each holds about limit bytes of the string column, or one row.

    Rows are never split, so whole texts stay together; the cut only bounds the memory of numpy work.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < len(ends):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
