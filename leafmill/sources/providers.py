"""External models behind plain functions, called by Arrow batch.

A provider takes and gives Python lists; it may raise Busy for an answer worth another try.
Filter before calling one: a plan doesn't move filters across Python.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame


class Busy(Exception):
    """The service asks for another try."""


def retried(call: Callable, delays: tuple[float, ...], pause: Callable[[float], None] = time.sleep) -> Callable:
    """call, tried again after each delay while it raises Busy; the last one goes up."""

    def run(*args):
        for d in delays:
            try:
                return call(*args)
            except Busy:
                pause(d)
        return call(*args)

    return run


OCR_DELAYS, EMBED_DELAYS, VISION_DELAYS = (3.0, 6.0, 12.0, 24.0), (2.0, 4.0, 8.0, 16.0), (2.0, 4.0, 8.0)


def embedded(chunks: DataFrame, embed: Callable[[list[str]], list[list[float]]], batch: int = 100, delays: tuple[float, ...] = EMBED_DELAYS) -> DataFrame:
    """chunks with embedding, batch texts a call; raises if a call gives another number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = retried(embed, delays)
        for whole in batches:
            for i in range(0, len(whole), batch):
                part = whole.slice(i, batch)
                vectors = call(part.column("text_for_embedding").to_pylist())
                if vectors and isinstance(vectors[0], dict):  # {index, embedding}, in any order
                    vectors = [v["embedding"] for v in sorted(vectors, key=lambda v: v["index"])]
                if len(vectors) != len(part):
                    raise ValueError("one vector for each text is due")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(vectors, pa.list_(pa.float32()))], names=[*part.schema.names, "embedding"])

    own = chunks.drop("embedding")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    return own.mapInArrow(run, ddl + ", embedding array<float>")


def described(candidates: DataFrame, describe: Callable[[dict], str | None], delays: tuple[float, ...] = VISION_DELAYS, concurrent: int = 4) -> DataFrame:
    """candidates with reply, concurrent calls at a time; a call that fails gives null, so the figure is kept unverified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = retried(describe, delays)

        def one(row: dict) -> str | None:
            try:
                return call(row)
            except Exception:  # the contract: no record instead of an error
                return None

        for part in batches:
            with ThreadPoolExecutor(concurrent) as pool:
                replies = list(pool.map(one, part.to_pylist()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(replies, pa.string())], names=[*part.schema.names, "reply"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.schema.fields)
    return candidates.mapInArrow(run, ddl + ", reply string")


def second_reading(pages: DataFrame, read: Callable[[dict], str], delays: tuple[float, ...] = OCR_DELAYS) -> DataFrame:
    """pages with markdown; a page that still fails after the tries fails the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = retried(read, delays)
        for part in batches:
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([call(r) for r in part.to_pylist()], pa.string())], names=[*part.schema.names, "markdown"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields)
    return pages.mapInArrow(run, ddl + ", markdown string")


def analyzed(documents: DataFrame, analyze: Callable[[dict], str], delays: tuple[float, ...] = OCR_DELAYS) -> DataFrame:
    """documents with layout, the layout service's JSON for each; artifacts.layout_json() reads it once it is written as lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = retried(analyze, delays)
        for part in batches:
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([call(r) for r in part.to_pylist()], pa.string())], names=[*part.schema.names, "layout"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(run, ddl + ", layout string")
