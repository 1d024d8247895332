"""Start, end and error of each step, with its duration and metrics, as rows."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

EVENTS = "event STRING, step STRING, doc_id STRING, run_id STRING, at DOUBLE, duration_ms DOUBLE, error STRING, metrics STRING"


class Telemetry:
    """Events of one run, written as a Parquet folder of its own by flush(), so that runs never clash."""

    def __init__(self, spark: SparkSession, path: str, doc_id: str | None = None, run_id: str | None = None) -> None:
        self.spark, self.path, self.doc_id, self.run_id = spark, path, doc_id, run_id
        self.rows: list[tuple] = []

    def event(self, name: str, step: str, duration_ms: float | None = None, error: str | None = None, **metrics) -> None:
        self.rows.append((name, step, self.doc_id, self.run_id, time.time(), duration_ms, error, json.dumps(metrics, sort_keys=True)))

    @contextmanager
    def step(self, name: str, **metrics) -> Iterator[dict]:
        """Times a step; what the block puts into the dict joins its metrics. An error is noted and goes on."""
        self.event("start", name, **metrics)
        began, found = time.monotonic(), dict(metrics)
        try:
            yield found
        except Exception as e:
            self.event("error", name, (time.monotonic() - began) * 1000, f"{type(e).__name__}: {e}", **found)
            raise
        self.event("end", name, (time.monotonic() - began) * 1000, **found)

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, EVENTS)

    def flush(self) -> None:
        if self.rows:
            self.frame().coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []
