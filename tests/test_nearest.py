"""Exact search against every pair, with ties, lengths of nothing, values that are no numbers, and few or many tasks."""

import numpy as np
import pyarrow as pa
import pytest

from leafmill.operators import search


def brute(q, b, k, skip_self):
    out = []
    for qi, x in q:
        x = np.array(x, dtype=np.float64)
        scored = []
        for bi, y in b:
            y = np.array(y, dtype=np.float64)
            n = np.linalg.norm(x) * np.linalg.norm(y)
            s = round(float(x @ y / n), 6) if n > 0 else 0.0
            if not (skip_self and qi == bi):
                scored.append((-s, bi))
        out += [(qi, bi, -s + 0.0, r + 1) for r, (s, bi) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize(("kind", "skip_self", "group"), [("float", True, 1 << 24), ("double", False, 3000), ("float", True, 3000)])
def test_exact(spark, monkeypatch, kind, skip_self, group):
    monkeypatch.setattr(search, "GROUP", group)
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(260, 6)).astype(np.float32)
    rows[40:90] = rows[7]  # many ties
    rows[90:120] = rows[8] * np.float32(3)
    rows[120:125] = 0
    rows[130:140] = rows[9] + rng.normal(size=(10, 6)).astype(np.float32) * np.float32(1e-6)  # differ beyond single precision's error
    rows[150, 2] = np.nan
    data = [(i, [float(x) for x in r]) for i, r in enumerate(rows)]
    e = spark.createDataFrame([*data, (999, None)], f"vec_id long, embedding array<{kind}>")
    got = search.knn_cosine(e, e, 4, "vec_id", "vec_id", block=16, skip_self=skip_self)
    assert sorted((r.query_id, r.id, r.score + 0.0, r["rank"]) for r in got.collect()) == brute(data, data, 4, skip_self)


def test_ties_take_bounded_memory():
    """A slice of equal vectors goes to the exact scores a few queries at a time."""
    n = 3000
    same = np.tile(np.arange(1.0, 9.0), (n, 1))
    near = search.Nearest(np.arange(n), same, 3, True)
    for at in range(0, n, 500):
        near.add(np.arange(at, at + 500), same[at : at + 500], search.unit(same[at : at + 500]).astype(np.float32))
    found = near.found().to_pydict()
    assert found["id"][:3] == [1, 2, 3] and found["id"][3:6] == [0, 2, 3] and len(found["id"]) == 3 * n


def test_no_rows_a_pair_of_blocks(spark):
    """What is shuffled for ranking grows with the queries and not with the pairs of blocks."""
    rng = np.random.default_rng(4)
    e = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(900, 4)))], "vec_id long, embedding array<double>")
    plan = search.knn_cosine(e, e, 3, "vec_id", "vec_id", block=8, skip_self=True)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_terms_take_little_text_at_a_time(monkeypatch):
    """Both maps of bm25 split about TEXT bytes at a time, however large an Arrow batch is."""
    seen, real = [], search.term_counts

    class Frame:
        def __init__(self, maps):
            self.maps = maps

        sparkSession = None

        def where(self, _):
            return self

        def mapInArrow(self, f, schema):  # noqa: N802  Spark's name
            self.maps.append(f)
            return self

        groupBy = agg = lambda self, *_: self
        collect = lambda self: []

    monkeypatch.setattr(search, "term_counts", lambda texts, wanted: (seen.append(sum(len(t or "") for t in texts.to_pylist())), real(texts, wanted))[1])
    monkeypatch.setattr(search, "F", __import__("types").SimpleNamespace(sum=lambda _: __import__("types").SimpleNamespace(alias=lambda _: None)))
    maps = []
    search._bm25_block(Frame(maps), [(1, ["a"])], pa.array(["a"]), 2, 1.2, 0.75)
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(["a b " * 30_000, None] * 20)], names=["id", "text"])
    for f in maps:
        out = list(f(iter([batch])))
        assert out and len(maps) == 2
    assert max(seen) <= search.TEXT and sum(seen) == 2 * 20 * 120_000
