"""Document fingerprints: winnowing over rolling hashes of character k-grams.

Each text's k-grams of code points get a rolling hash of 62 bits (two polynomials modulo the
Mersenne prime 2**31 - 1). In every window of w successive k-grams the least hash is kept,
the rightmost of equals, with its position. Two texts that share any run of at least
w + k - 1 characters therefore share a fingerprint, and no run shorter than k can match.

Cases: a null or empty text, or one shorter than k, has no fingerprints; a text with fewer
than w k-grams is one window; repeated rows give repeated fingerprints; a null doc_id is
kept as null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.llm.common import pieces
from leafmill.llm.tokens import winnow

PRIME = (1 << 31) - 1
BASES = (1_000_003, 1_618_033_988)
K, WINDOW = 50, 100


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the Mersenne prime, for x below 2**62."""
    p = np.uint64(PRIME)
    x = (x & p) + (x >> np.uint64(31))
    x = (x & p) + (x >> np.uint64(31))
    return np.where(x >= p, x - p, x)


class Rolling:
    """Hashes of all k-grams of a sequence of code points from prefix sums."""

    def __init__(self, base: int, k: int) -> None:
        self.base, self.inverse, self.k = base, pow(base, -1, PRIME), k
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        n = len(points)
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, reduced(self.up * np.uint64(pow(self.base, m, PRIME)))])
            self.down = np.concatenate([self.down, reduced(self.down * np.uint64(pow(self.inverse, m, PRIME)))])
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(reduced(points * self.up[:n]), out=prefix[1:])
        return reduced(reduced(prefix[self.k :] - prefix[: -self.k]) * self.down[: n - self.k + 1])


def fingerprint_arrays(text: str, rolls: list[Rolling], w: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of one text's fingerprints."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(points) < rolls[0].k:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    high, low = (roll(points) for roll in rolls)
    grams = (high << np.uint64(31)) | low
    chosen, _, _ = winnow(grams, np.array([0, len(grams)]), w)
    return chosen, grams[chosen].astype(np.int64)


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc_id, position, hash): one row for each fingerprint of each text. A narrow map, no shuffle."""
    if k < 1 or window < 1:
        raise ValueError("k and window must be at least 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolls = [Rolling(b, k) for b in BASES]
        for part in pieces(batches, "text"):
            found = [fingerprint_arrays(t or "", rolls, window) for t in part.column("text").to_pylist()]
            counts = np.array([len(p) for p, _ in found])
            if not counts.sum():
                continue
            rows = np.repeat(np.arange(len(found)), counts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(rows)), pa.array(np.concatenate([p for p, _ in found])), pa.array(np.concatenate([h for _, h in found]))],
                names=["doc_id", "position", "hash"],
            )

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id bigint, position bigint, hash bigint")


ORACLE_SQL = f"""
WITH RECURSIVE longest AS (SELECT coalesce(max(length(text)), 0) AS n FROM documents),
lo(i, u1, d1, u2, d2) AS (
  SELECT 0::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT
  UNION ALL
  SELECT i + 1, u1 * {BASES[0]} % {PRIME}, d1 * {pow(BASES[0], -1, PRIME)} % {PRIME},
         u2 * {BASES[1]} % {PRIME}, d2 * {pow(BASES[1], -1, PRIME)} % {PRIME}
  FROM lo WHERE i < 255),
hi(i, u1, d1, u2, d2) AS (
  SELECT 0::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT, 1::BIGINT
  UNION ALL
  SELECT i + 1, u1 * {pow(BASES[0], 256, PRIME)} % {PRIME}, d1 * {pow(BASES[0], -256, PRIME)} % {PRIME},
         u2 * {pow(BASES[1], 256, PRIME)} % {PRIME}, d2 * {pow(BASES[1], -256, PRIME)} % {PRIME}
  FROM hi, longest WHERE i * 256 < n),
pw AS (
  SELECT hi.i * 256 + lo.i AS i, lo.u1 * hi.u1 % {PRIME} AS u1, lo.d1 * hi.d1 % {PRIME} AS d1, lo.u2 * hi.u2 % {PRIME} AS u2, lo.d2 * hi.d2 % {PRIME} AS d2
  FROM hi, lo),
c AS (SELECT doc_id, unnest(range(length(text))) AS i, unnest(string_split(text, '')) AS ch FROM documents WHERE length(text) >= {K}),
s AS (
  SELECT doc_id, c.i,
    sum((unicode(ch)::BIGINT * u1) % {PRIME}) OVER w AS p1, (unicode(ch)::BIGINT * u1) % {PRIME} AS t1, d1,
    sum((unicode(ch)::BIGINT * u2) % {PRIME}) OVER w AS p2, (unicode(ch)::BIGINT * u2) % {PRIME} AS t2, d2
  FROM c JOIN pw ON pw.i = c.i WINDOW w AS (PARTITION BY doc_id ORDER BY c.i)),
g AS (
  SELECT doc_id, i,
    ((((lead(p1, {K - 1}) OVER w - p1 + t1) % {PRIME})::BIGINT * d1) % {PRIME})::HUGEINT * 2147483648
      + ((((lead(p2, {K - 1}) OVER w - p2 + t2) % {PRIME})::BIGINT * d2) % {PRIME}) AS h
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
m AS (
  SELECT doc_id, i, min(h * 16777216 + (16777215 - i)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS least,
    count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM g WHERE h IS NOT NULL)
SELECT DISTINCT doc_id, (16777215 - least % 16777216)::BIGINT AS position, (least // 16777216)::BIGINT AS hash
FROM m WHERE k <= greatest(n - {WINDOW - 1}, 1)
"""
