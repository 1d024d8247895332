"""Near-duplicate documents by b-bit MinHash.

A text's words (lower case, ASCII letters and digits and non-ASCII characters) give shingles
of SHINGLE words; PERMUTATIONS multiply-add permutations of 32 bits give their minima. Of each
minimum the low BITS bits, after a mixing bijection, are packed into the signature. Whole
minima are only used in the same pass, for band keys and for a hash that tells texts with all
minima alike. Candidates are the texts that share a band key; their similarity is the
collision-corrected share of equal packed values, counted by xor and bit counts:
(p - 2**-b) / (1 - 2**-b). At and above threshold less SLACK (about one standard error) they
are near copies. Within a bucket each text is compared until it has a partner's group, which
keeps the same groups as all pairs and gives a spanning tree; groups are the connected components
over all buckets. A bucket of more than BLOCK texts is split into blocks of about BLOCK, and each
pair of its blocks is a bucket of its own: the same texts are compared, spread over many tasks.

With 32 bands of 4 rows a pair at similarity 0.6 shares a band with probability 0.988, at 0.7
with 0.9998.

Cases: a text without words (null, empty, punctuation) is nobody's copy; one of fewer than
SHINGLE words has one shingle, all of it. Of each group the row with the least doc_id stays
(null last; of one doc_id's different texts, the least text hash). Rows equal in doc_id and text,
whatever their other columns hold, are one row of the group: of them that of least hash over all
columns stays. Rows and texts are known by hashes of 128 bits. Other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.common import cut, one_of_each, pieces, released, row_key
from leafmill.llm.components import components
from leafmill.llm.tokens import Powers, Words, alphanumeric, buffer_of, gram_hashes, mix, word_hashes

SHINGLE, PERMUTATIONS, BITS, BANDS, THRESHOLD, SLACK, BLOCK = 3, 128, 4, 32, 0.6, 0.05, 8192


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(97)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def mix32(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return x ^ (x >> np.uint32(16))


def shingle_hashes(texts: pa.Array, shingle: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each text end to end, and the n + 1 bounds; a text of fewer words has one shingle."""
    words = Words(*buffer_of(pc.utf8_lower(texts.cast(pa.large_string()))), alphanumeric())
    hashes, counts = word_hashes(words, powers), np.diff(words.first)
    sizes = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(bounds[-1]) + np.repeat(words.first[:-1] - bounds[:-1], sizes)
    grams = np.zeros(bounds[-1], dtype=np.uint64)
    full = np.repeat(counts >= shingle, sizes)
    grams[full] = gram_hashes(hashes, shingle, powers)[at[full]]
    for size in range(1, shingle):
        own = np.repeat(counts == size, sizes)
        if own.any():
            grams[own] = gram_hashes(hashes, size, powers)[at[own]]
    return grams, bounds


def minima(grams: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """A row of n minima for each text that has shingles."""
    a, b = coefficients(n)
    x = (grams >> np.uint64(32)).astype(np.uint32)
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), n), dtype=np.uint32)
    step = np.empty_like(x)
    for i in range(n):
        np.multiply(x, a[i], out=step)
        np.add(step, b[i], out=step)
        out[:, i] = np.minimum.reduceat(step, starts)
    return out


def packed(mins: np.ndarray) -> np.ndarray:
    """The low 4 bits of each mixed minimum, two to a byte."""
    low = (mix32(mins) & np.uint32(15)).astype(np.uint8)
    return low[:, ::2] | (low[:, 1::2] << 4)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many 4-bit values differ, of signatures as uint64 rows."""
    x = a ^ b
    x = x | (x >> np.uint64(1))
    x = (x | (x >> np.uint64(2))) & np.uint64(0x1111111111111111)
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def most_differing(threshold: float, slack: float, n: int = PERMUTATIONS, bits: int = BITS) -> float:
    """The largest count of differing values at which the corrected similarity still reaches threshold - slack."""
    chance = 2.0**-bits
    return n * (1 - (chance + (1 - chance) * (threshold - slack)))


def spanning(signatures: np.ndarray, most: float) -> list[tuple[int, int]]:
    """A spanning forest of the similar pairs of a bucket: each row is compared with all that no group has yet."""
    out, left = [], np.arange(1, len(signatures))
    queue = [0]
    while True:
        while queue and len(left):
            at = queue.pop()
            near = differing(signatures[left], signatures[at]) <= most
            out += [(at, int(x)) for x in left[near]]
            queue += left[near].tolist()
            left = left[~near]
        if not len(left):
            return out
        queue, left = [int(left[0])], left[1:]


def binary_rows(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    flat = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(flat.shape[1]), len(flat), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, row, full, packed, bands) of each text that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, rows = Powers(), PERMUTATIONS // BANDS
        for part in pieces(batches, "text", 1 << 20):
            grams, bounds = shingle_hashes(part.column("text"), SHINGLE, powers)
            has = np.flatnonzero(np.diff(bounds) > 0)
            if not len(has):
                continue
            mins = minima(grams, bounds, PERMUTATIONS)
            wide = mins.reshape(len(has), BANDS, rows).astype(np.uint64)
            with np.errstate(over="ignore"):
                keys = np.full((len(has), BANDS), 7, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for r in range(rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, r] + np.uint64(1))
                full = np.stack([mix((keys * mix(np.arange(a, a + BANDS, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)) for a in (1, 1001)], axis=1)
            bits = packed(mins)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(has)),
                    part.column("row").take(pa.array(has)),
                    binary_rows(full),
                    binary_rows(bits),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1).view(np.int64))),
                ],
                names=["doc_id", "row", "full", "packed", "bands"],
            )

    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), row_key("doc_id", "text").alias("row"))
    return own.mapInArrow(released(run), "doc_id bigint, row binary, full binary, packed binary, bands array<bigint>")


def bucket_edges(threshold: float, slack: float):
    most = most_differing(threshold, slack)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partitions sorted by key; the last bucket of a batch waits for the next batch."""
        held = None

        def edges(t: pa.Table) -> pa.RecordBatch:
            keys, nodes = t.column("key").to_numpy(), t.column("full").combine_chunks()
            sig = np.frombuffer(b"".join(t.column("packed").to_pylist()), dtype=np.uint64).reshape(len(t), -1)
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            size = np.diff(np.concatenate([start, [len(keys)]]))
            two = start[size == 2]
            two = two[differing(sig[two], sig[two + 1]) <= most]
            a, b = [two], [two + 1]
            for s, n in zip(start[size > 2], size[size > 2]):
                pairs = np.array(spanning(sig[s : s + n], most), dtype=np.int64).reshape(-1, 2)
                a.append(s + pairs[:, 0])
                b.append(s + pairs[:, 1])
            return pa.RecordBatch.from_arrays([nodes.take(pa.array(np.concatenate(x))) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            if not len(t):
                continue
            last = t.column("key")[len(t) - 1]
            cutoff = int(np.searchsorted(t.column("key").to_numpy(), last.as_py(), side="left"))
            if cutoff:
                yield edges(t.slice(0, cutoff).combine_chunks())
            held = t.slice(cutoff).combine_chunks()
        if held is not None and len(held):
            yield edges(held)

    return run


def copies(docs: DataFrame, threshold: float = THRESHOLD, slack: float = SLACK) -> tuple[DataFrame, DataFrame]:
    """(rows, repeated): rows that are copies of another row as (doc_id, row, duplicate_of), and row hashes that stand for several equal rows."""
    sigs = cut(signatures(docs))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    contents = sigs.groupBy("full").agg(F.count("*").alias("n"), first, F.first("packed").alias("packed"), F.first("bands").alias("bands"))
    # band keys travel without signatures; only texts that share one are joined with theirs
    keyed = contents.select("full", F.explode("bands").alias("key"))
    alive = keyed.withColumn("m", F.count("*").over(Window.partitionBy("key"))).where("m > 1").withColumn("n", F.ceil(F.col("m") / BLOCK).cast("int"))
    own, other = F.pmod(F.hash("full"), F.col("n")), F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    split = alive.select("full", "key", "n", own.alias("own"), other.alias("other"))
    split = split.select("full", F.when(F.col("n") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).alias("key"))
    buckets = split.join(contents.select("full", "packed"), "full").select("key", "full", "packed").repartition("key").sortWithinPartitions("key", "full")
    labels = components(buckets.mapInArrow(bucket_edges(threshold, slack), "a binary, b binary"))
    shared = sigs.groupBy("full").agg(F.count("*").alias("n"), first).join(labels, F.col("full") == F.col("node"), "left").where("n > 1 or root is not null").select("full", "first", F.coalesce("root", "full").alias("root"))
    kept = shared.groupBy("root").agg(F.min("first").alias("kept"))
    rows = (
        sigs.select("doc_id", "row", "full")
        .join(shared.join(kept, "root").select("full", "kept"), "full")
        .where(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("row") == F.col("kept.row"))))
        .select("doc_id", "row", F.col("kept.doc_id").alias("duplicate_of"))
    )
    repeated = sigs.groupBy("row").count().where("count > 1").select("row")
    return rows, repeated


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, slack: float = SLACK) -> DataFrame:
    """(doc_id, duplicate_of): each document that goes, with the one of its group that stays. Rows without a doc_id aren't listed."""
    rows, _ = copies(docs, threshold, slack)
    return rows.where("doc_id is not null and doc_id <> duplicate_of").select("doc_id", "duplicate_of").distinct()


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, slack: float = SLACK) -> DataFrame:
    """docs with one row of each group; its columns and all other rows unchanged."""
    rows, repeated = copies(docs, threshold, slack)
    repeated = cut(repeated)
    marked = docs.withColumn("__leafmill_row", row_key("doc_id", "text"))
    left = marked.join(rows.select(F.col("row").alias("__leafmill_row")).distinct(), "__leafmill_row", "left_anti")
    if not repeated.isEmpty():
        again = repeated.select(F.col("row").alias("__leafmill_row"))
        left = left.join(again, "__leafmill_row", "left_anti").unionByName(one_of_each(left.join(again, "__leafmill_row", "left_semi"), ["__leafmill_row"]))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
