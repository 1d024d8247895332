"""Incremental substring dedup by a log-structured index of window hashes.

Every text is winnowed: of each GAP windows of K words in a row the least hashed (rightmost of
equals) is kept, so a passage of K + GAP - 1 = WORDS words that two texts share gives both the
same window hash. The index holds each hash once, with the first place that had it, in
immutable runs: bucketed by hash and sorted within each bucket, one file a bucket. A new batch
is reduced to its own first places by hash and merge-joined with every run, bucket by bucket,
which moves none of the history; what no run has becomes a new run. When FAN runs of a level
are there they are merged into one of the next level.

A kept window stands for the runs of WORDS words that keep it; together they are its context,
and each run of WORDS words belongs to one kept window. A window met earlier whose context is
that of its hash's first place gives a candidate, its text against that of the first place.
Where the contexts differ, the runs of WORDS words of both are hashed whole, and each run met
earlier gives a candidate against its own first place, so a hash that a shorter piece had first
hides no later repeat. Both kinds together name every run of WORDS words that came earlier.

Candidates of one pair of rows and one displacement make one range; its words, and WORDS more
on both sides, are compared with those of the earlier text, which travels once for each
SHARE ranges that point at it. Maximal runs of WORDS equal words are the verified spans.

Order: by batch, then (doc_id, row hash, word), null doc_ids last. A span that overlaps its own
first occurrence loses only the words beyond it. Words are what ASCII white space separates,
compared exactly. Cases: null and empty texts and those of fewer than WORDS words have no
spans. Rows equal in doc_id and text are one document, so a batch that comes twice adds
nothing. An empty batch changes nothing. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm.common import cut, pieces, released, remove_path, row_hash, shared_path, small_batches
from leafmill.llm.suffixes import merged_spans
from leafmill.llm.tokens import Powers, Words, buffer_of, gram_hashes, mix, not_space, winnow, word_hashes

K, GAP, FAN, BATCHES, SHARE = 20, 21, 3, 4, 4096
WORDS = K + GAP - 1
PIECE = 1 << 19  # bytes of text that a worker takes at a time

PLACE = "struct<batch int, no_id boolean, doc_id bigint, row bigint, pos int, context bigint, before int, more int>"


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), row_hash(0, "doc_id", "text").alias("row"))


def run_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """The hash of each run of words from starts[i] to before ends[i]."""
    up, down = powers.to(len(words) + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * up[:-1], out=prefix[1:])
        return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(rows: DataFrame, k: int = K, gap: int = GAP) -> DataFrame:
    """(hash, doc_id, row, pos, context, before, more): the kept windows of each text of k + gap - 1 words or more.

    The runs of k + gap - 1 words that keep a window begin before words ahead of pos and go on for
    more further starts; context is the hash of all their words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, table = Powers(), not_space()
        for part in pieces(batches, "text", PIECE):
            w = Words(*buffer_of(part.column("text")), table)
            counts = np.diff(w.first)
            long = np.flatnonzero(counts >= k + gap - 1)
            if not len(long):
                continue
            hashes = word_hashes(w, powers)
            grams = gram_hashes(hashes, k, powers)
            sizes = counts[long] - k + 1
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            grams = grams[np.arange(bounds[-1]) + np.repeat(w.first[:-1][long] - bounds[:-1], sizes)]
            chosen, lo, hi = winnow(grams, bounds, gap)
            own = np.searchsorted(bounds, chosen, side="right") - 1
            of, base = pa.array(long[own]), w.first[:-1][long[own]] - bounds[own]
            context = run_hashes(hashes, base + lo, base + hi + k + gap - 1, powers)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[chosen].view(np.int64)), part.column("doc_id").take(of), part.column("row").take(of), pa.array((chosen - bounds[own]).astype(np.int32)), pa.array(context.view(np.int64)), *(pa.array(x.astype(np.int32)) for x in (chosen - lo, hi - lo))],
                names=["hash", "doc_id", "row", "pos", "context", "before", "more"],
            )

    return rows.mapInArrow(released(run), "hash bigint, doc_id bigint, row bigint, pos int, context bigint, before int, more int")


class Run:
    """An immutable sorted run: files in the shared folder, known to the session as a bucketed table. firsts comes partitioned by hash, a task a bucket; the rows that are not fresh are in earlier runs and serve their own batch only."""

    def __init__(self, spark: SparkSession, firsts: DataFrame, level: int, buckets: int) -> None:
        self.spark, self.level = spark, level
        self.path, self.name = shared_path(spark, "run"), f"leafmill_run_{uuid.uuid4().hex}"
        firsts.write.bucketBy(buckets, "hash").sortBy("hash").option("path", self.path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name).where("fresh").select("hash", "first")

    def met(self) -> DataFrame:
        return self.spark.table(self.name).where("met").select("hash", "first")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_path(self.spark, self.path)


class Index:
    """Runs by level. add() takes a batch of window hashes and gives its candidates."""

    def __init__(self, spark: SparkSession, fan: int = FAN, buckets: int | None = None) -> None:
        self.spark, self.fan, self.batch = spark, fan, 0
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[Run] = []

    def add(self, hashes: DataFrame) -> DataFrame:
        """(own, first, alike) of each window that has an earlier place: both places, and if their contexts are equal; then the batch's own first places become a run."""
        self.batch += 1
        place = F.struct(F.lit(self.batch).alias("batch"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "pos", "context", "before", "more")
        new = hashes.groupBy("hash").agg(F.min(place).alias("own"), F.count("*").alias("n")).repartition(self.buckets, "hash")
        old = []
        self.spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")  # runs come sorted
        try:
            for i, r in enumerate(self.runs):
                new = new.join(r.read().select("hash", F.col("first").alias(f"first{i}")).hint("merge"), "hash", "left")
                old.append(F.col(f"first{i}"))
            known = F.coalesce(*old) if old else F.lit(None).cast(PLACE)
            run = Run(self.spark, new.select("hash", F.coalesce(known, "own").alias("first"), known.isNull().alias("fresh"), ((F.col("n") > 1) | known.isNotNull()).alias("met")), 0, self.buckets)
        finally:
            self.spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")
        found = cut(
            hashes.join(run.met(), "hash")
            .where(~((F.col("row") == F.col("first.row")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))))
            .select(place.alias("own"), "first", (F.col("context") == F.col("first.context")).alias("alike"))
        )
        self.runs.append(run)
        self.compact()
        return found

    def compact(self) -> None:
        """Merges the runs of each level that has fan of them into one of the next."""
        level = 0
        while any(r.level >= level for r in self.runs):
            own = [r for r in self.runs if r.level == level]
            if len(own) >= self.fan:
                both = own[0].read()
                for r in own[1:]:
                    both = both.unionByName(r.read())
                self.runs = [r for r in self.runs if r.level != level] + [Run(self.spark, both.withColumns({"fresh": F.lit(True), "met": F.lit(False)}).repartition(self.buckets, "hash"), level + 1, self.buckets)]
                for r in own:
                    r.drop()
            level += 1

    def drop(self) -> None:
        for r in self.runs:
            r.drop()
        self.runs = []


def paired(found: DataFrame, own: str, first: str, pos: str) -> DataFrame:
    """(doc_id, row, pos, first_doc_id, first_row, first_pos): candidates as verified() takes them."""
    return found.select(*(F.col(f"{own}.{c}").alias(c) for c in ("doc_id", "row")), F.col(f"{own}.{pos}").alias("pos"), *(F.col(f"{first}.{c}").alias(f"first_{c}") for c in ("doc_id", "row")), F.col(f"{first}.{pos}").alias("first_pos"))


def whole_runs(rows: DataFrame, words: int) -> DataFrame:
    """(full, place): the hash of each run of words words that the listed windows stand for, and where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, table = Powers(), not_space()
        for part in pieces(batches, "text", PIECE):
            w = Words(*buffer_of(part.column("text")), table)
            full = gram_hashes(word_hashes(w, powers), words, powers)
            listed = part.column("listed")
            flat, sizes = listed.flatten(), listed.value_lengths().to_numpy(zero_copy_only=False)
            batch, pos, before, more = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4))
            text = np.repeat(np.arange(len(part)), sizes)
            each = np.repeat(np.arange(len(text)), more + 1)
            start = (pos - before)[each] + np.arange(len(each)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
            hashes = full[w.first[:-1][text[each]] + start].view(np.int64)
            for at in range(0, len(each), 1 << 16):
                of, s = pa.array(text[each[at : at + (1 << 16)]]), slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[s]), pa.array(batch[each[s]].astype(np.int32)), part.column("doc_id").take(of), part.column("row").take(of), pa.array(start[s].astype(np.int32))], names=["full", "batch", "doc_id", "row", "start"]
                )

    found = rows.select("doc_id", "row", "text", "listed").mapInArrow(released(run), "full bigint, batch int, doc_id bigint, row bigint, start int")
    return found.select("full", F.struct("batch", F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "start").alias("place"))


def contested(found: DataFrame, docs: DataFrame, k: int = K, gap: int = GAP) -> DataFrame:
    """Candidates among the windows whose context is not that of their hash's first place, by whole runs of k + gap - 1 words."""
    late = found.where("not alike")
    places = late.select(F.explode(F.array("own", "first")).alias("p")).select("p.row", F.struct("p.batch", "p.pos", "p.before", "p.more").alias("p"))
    lists = places.groupBy("row").agg(F.collect_set("p").alias("listed"))
    runs = whole_runs(rows_of(docs).join(lists, "row"), k + gap - 1)
    first = F.first("place").over(Window.partitionBy("full").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return paired(runs.withColumn("first", first).where("place != first"), "place", "first", "start")


def ranges(rows: DataFrame, words: int) -> DataFrame:
    """(first_row, share, kind, doc_id, row, start, first_start, first_doc_id, text): the words about each listed range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text", PIECE):
            listed = part.column("listed")
            flat, ends = listed.flatten(), np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False))
            lo, hi, first_lo = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "hi", "first_lo"))
            start = np.maximum(np.maximum(lo - words, lo - first_lo), 0)
            of, texts, size, at = np.searchsorted(ends, np.arange(len(flat)), side="right"), [], 0, None
            for i, t in enumerate(of.tolist()):
                if t != at:
                    at, own = t, part.column("text")[t].as_py().encode("utf-8", "surrogatepass").split()
                texts.append(b" ".join(own[start[i] : hi[i] + words]))
                size += len(texts[-1])
                if size >= PIECE or len(texts) == 2048 or i + 1 == len(flat):
                    s, x = slice(i + 1 - len(texts), i + 1), pa.array(of[i + 1 - len(texts) : i + 1])
                    yield pa.RecordBatch.from_arrays(
                        [flat.field("first_row")[s], flat.field("share")[s], pa.array(np.ones(len(x), dtype=np.int32)), part.column("doc_id").take(x), part.column("row").take(x), pa.array(start[s].astype(np.int32)), pa.array((start - lo + first_lo)[s].astype(np.int32)), flat.field("first_doc_id")[s], pa.array(texts, pa.binary())],
                        names=["first_row", "share", "kind", "doc_id", "row", "start", "first_start", "first_doc_id", "text"],
                    )
                    texts, size = [], 0

    return rows.mapInArrow(released(run), "first_row bigint, share bigint, kind int, doc_id bigint, row bigint, start int, first_start int, first_doc_id bigint, text binary")


def equal_runs(a: list[bytes], b: list[bytes], least: int) -> list[tuple[int, int]]:
    """Maximal runs of least or more equal words at equal places."""
    n = min(len(a), len(b))
    same = np.fromiter((x == y for x, y in zip(a, b)), dtype=bool, count=n)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    return [(int(x), int(y)) for x, y in zip(edge[::2], edge[1::2]) if y - x >= least]


def compared(words: int) -> Callable:
    """A map of partitions sorted so that each earlier text comes before the ranges that point at it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, earlier = None, []
        for batch in pieces(batches, "text", PIECE):
            out = []
            for first_row, share, kind, doc_id, row, start, first_start, first_doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not kind:
                    at, earlier = (first_row, share), text.split()
                elif at == (first_row, share):
                    own = text.split()
                    for x, y in equal_runs(own, earlier[first_start : first_start + len(own)], words):
                        if row == first_row and doc_id == first_doc_id:  # only the words beyond the first occurrence
                            x = max(x, first_start + y - start)
                        if x < y:
                            out.append((doc_id, row, start + x, start + y, first_doc_id))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=["doc_id", "row", "start_word", "end_word", "first_doc_id"])

    return run


def verified(candidates: DataFrame, docs: DataFrame, k: int = K, gap: int = GAP) -> DataFrame:
    """(doc_id, row, start_word, end_word, first_doc_id): spans of k + gap - 1 words or more that are equal word for word."""
    words = k + gap - 1
    own = rows_of(docs)
    one = candidates.groupBy("row", "doc_id", "first_row", "first_doc_id", (F.col("pos") - F.col("first_pos")).alias("off")).agg(F.min("pos").alias("lo"), (F.max("pos") + k).alias("hi"))
    many = cut(one)
    pointed = many.groupBy("first_row").agg(F.ceil(F.count("*") / SHARE).cast("bigint").alias("shares"))
    shared = many.join(pointed, "first_row").withColumn("share", F.pmod(F.xxhash64("row", "off"), F.col("shares")))
    lists = shared.groupBy("row").agg(F.collect_list(F.struct("first_row", "share", "first_doc_id", "lo", "hi", (F.col("lo") - F.col("off")).alias("first_lo"))).alias("listed"))
    left = ranges(own.join(lists, "row"), words)
    sources = own.join(pointed, own["row"] == pointed["first_row"]).select(
        "first_row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), "doc_id", "row", F.lit(0).alias("start"), F.lit(0).alias("first_start"), F.lit(None).cast("bigint").alias("first_doc_id"), F.col("text").cast("binary").alias("text")
    )
    both = left.unionByName(sources).repartition("first_row", "share").sortWithinPartitions("first_row", "share", "kind")
    return both.select("first_row", "share", "kind", "doc_id", "row", "start", "first_start", "first_doc_id", "text").mapInArrow(released(compared(words)), "doc_id bigint, row bigint, start_word int, end_word int, first_doc_id bigint")


def incremental_spans(docs: DataFrame, batches: int = BATCHES, k: int = K, gap: int = GAP, fan: int = FAN) -> DataFrame:
    """(doc_id, start_word, end_word, first_doc_id): spans to remove when docs come in batches, by a hash of their doc_id.

    The texts are hashed once; all batches' candidates are verified together at the end, which
    gives the same spans since a batch's verification has no effect on the runs. The spans are
    computed at once, while the Arrow batches are small.
    """
    with small_batches(docs.sparkSession):
        return cut(spans_of_batches(docs, batches, k, gap, fan))


def spans_of_batches(docs: DataFrame, batches: int, k: int, gap: int, fan: int) -> DataFrame:
    """The rows of incremental_spans(), whose last joins have not run yet."""
    spark = docs.sparkSession
    path, stored = shared_path(spark, "windows"), "hash bigint, doc_id bigint, row bigint, pos int, context bigint, before int, more int, batch int"
    window_hashes(rows_of(docs), k, gap).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(path)
    if not spark.read.schema(stored).parquet(path).limit(1).collect():
        return spark.createDataFrame([], "doc_id bigint, start_word int, end_word int, first_doc_id bigint")
    hashes = spark.read.schema(stored).parquet(path)
    index, found = Index(spark, fan), None
    for b in range(batches):
        own = index.add(hashes.where(F.col("batch") == b).drop("batch"))
        found = own if found is None else found.unionByName(own)
    index.drop()
    remove_path(spark, path)
    candidates = paired(found.where("alike"), "own", "first", "pos").unionByName(contested(found, docs, k, gap))
    return merged_spans(verified(candidates, docs, k, gap), "doc_id", "row").drop("row")
