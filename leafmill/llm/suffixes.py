"""Suffix-array dedup of repeated word runs, sorted deep-shallow.

Words are what ASCII white space separates, compared exactly. A window of WORDS words that
occurs earlier in the corpus, by (doc_id, word), is a repeat; of each repeated window the
earliest occurrence stays and the words of all others are reported as spans to remove. A
repeat that overlaps its own first occurrence loses only the words beyond it.

Every window belongs to the least hashed ANCHOR-gram in it (the rightmost of equals), so equal
windows have equal anchors at equal places, and the windows of one anchor lie side by side.
Anchors that occur once can't hold a repeat and are left out; the others' windows travel as one
context to the anchor's task. There the suffixes that begin at the anchor are sorted: multikey
quicksort on words down to SHALLOW words, then a blind trie for each group still tied, which
branches on single words and compares a suffix in full only once. Runs of the sorted suffixes
with long enough common prefixes, split by the words before the anchor, are the sets of equal
windows. Contexts met by no other differing context are settled without sorting.

Cases: null and empty texts and those of fewer than WORDS words have no windows. Rows equal in
doc_id and text are one document; those without a doc_id come last and are told apart by their
text only. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.common import pieces, row_hash
from leafmill.llm.tokens import Powers, Words, buffer_of, byte_values, gram_hashes, not_space, winnow

WORDS, ANCHOR, SHALLOW = 40, 8, 12


def multikey_quicksort(rows: list[int], strings: list[list[int]], depth: int, shallow: int, groups: list[tuple[list[int], int]]) -> None:
    """Appends to groups, in order, lists of rows alike down to their depth: single rows, or rows tied at the shallow depth or to their end."""
    stack = [(rows, depth)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) < 2 or depth >= shallow:
            groups.append((rows, depth))
            continue
        at = [strings[r][depth] if depth < len(strings[r]) else -1 for r in (rows[0], rows[len(rows) // 2], rows[-1])]
        pivot = sorted(at)[1]
        less, same, more = [], [], []
        for r in rows:
            c = strings[r][depth] if depth < len(strings[r]) else -1
            (same if c == pivot else less if c < pivot else more).append(r)
        if more:
            stack.append((more, depth))
        if pivot < 0:  # these have ended, nothing sorts before them
            groups.append((same, depth))
            continue
        stack.append((same, depth + 1))
        if less:
            stack.append((less, depth))


class BlindTrie:
    """Sorts strings that share their first words: inner nodes know only a depth and the branching words."""

    def __init__(self, strings: list[list[int]]) -> None:
        self.strings, self.root = strings, None

    def insert(self, row: int) -> None:
        s = self.strings[row]
        if self.root is None:
            self.root = [None, [row]]
            return
        node, path = self.root, []
        while node[0] is not None:  # down by the branching words alone, to any leaf where there is none
            path.append(node)
            c = s[node[0]] if node[0] < len(s) else -1
            node = node[1].get(c) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        common, n = 0, min(len(s), len(other))
        while common < n and s[common] == other[common]:
            common += 1
        if common == len(s) == len(other):
            node[1].append(row)
            return
        parent, child, via = None, self.root, None
        while child[0] is not None and child[0] < common:
            parent, via = child, (s[child[0]] if child[0] < len(s) else -1)
            child = child[1][via]
        mine, theirs = (s[common] if common < len(s) else -1), (other[common] if common < len(other) else -1)
        if child[0] == common:
            child[1][mine] = [None, [row]]
            return
        new = [common, {theirs: child, mine: [None, [row]]}]
        if parent is None:
            self.root = new
        else:
            parent[1][via] = new

    def ordered(self) -> list[int]:
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                out += node[1]
            else:
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        return out


def deep_shallow_sort(strings: list[list[int]], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """The strings in order and, for each but the first, the length of its common prefix with the one before. depth words are known to be alike."""
    groups: list[tuple[list[int], int]] = []
    multikey_quicksort(list(range(len(strings))), strings, depth, depth + shallow, groups)
    order: list[int] = []
    for rows, _ in groups:
        if len(rows) > 1:
            trie = BlindTrie(strings)
            for r in rows:
                trie.insert(r)
            rows = trie.ordered()
        order += rows
    common = []
    for a, b in zip(order, order[1:]):
        x, y, i = strings[a], strings[b], depth
        n = min(len(x), len(y))
        while i < n and x[i] == y[i]:
            i += 1
        common.append(i)
    return order, common


def anchors(docs: DataFrame, words: int, anchor: int) -> DataFrame:
    """(anchor, row, pos, lo, hi): the anchors of each text and the first and last window each owns; all count words of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, values, table = Powers(), byte_values(), not_space()
        for part in pieces(batches, "text"):
            w = Words(*buffer_of(part.column("text")), table)
            counts = np.diff(w.first)
            long = np.flatnonzero(counts >= words)
            if not len(long):
                continue
            hashes = w.hashes(values, powers)
            sizes = counts[long] - anchor + 1
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            shift = np.repeat(w.first[:-1][long] - bounds[:-1], sizes)
            grams = gram_hashes(hashes, anchor, powers)[np.arange(bounds[-1]) + shift]
            chosen, lo, hi = winnow(grams, bounds, words - anchor + 1)
            own = np.searchsorted(bounds, chosen, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grams[chosen].view(np.int64)),
                    part.column("row").take(pa.array(long[own])),
                    pa.array((chosen - bounds[own]).astype(np.int32)),
                    pa.array((lo - bounds[own]).astype(np.int32)),
                    pa.array((hi - bounds[own]).astype(np.int32)),
                ],
                names=["anchor", "row", "pos", "lo", "hi"],
            )

    return docs.mapInArrow(run, "anchor bigint, row bigint, pos int, lo int, hi int")


def contexts(docs: DataFrame, words: int) -> DataFrame:
    """(anchor, before, context, doc_id, row, start): the words of each listed anchor's windows. docs has the anchors of its text in a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            listed = part.column("anchors")
            counts = np.diff(listed.offsets.to_numpy())
            flat = listed.flatten()
            anchor, pos, lo, hi = (flat.field(i).to_numpy() for i in range(4))
            out, at = [], 0
            for text, n in zip(part.column("text").to_pylist(), counts):
                own = text.encode("utf-8", "surrogatepass").split()
                out += [b" ".join(own[a : b + words]) for a, b in zip(lo[at : at + n].tolist(), hi[at : at + n].tolist())]
                at += n
            of = pa.array(np.repeat(np.arange(len(part)), counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(pos - lo), pa.array(out, pa.binary()), part.column("doc_id").take(of), part.column("row").take(of), pa.array(lo)], names=["anchor", "before", "context", "doc_id", "row", "start"]
            )

    return docs.mapInArrow(run, "anchor bigint, before int, context binary, doc_id bigint, row bigint, start int")


def equal_windows(befores: list[int], texts: list[bytes], words: int, anchor: int, shallow: int) -> list[list[int]]:
    """For each context and each of its windows, the number of the set of equal windows that it is in."""
    numbers: dict[bytes, int] = {}
    tokens = [[numbers.setdefault(x, len(numbers)) for x in t.split(b" ")] for t in texts]
    order, common = deep_shallow_sort([t[b:] for t, b in zip(tokens, befores)], anchor, shallow)
    out = [[-1] * (len(t) - words + 1) for t in tokens]
    sets: dict[tuple, int] = {}
    for offset in range(max(befores) + 1):  # of the anchor in the window
        run = 0
        for at, i in enumerate(order):
            if at and common[at - 1] < words - offset:
                run = at
            window = befores[i] - offset
            if 0 <= window < len(out[i]):
                out[i][window] = sets.setdefault((offset, run, *tokens[i][window : befores[i]]), len(sets))
    return out


def differing(words: int, anchor: int, shallow: int):
    """A map over partitions sorted by anchor, for anchors of several contexts; the last anchor of a batch waits for the next."""

    def spans(t: pa.Table) -> Iterator[tuple]:
        keys = t.column("anchor").to_numpy()
        bounds = np.concatenate([np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), [len(keys)]]).tolist()
        befores, texts, places = t.column("before").to_pylist(), t.column("context").to_pylist(), t.column("places").to_pylist()
        for a, b in zip(bounds, bounds[1:]):
            own = [sorted((p["no_id"], p["doc_id"] or 0, p["row"], p["start"]) for p in places[i]) for i in range(a, b)]
            sets = equal_windows(befores[a:b], texts[a:b], words, anchor, shallow)
            first: dict[int, tuple] = {}
            for windows, at in zip(sets, own):
                p = at[0]
                for w, k in enumerate(windows):
                    place = (*p[:3], p[3] + w)
                    if k not in first or place < first[k]:
                        first[k] = place
            for windows, at in zip(sets, own):
                for n, p in enumerate(at):
                    if n == 0 and all(first[k] == (*p[:3], p[3] + w) for w, k in enumerate(windows)):
                        continue
                    held = None
                    for w, k in enumerate(windows):
                        f, start = first[k], p[3] + w
                        if f == (*p[:3], start):
                            continue
                        shift = (f[:3], start - f[3])
                        if held and held[0] == shift and held[2] == start - 1 + words:
                            held[2] = start + words
                            continue
                        if held:
                            yield p, held
                        begin = max(start, f[3] + words) if f[:3] == p[:3] else start
                        held = [shift, begin, start + words]
                    if held:
                        yield p, held

    def batch_of(t: pa.Table) -> pa.RecordBatch:
        got = list(spans(t))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None if p[0] else p[1] for p, _ in got], pa.int64()),
                pa.array([p[2] for p, _ in got], pa.int64()),
                pa.array([h[1] for _, h in got], pa.int32()),
                pa.array([h[2] for _, h in got], pa.int32()),
                pa.array([None if h[0][0][0] else h[0][0][1] for _, h in got], pa.int64()),
            ],
            names=["doc_id", "row", "start_word", "end_word", "first_doc_id"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column("anchor").to_numpy()
            cutoff = int(np.searchsorted(keys, keys[-1], side="left"))
            if held and held[-1].column("anchor")[0].as_py() != keys[0]:
                yield batch_of(pa.Table.from_batches(held))
                held = []
            if cutoff:
                yield batch_of(pa.Table.from_batches([*held, batch.slice(0, cutoff)]))
                held = []
            held.append(batch.slice(cutoff))
        if held:
            yield batch_of(pa.Table.from_batches(held))

    return run


def merged_spans(spans: DataFrame, *keys: str) -> DataFrame:
    """Spans of each key that overlap or touch made one; the first of them names the earlier document."""
    w = Window.partitionBy(*keys).orderBy("start_word", "end_word", "first_doc_id")
    new = F.coalesce((F.col("start_word") > F.max("end_word").over(w.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(0))
    return spans.withColumn("island", F.sum(new).over(w)).groupBy(*keys, "island").agg(F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"), F.min_by("first_doc_id", "start_word").alias("first_doc_id")).drop("island")


def repeated_spans(docs: DataFrame, words: int = WORDS, anchor: int = ANCHOR, shallow: int = SHALLOW) -> DataFrame:
    """(doc_id, start_word, end_word, first_doc_id): word spans to remove, and a document that has the same words earlier."""
    if not 1 <= anchor <= words:
        raise ValueError("anchor must be between 1 and words")
    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), row_hash(0, "doc_id", "text").alias("row"))
    found = anchors(own, words, anchor)
    shared = found.withColumn("n", F.count("*").over(Window.partitionBy("anchor"))).where("n > 1")
    lists = shared.groupBy("row").agg(F.collect_list(F.struct("anchor", "pos", "lo", "hi")).alias("anchors"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "start")
    met = (
        contexts(own.join(lists, "row"), words)
        .repartition("anchor")
        .groupBy("anchor", "before", "context")
        .agg(F.collect_set(place).alias("places"))
        .withColumn("m", F.count("*").over(Window.partitionBy("anchor")))
        .where("m > 1 or size(places) > 1")
    )
    # one context only: every place but the earliest loses all of it
    size = F.size(F.split(F.col("context").cast("string"), " "))
    alike = (
        met.where("m = 1")
        .select(F.array_min("places").alias("first"), F.explode("places").alias("p"), size.alias("size"))
        .where("p <> first")
        .select(
            "p.doc_id",
            "p.row",
            F.when((F.col("p.row") == F.col("first.row")) & F.col("p.doc_id").eqNullSafe(F.col("first.doc_id")), F.greatest(F.col("p.start"), F.col("first.start") + words)).otherwise(F.col("p.start")).alias("start_word"),
            (F.col("p.start") + F.col("size")).alias("end_word"),
            F.col("first.doc_id").alias("first_doc_id"),
        )
    )
    several = met.where("m > 1").select("anchor", "before", "context", "places").sortWithinPartitions("anchor").mapInArrow(differing(words, anchor, shallow), "doc_id bigint, row bigint, start_word int, end_word int, first_doc_id bigint")
    return merged_spans(alike.unionByName(several).where("start_word < end_word"), "doc_id", "row").drop("row")
