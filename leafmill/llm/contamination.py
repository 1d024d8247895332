"""Benchmark decontamination with one FM-index per training shard.

A shard is the run of texts that a task holds at a time. Its lower-cased words become numbers
of the benchmark's vocabulary; runs of known words too short for any phrase can't hold a match
and are left out, which loses nothing since a phrase has known words only. Over what remains
the shard's suffix array is sorted by prefix doubling, its Burrows-Wheeler transform goes into
a wavelet matrix, all phrases (the n-grams of every benchmark item) are searched backwards at
once by its ranks, and occurrences are located by walking to sampled suffix positions.
Overlapping or touching occurrences merge into removal spans. The documents are read once and
never shuffled. The phrases go to the tasks as flat arrays, about 20 bytes a benchmark word; a
benchmark of more than PHRASE_WORDS words is searched in as many maps over the same batches, each
of which notes its occurrences beside the row; they merge after the last. So the limit bounds
memory and changes no result.

Cases: an item of MIN_WORDS to n - 1 words is one phrase; a shorter, empty or null one has no
phrase. A null or empty text has no spans. Repeated rows give repeated spans. A null doc_id is
kept as null. An empty benchmark gives no spans. Words are runs of ASCII letters, digits and
non-ASCII characters, compared in lower case; positions count them from 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import map_rows, pieces, released
from leafmill.llm.tokens import Powers, Words, alphanumeric, buffer_of, gram_hashes, word_hashes

N, MIN_WORDS, PHRASE_WORDS, SHARD_BYTES, SAMPLE = 8, 4, 1_000_000, 1 << 22, 8
NOTED = "__leafmill_spans"


class WaveletMatrix:
    """Ranks of symbols below 2**levels in a sequence, all queries at once."""

    def __init__(self, symbols: np.ndarray, levels: int) -> None:
        self.levels, self.zeros, self.ones = levels, [], []
        at = symbols
        for level in range(levels - 1, -1, -1):
            bit = (at >> level) & 1
            ones = np.zeros(len(at) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(at) - int(ones[-1]))
            at = np.concatenate([at[bit == 0], at[bit == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first places[i] ones."""
        low, high = np.zeros(len(places), dtype=np.int64), places.astype(np.int64)
        for level in range(self.levels):
            ones, zeros = self.ones[level], self.zeros[level]
            bit = ((symbols >> (self.levels - 1 - level)) & 1).astype(bool)
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """Suffixes in order by prefix doubling; sorts only what is still tied."""
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    s = ranks[order]
    head = np.concatenate([[True], s[1:] != s[:-1]])
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = group
    step = 1
    while True:
        single = np.concatenate([head[1:], [True]]) & head
        open_ = np.flatnonzero(~single)
        if not len(open_):
            return order
        at = order[open_]
        after = np.where(at + step < n, rank[np.minimum(at + step, n - 1)] + 1, 0)
        key = group[open_] * np.int64(n + 2) + after
        by = np.argsort(key, kind="stable")
        order[open_], key = at[by], key[by]
        head[open_] = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        rank[order[open_]] = group[open_]
        step *= 2


class FMIndex:
    """Counts and locates phrases in a sequence of symbols; symbol 0 separates and is never searched."""

    def __init__(self, symbols: np.ndarray, size: int, sample: int = SAMPLE) -> None:
        n, stops = len(symbols), symbols == 0
        ranks = symbols.astype(np.int64) + int(stops.sum())
        ranks[stops] = np.arange(int(stops.sum()))  # each separator differs, so no match crosses one
        order = suffix_array(ranks)
        before = symbols[order - 1]
        before[order == 0] = 0
        self.before, self.n = before, n
        self.wavelet = WaveletMatrix(before, max(1, int(size).bit_length()))
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size + 2))])
        # sampled: every sample-th position, and those after a separator, which no walk passes
        self.sampled = (order % sample == 0) | (before == 0)
        self.samples = order[self.sampled]
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])

    def search(self, words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The phrases are words[at], size words each. Numbers of those that occur, and their suffix ranges."""
        symbol = words[at + size - 1]
        low, high = self.starts[symbol], self.starts[symbol + 1]
        which = np.flatnonzero(low < high)  # most phrases end here, with a word that the shard doesn't have
        low, high = low[which], high[which]
        for back in range(size - 2, -1, -1):
            if not len(which):
                break
            symbol = words[at[which] + back]
            low, high = (self.starts[symbol] + self.wavelet.rank(symbol, x) for x in (low, high))
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        found, steps, todo, rows = np.zeros(len(rows), dtype=np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(todo):
            at = self.sampled[rows]
            found[todo[at]] = self.samples[self.sample_rank[rows[at]]] + steps
            todo, rows = todo[~at], rows[~at]
            symbol = self.before[rows]
            rows = self.starts[symbol] + self.wavelet.rank(symbol, rows)
            steps += 1
        return found


class Phrases:
    """The benchmark's phrases: its words as numbers, where each distinct phrase of a size begins, and the items each comes from."""

    def __init__(self, items: list[tuple[int | None, str | None]], n: int, min_words: int) -> None:
        words = Words(*buffer_of(pc.utf8_lower(pa.array([t for _, t in items], type=pa.large_string()))), alphanumeric())
        powers = Powers()
        hashes = word_hashes(words, powers)
        self.vocabulary = np.unique(hashes)
        self.words = (np.searchsorted(self.vocabulary, hashes) + 1).astype(np.int32)
        counts, ids = np.diff(words.first), [i for i, _ in items]
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({min(n, int(c)) for c in np.unique(counts) if c >= min(min_words, n) and c > 0}):
            own = np.flatnonzero(counts == size) if size < n else np.flatnonzero(counts >= n)
            per = counts[own] - size + 1
            at = np.repeat(words.first[own] - np.cumsum(per) + per, per) + np.arange(per.sum())
            of = np.repeat(own, per)
            _, first, number = np.unique(gram_hashes(hashes, size, powers)[at], return_index=True, return_inverse=True)
            other = np.zeros(len(at), dtype=bool)
            for j in range(size):  # phrases whose hashes alone are equal stay apart
                other |= self.words[at + j] != self.words[at[first][number] + j]
            number[other] = len(first) + np.arange(other.sum())
            order = np.lexsort((of, number))
            self.by_size[size] = (
                np.concatenate([at[first], at[other]]).astype(np.int64), np.searchsorted(number[order], np.arange(len(first) + other.sum() + 1)),
                np.array([np.iinfo(np.int64).min if ids[i] is None else ids[i] for i in of[order]], dtype=np.int64),
            )
        self.shortest = min(self.by_size, default=0)


def united(spans: list[tuple[int, int, list]]) -> list[tuple[int, int, list]]:
    """The spans in order, those that overlap or touch made one, each with its items in order."""
    out: list[list] = []
    for a, b, items in sorted(spans, key=lambda s: s[:2]):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
            out[-1][2].append(items)
        else:
            out.append([a, b, [items]])
    return [(a, b, np.unique(np.concatenate(items)) if len(items) > 1 else np.unique(items[0])) for a, b, items in out]


class Shard:
    """Removal spans of a batch of texts."""

    def __init__(self, phrases: Phrases) -> None:
        self.phrases, self.powers, self.table = phrases, Powers(), alphanumeric()

    def spans(self, texts: pa.Array) -> tuple[Words, dict[int, list[tuple[int, int, np.ndarray]]]]:
        """The words, and by text the occurrences: first word, word after the last, items; words count from the text's first."""
        words = Words(*buffer_of(pc.utf8_lower(texts.cast(pa.large_string()))), self.table)
        ph, found = self.phrases, {}
        if not ph.by_size or not len(words):
            return words, found
        hashes = word_hashes(words, self.powers)
        number = np.searchsorted(ph.vocabulary, hashes)
        number[number == len(ph.vocabulary)] = 0
        known = ph.vocabulary[number] == hashes
        begins = np.zeros(len(words) + 1, dtype=bool)
        begins[words.first] = True
        start = np.flatnonzero(known & (begins[:-1] | ~np.concatenate([[False], known[:-1]])))
        end = np.flatnonzero(known & (begins[1:] | ~np.concatenate([known[1:], [False]]))) + 1
        long = end - start >= ph.shortest
        start, end = start[long], end[long]
        if not len(start):
            return words, found
        sizes = end - start
        to = np.concatenate([[0], np.cumsum(sizes + 1)])
        place = np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)), sizes)
        source = np.full(to[-1], -1, dtype=np.int64)
        source[place] = np.repeat(start - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        symbols = np.zeros(to[-1], dtype=np.int64)
        symbols[place] = number[source[place]] + 1
        index = FMIndex(symbols, len(ph.vocabulary))
        for size, (phrase_at, bounds, items) in ph.by_size.items():
            which, low, high = index.search(ph.words, phrase_at, size)
            if not len(which):
                continue
            counts = high - low
            every = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
            at = source[index.locate(every)]
            text = np.searchsorted(words.first, at, side="right") - 1
            for t, w, p in zip(text.tolist(), (at - words.first[text]).tolist(), np.repeat(which, counts).tolist()):
                found.setdefault(t, []).append((w, w + size, items[bounds[p] : bounds[p + 1]]))
        return words, found


def blocks_of(benchmark: DataFrame, n: int, min_words: int, limit: int) -> list[Phrases]:
    """Phrases of the benchmark in blocks of about limit words at most."""
    own = benchmark.selectExpr("cast(item_id as bigint) item_id", "cast(text as string) text")
    # a word takes two characters at least, its separator included
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * limit)))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [Phrases([tuple(r) for r in own.where(block == i).orderBy("item_id", "text").collect()], n, min_words) for i in range(blocks)]


NOTES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("items", pa.list_(pa.int64()))]))


def noting(phrases: Phrases) -> Callable:
    """A map that adds its occurrences to those noted beside each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(phrases)
        for part in pieces(batches, "text", SHARD_BYTES):
            _, found = shard.spans(part.column("text"))
            if found:
                at = part.schema.get_field_index(NOTED)
                old = part.column(at).to_pylist()
                new = [[*(old[t] or ()), *({"a": a, "b": b, "items": items} for a, b, items in united(found[t]))] if t in found else old[t] for t in range(len(part))]
                part = part.set_column(at, part.schema.field(at), pa.array(new, type=NOTES))
            yield part

    return released(run)


def searched(docs: DataFrame, benchmark: DataFrame, n: int, min_words: int, limit: int) -> tuple[DataFrame, Phrases]:
    """docs with the occurrences of all blocks but the last noted (where there are several), and the last block."""
    *others, last = blocks_of(benchmark, n, min_words, limit)
    for i, phrases in enumerate(others):
        docs = map_rows(docs if i else docs.withColumn(NOTED, F.lit(None).cast("array<struct<a:bigint,b:bigint,items:array<bigint>>>")), noting(phrases))
    return docs, last


def with_noted(part: pa.RecordBatch, found: dict) -> dict[int, list[tuple[int, int, np.ndarray]]]:
    """By text, the merged spans of what was found and what was noted before."""
    at = part.schema.get_field_index(NOTED)
    for t, notes in enumerate(part.column(at).to_pylist() if at >= 0 else ()):
        for x in notes or ():
            found.setdefault(t, []).append((x["a"], x["b"], np.array(x["items"], dtype=np.int64)))
    return {t: united(found[t]) for t in sorted(found)}


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, n: int = N, min_words: int = MIN_WORDS, limit: int = PHRASE_WORDS) -> DataFrame:
    """(doc_id, start_word, end_word, item_id, n_items): the removal spans; end_word is the one after the last, item_id the least of the n_items that the span matches (items without an id aren't counted)."""
    noted, last = searched(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), benchmark, n, min_words, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(last)
        for part in pieces(batches, "text", SHARD_BYTES):
            by = with_noted(part, shard.spans(part.column("text"))[1])
            rows = [(t, a, b, items[items != np.iinfo(np.int64).min]) for t, spans in by.items() for a, b, items in spans]
            if rows:
                t, a, b, items = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(t)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([int(x[0]) if len(x) else None for x in items], pa.int64()), pa.array([len(x) for x in items], pa.int32())],
                    names=["doc_id", "start_word", "end_word", "item_id", "n_items"],
                )

    return noted.mapInArrow(released(run), "doc_id bigint, start_word bigint, end_word bigint, item_id bigint, n_items int")


def without_spans(text: str, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """The text less the spans, given as bytes of its lower-cased form, in which each character stands at its own place."""
    places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    kept, at = [], 0
    for a, b in zip(places[starts], places[ends]):
        kept.append(text[at:a])
        at = b
    return "".join([*kept, text[at:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, n: int = N, min_words: int = MIN_WORDS, limit: int = PHRASE_WORDS) -> DataFrame:
    """The documents with the spans cut from their texts; one that has no other words goes.

    Columns are those of docs; rows without a span are unchanged, null and empty texts included.
    """
    noted, last = searched(docs, benchmark, n, min_words, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(last)
        for part in pieces(batches, "text", SHARD_BYTES):
            words, found = shard.spans(part.column("text"))
            by = with_noted(part, found)
            if not by:
                yield part
                continue
            texts, gone = part.column("text").to_pylist(), []
            for t, spans in by.items():
                first, base = words.first[t], words.offsets[t]
                if sum(b - a for a, b, _ in spans) == words.first[t + 1] - first:
                    gone.append(t)
                a = np.array([words.starts[first + x] for x, _, _ in spans]) - base
                b = np.array([words.ends[first + y - 1] for _, y, _ in spans]) - base
                texts[t] = without_spans(texts[t], words.data[base : words.offsets[t + 1]], a, b)
            at = part.schema.get_field_index("text")
            part = part.set_column(at, part.schema.field(at), pa.array(texts, type=part.schema.field(at).type))
            keep = np.ones(len(part), dtype=bool)
            keep[gone] = False
            yield part.filter(pa.array(keep))

    return map_rows(noted, released(run)).drop(NOTED)


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '(?:[a-z0-9]|[^\\x00-\\x7F])+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(text), '(?:[a-z0-9]|[^\\x00-\\x7F])+') AS w FROM benchmark),
p AS (
  SELECT item_id, array_to_string(w[i + 1 : i + n], ' ') AS phrase, n
  FROM (SELECT item_id, w, least(len(w), {N}) AS n, unnest(range(greatest(len(w) - {N} + 1, 1))) AS i FROM b WHERE len(w) >= {MIN_WORDS})),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS phrase FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT doc_id, i AS a, i + g.n AS b, item_id FROM g JOIN p ON g.phrase = p.phrase AND g.n = p.n),
o AS (SELECT *, CASE WHEN a > max(b) OVER (PARTITION BY doc_id ORDER BY a, b, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM h),
k AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY a, b, item_id ROWS UNBOUNDED PRECEDING) AS island FROM o)
SELECT doc_id, min(a) AS start_word, max(b) AS end_word, min(item_id) AS item_id, count(DISTINCT item_id)::INT AS n_items FROM k GROUP BY doc_id, island
"""
