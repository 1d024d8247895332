"""Retrieval over chunks: exact and approximate cosine, BM25, fusion, quantization, context and history."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import base_name
from leafmill.llm.common import pieces, released

BLOCK, QUERIES, DOCS = 2048, 2048, 1024
#: Bytes of text that a worker splits into terms at a time, or one text.
TEXT = 1 << 20
#: Bytes of the vectors of a group of queries, and the least number of tasks of an exact search over a large base.
GROUP, TASKS = 1 << 24, 48


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the k highest scores of each row, ties by id; -inf is never among them."""
    n = scores.shape[1]
    least = np.partition(scores, n - k, axis=1)[:, n - k, None] if k < n else np.full((len(scores), 1), -np.inf)
    row, col = np.nonzero((scores >= least) & (scores > -np.inf))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    kept = np.arange(len(row)) - first[row] < k
    return row[kept], col[kept]


def cosines(q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines to six places, 0 where a vector has no length."""
    norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
    return np.round(np.divide(q @ b.T, norms, out=np.zeros(norms.shape), where=norms > 0), 6)


def top_places(qi: np.ndarray, q: np.ndarray, bi: np.ndarray, b: np.ndarray, k: int, skip_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and column numbers and scores of the k best rows of b for each of q."""
    s = cosines(q, b)
    if skip_self:
        s[qi[:, None] == bi[None, :]] = -np.inf
    row, col = best_of(s, bi, k)
    return row, col, s[row, col]


def top_pairs(qi: np.ndarray, q: np.ndarray, bi: np.ndarray, b: np.ndarray, k: int, skip_self: bool) -> pa.RecordBatch:
    row, col, score = top_places(qi, q, bi, b, k, skip_self)
    return pa.RecordBatch.from_arrays([pa.array(qi[row]), pa.array(bi[col]), pa.array(score)], names=["query_id", "id", "score"])


def kept_best(row: np.ndarray, ids: np.ndarray, score: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k entries of highest score of each of n rows, ties by id, in order."""
    order = np.lexsort((ids, -score, row))
    row, ids, score = row[order], ids[order], score[order]
    kept = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row] < k
    return row[kept], ids[kept], score[kept]


def exact_pairs(q: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray, at_once: int = 1 << 22) -> np.ndarray:
    """cosines() of the pairs (row, col) alone, about at_once numbers at a time."""
    out, step = np.zeros(len(row)), max(1, at_once // max(1, q.shape[1]))
    for i in range(0, len(row), step):
        x, y = q[row[i : i + step]], b[col[i : i + step]]
        norms = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
        np.divide(np.einsum("ij,ij->i", x, y), norms, out=out[i : i + step], where=norms > 0)
    return np.round(out, 6)


class Nearest:
    """The k best rows so far of each of a few queries, exact; the base comes a slice at a time.

    A product in single precision rules out what can't be among the k best: its error and the
    rounding to six places are less than margin, so nothing that counts is lost. The pairs that
    are left, few once the first slice is in, are scored in double precision.
    """

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, skip_self: bool):
        self.ids, self.q, self.k, self.skip_self = ids, q, k, skip_self
        self.short = unit(q).astype(np.float32)
        self.margin = 2.5e-7 * (q.shape[1] + 8) + 3e-6
        self.floor = np.full(len(q), -np.inf, dtype=np.float32)
        self.row, self.id, self.score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)

    def add(self, ids: np.ndarray, b: np.ndarray, short: np.ndarray) -> None:
        s = self.short @ short.T
        floor = self.floor
        if (new := np.isneginf(floor)).any() and len(ids) > self.k:
            t = s[new]
            if self.skip_self:
                t[self.ids[new][:, None] == ids[None, :]] = -np.inf
            floor = floor.copy()
            floor[new] = np.partition(t, len(ids) - self.k, axis=1)[:, len(ids) - self.k] - self.margin
        left = s >= floor[:, None]
        many, most = np.zeros(0, dtype=np.int64), 4 * self.k + 64
        if np.count_nonzero(left) > most * len(left):  # ties and near ties: a few rows at a time
            many = np.flatnonzero(left.sum(axis=1) > most)
        parts = []
        for i in range(0, len(many), 64):
            rows = many[i : i + 64]
            row, col, score = top_places(self.ids[rows], self.q[rows], ids, b, self.k, self.skip_self)
            parts.append((rows[row], ids[col], score))
        left[many] = False
        row, col = np.divmod(np.flatnonzero(left), len(ids))
        if self.skip_self:
            other = self.ids[row] != ids[col]
            row, col = row[other], col[other]
        parts.append((row, ids[col], exact_pairs(self.q, b, row, col)))
        if sum(len(p[0]) for p in parts):
            self._keep(*(np.concatenate(x) for x in zip((self.row, self.id, self.score), *parts, strict=True)))

    def _keep(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.row, self.id, self.score = kept_best(row, ids, score, len(self.q), self.k)
        full = np.bincount(self.row, minlength=len(self.q)) == self.k
        least = np.searchsorted(self.row, np.arange(len(self.q)), side="right") - 1
        self.floor[full] = self.score[least[full]] - self.margin

    def found(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.row]), pa.array(self.id), pa.array(self.score)], names=["query_id", "id", "score"])


def knn_cosine(queries: DataFrame, base: DataFrame, k: int, query_id: str, base_id: str, vector: str = "embedding", block: int = BLOCK, skip_self: bool = False) -> DataFrame:
    """(query_id, id, score, rank): the k most similar base rows of every query, scores to six places, ties by id.

    Queries are cut into groups of about GROUP bytes and the base into parts, so that there are
    about TASKS pairs of the two or more; each pair is a task that holds the group and lets the
    part pass by, block rows at a time, and only k rows a query and part are shuffled and ranked.
    Every pair of vectors is still compared, so the work is quadratic.
    """
    vectors = lambda df, name: df.where(f"`{vector}` is not null and `{name}` is not null").select(F.col(name).cast("bigint").alias("id"), F.col(vector).cast(kind).alias("v"))
    kind = "array<float>" if {df.schema[vector].dataType.simpleString() for df in (queries, base)} == {"array<float>"} else "array<double>"
    asked, own = vectors(queries, query_id), vectors(base, base_id)
    n_asked, size = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    groups = max(1, -(-n_asked * 8 * max(1, size or 0) // GROUP), -(-n_asked // (64 * block)))
    parts = max(1, min(-(-TASKS // groups), own.count() // (2 * block)))
    spread = lambda n, column: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(column)
    cell = (F.col("g") * parts + F.col("p")).cast("int").alias("cell")
    q = asked.select(F.lit(0).alias("side"), "id", "v", F.pmod(F.xxhash64("id"), F.lit(groups)).alias("g"), spread(parts, "p"))
    b = own.select(F.lit(1).alias("side"), "id", "v", spread(groups, "g"), F.pmod(F.xxhash64("id"), F.lit(parts)).alias("p"))
    both = q.select(cell, "side", "id", "v").unionByName(b.select(cell, "side", "id", "v")).repartitionById(groups * parts, "cell").sortWithinPartitions("side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, tiles = [], [], None
        for batch in batches:
            n = int(np.count_nonzero(batch.column("side").to_numpy() == 0))
            if n:
                ids.append(batch.column("id").slice(0, n).to_numpy())
                held.append(batch.column("v").slice(0, n).flatten().to_numpy().reshape(n, -1))
            if n == len(batch) or not ids:
                continue
            if tiles is None:
                qi, qv = np.concatenate(ids), np.concatenate(held)
                held.clear()
                tiles = [Nearest(qi[i : i + block], qv[i : i + block].astype(np.float64), k, skip_self) for i in range(0, len(qi), block)]
            for at in range(n, len(batch), block):
                some = batch.slice(at, block)
                bi, bv = some.column("id").to_numpy(), some.column("v").flatten().to_numpy().reshape(len(some), -1).astype(np.float64)
                real = ~np.isinf(np.linalg.norm(bv, axis=1))  # a score that is no number is no match
                bi, bv = bi[real], bv[real]
                short = unit(bv).astype(np.float32)
                for tile in tiles:
                    tile.add(bi, bv, short)
        for tile in tiles or ():
            yield tile.found()

    return ranked(both.mapInArrow(released(run), "query_id bigint, id bigint, score double"), k)


def unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, length, out=np.zeros_like(v), where=length > 0)


def cells_of(base: DataFrame, base_id: str, vector: str = "embedding", cells: int | None = None, sample: int = 20_000, rounds: int = 8) -> np.ndarray:
    """Centres of the cells of an inverted-file index: spherical k-means over at most sample rows, those of least id hash.

    The sample fits the cells alone; every row is then indexed. Equal inputs give equal centres.
    """
    rows = base.where(f"`{vector}` is not null").select(vector).orderBy(F.xxhash64(base_id), base_id).limit(sample).collect()
    if not rows:
        return np.zeros((1, 1))
    x = unit(np.array([r[0] for r in rows], dtype=np.float64))
    n = min(len(x), cells or max(1, round(np.sqrt(len(x)))))
    centres = x[np.linspace(0, len(x) - 1, n).astype(int)]
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(np.bincount(own, minlength=n)[:, None] > 0, unit(sums), centres)
    return centres


def in_cells(df: DataFrame, centres: np.ndarray, id_col: str, vector: str, nearest: int) -> DataFrame:
    """(id, v, cell): every row, once for each of its nearest cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            v = batch.column("v")
            x = unit(v.flatten().to_numpy().reshape(len(batch), -1))
            row, cell = best_of(x @ centres.T, np.arange(len(centres)), nearest)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), v.take(at), pa.array(cell.astype(np.int32))], names=["id", "v", "cell"])

    own = df.where(f"`{vector}` is not null").select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return own.mapInArrow(run, "id bigint, v array<double>, cell int")


def knn_approximate(queries: DataFrame, base: DataFrame, k: int, query_id: str, base_id: str, vector: str = "embedding", probes: int = 16, cells: int | None = None, skip_self: bool = False, block: int = BLOCK) -> DataFrame:
    """(query_id, id, score, rank) as knn_cosine(), looked for in each query's probes nearest cells only.

    Cells of many rows are split into blocks, and a cell's queries go to each of its blocks, so
    no task holds more than about block rows of either side's cell.
    """
    centres = cells_of(base, base_id, vector, cells)
    b, q = in_cells(base, centres, base_id, vector, 1), in_cells(queries, centres, query_id, vector, probes)

    def blocked(df: DataFrame, side: str) -> DataFrame:
        sizes = df.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))  # a row a cell
        return df.join(sizes, "cell").groupBy("cell", F.pmod(F.xxhash64("id"), F.col("n")).alias("part")).agg(F.collect_list("id").alias(f"{side}_ids"), F.flatten(F.collect_list("v")).alias(f"{side}_values")).drop("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                (qi, qv, bi, bv) = (batch.column(c)[r].values.to_numpy() for c in ("q_ids", "q_values", "b_ids", "b_values"))
                yield top_pairs(qi, qv.reshape(len(qi), -1), bi, bv.reshape(len(bi), -1), k, skip_self)

    pairs = blocked(q, "q").join(blocked(b, "b"), "cell").select("q_ids", "q_values", "b_ids", "b_values")
    return ranked(pairs.mapInArrow(run, "query_id bigint, id bigint, score double"), k)


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")


def term_counts(texts: pa.Array, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(length, doc, term, tf): the terms of each text, and how often each wanted one is in each."""
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), "[^a-z0-9]+")
    flat = lists.flatten()
    doc = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy(zero_copy_only=False))
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    number = pc.fill_null(pc.index_in(flat, value_set=wanted), -1).to_numpy(zero_copy_only=False)
    met = number >= 0
    pair, tf = np.unique(doc[met].astype(np.int64) * max(1, len(wanted)) + number[met], return_counts=True)
    return np.bincount(doc[real], minlength=len(texts)), pair // max(1, len(wanted)), pair % max(1, len(wanted)), tf


def bm25(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, most: int, k1: float = 1.2, b: float = 0.75, block: int = QUERIES) -> DataFrame:
    """(query_id, id, score, rank): for every query the most relevant rows that share a term with it, scores to six places, ties by id.

    One map over docs counts documents and lengths and the queries' terms, a second one scores:
    the terms' weights and the queries go to the tasks, a block of queries at a time (block of
    them, whatever the number), each task keeps most rows a query, and only those are shuffled
    and ranked. No posting is. Texts are split about TEXT bytes at a time. Null texts have no terms.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    asked = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.array_distinct(terms(F.col("text"))).alias("terms")).where("size(terms) > 0")
    blocks, out = max(1, -(-asked.count() // block)), None
    for i in range(blocks):
        some = [(r.query_id, r.terms) for r in asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i).orderBy("query_id").collect()]
        wanted = pa.array(sorted({t for _, own_terms in some for t in own_terms}), pa.string())
        found = _bm25_block(own, some, wanted, most, k1, b)
        out = found if out is None else out.unionByName(found)
    return ranked(out, most) if out is not None else spark.createDataFrame([], "query_id bigint, id bigint, score double, rank int")


def _bm25_block(own: DataFrame, some: list, wanted: pa.Array, most: int, k1: float, b: float) -> DataFrame:
    place = {t: i for i, t in enumerate(wanted.to_pylist())}
    ids = np.array([q for q, _ in some], dtype=np.int64)
    of = np.concatenate([[q] * len(t) for q, (_, t) in enumerate(some)]).astype(np.int64) if some else np.zeros(0, dtype=np.int64)
    term = np.array([place[x] for _, t in some for x in t], dtype=np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, df = 0, 0, np.zeros(len(wanted), dtype=np.int64)
        for batch in pieces(batches, "text", TEXT):
            length, _, t, _ = term_counts(batch.column("text"), wanted)
            n, total, df = n + len(length), total + int(length.sum()), df + np.bincount(t, minlength=len(df))
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *range(len(df))], pa.int32()), pa.array([n, total, *df.tolist()], pa.int64())], names=["what", "n"])

    stats = {r.what: r.n for r in own.mapInArrow(released(count), "what int, n bigint").groupBy("what").agg(F.sum("n").alias("n")).collect()}  # a row a term
    n, average = stats.get(-2, 0), stats.get(-1, 0) / max(1, stats.get(-2, 0))
    df = np.array([stats.get(i, 0) for i in range(len(wanted))], dtype=np.float64)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = np.zeros((len(wanted), len(ids)))
        has[term, of] = 1.0
        best = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        for whole in pieces(batches, "text", TEXT):
            for at in range(0, len(whole), DOCS):
                batch = whole.slice(at, DOCS)
                length, doc, t, tf = term_counts(batch.column("text"), wanted)
                if not len(doc):
                    continue
                weight = np.zeros((len(batch), len(wanted)))
                weight[doc, t] = idf[t] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length[doc] / max(average, 1e-9)))
                s = (weight @ has).T
                row, col = best_of(np.where(s > 0, np.round(s, 6), -np.inf), batch.column("id").to_numpy(zero_copy_only=False), most)
                best = tuple(np.concatenate(x) for x in zip(best, (row, batch.column("id").to_numpy(zero_copy_only=False)[col], np.round(s[row, col], 6)), strict=True))
                if len(best[0]) > 4 * most * len(ids):
                    best = kept_best(*best, len(ids), most)
        row, found, scores = kept_best(*best, len(ids), most)
        yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(found.astype(np.int64)), pa.array(scores)], names=["query_id", "id", "score"])

    return own.where("id is not null").mapInArrow(released(score), "query_id bigint, id bigint, score double")


def ranked(scores: DataFrame, most: int | None = None) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    out = scores.withColumn("rank", F.row_number().over(w))
    return out if most is None else out.where(F.col("rank") <= most)


def fused(a: DataFrame, b: DataFrame, k: int, constant: int = 60) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists: (query_id, id, score, rank)."""
    both = a.select("query_id", "id", "rank").unionByName(b.select("query_id", "id", "rank"))
    return ranked(both.groupBy("query_id", "id").agg(F.round(F.sum(1.0 / (F.lit(constant) + F.col("rank"))), 9).alias("score")), k)


def quantized(vectors: DataFrame, id_col: str, vector: str = "embedding") -> DataFrame:
    """(id, dim, q): each dimension mapped linearly from its least and greatest value to -128..127.

    Edges are aggregated by dimension (partially in each task) and come back as one row of two
    arrays, as long as a vector; rows are mapped where they are.
    """
    edges = vectors.select(F.posexplode(vector).alias("dim", "x")).groupBy("dim").agg(F.min(F.col("x").cast("double")).alias("lo"), F.max(F.col("x").cast("double")).alias("hi"))
    pair = edges.agg(F.array_sort(F.collect_list(F.struct("dim", "lo", "hi"))).alias("edges"))

    def step(x: Column, i: Column) -> Column:
        e, x = F.get("edges", i), x.cast("double")
        return (F.when(e["hi"] > e["lo"], F.floor((x - e["lo"]) / (e["hi"] - e["lo"]) * 255 + 0.5)).otherwise(0) - 128).cast("int")

    return vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).crossJoin(F.broadcast(pair)).select("id", F.posexplode(F.transform("v", step)).alias("dim", "q"))  # one row


def facets(chunks: DataFrame, *fields: str) -> DataFrame:
    """(field, value, n) of each field, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    return chunks.select(pairs.alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("n")).select("field", "value", "n")


def context_blocks(hits: DataFrame) -> DataFrame:
    """(query_id, context): [i] (type, page, file) and the text of each hit, by rank, a blank line between."""
    block = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] ("), "type", F.lit(", page "), F.col("page").cast("string"), F.lit(", "), base_name(F.col("source_file")), F.lit(")\n"), F.coalesce("text_for_embedding", F.lit("")))
    return hits.groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", block.alias("b")))), lambda x: x["b"]), "\n\n").alias("context"))


def recent_turns(turns: DataFrame, key: str, order: str, last: int = 4, chars: int = 300) -> DataFrame:
    """(key, history): the last turns of each conversation, role: text, cut to chars."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    kept = turns.withColumn("k", F.row_number().over(w)).where(F.col("k") <= last)
    line = F.concat(F.coalesce("role", F.lit("")), F.lit(": "), F.left(F.coalesce("text", F.lit("")), F.lit(chars)))
    return kept.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("k"), line.alias("l")))), lambda x: x["l"]), "\n").alias("history"))
