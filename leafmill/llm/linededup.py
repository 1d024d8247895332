"""Line dedup by a deletion-neighbourhood join.

Lines are what newlines separate, compared without white space at their ends. Two lines are
copies when they are equal, or when both have near_chars characters and one edit (a character
put in, left out or replaced) turns one into the other. near_chars is a parameter, NEAR_CHARS
unless told: in shorter lines, such as numbered headings, one character is too much of the line. A line goes when an earlier line of
the corpus, by (doc_id, line number), is its copy; the earliest stays. Copies of copies don't
count: each line is held against all earlier lines, those that go included.

Distinct lines are found by a hash of 96 bits. For the edit bound of one, a lossless filter
comes first: one edit leaves the first or the second half of a line as it was, so each line
emits hashed prefixes and suffixes of half its length (with the lengths that a line one
longer or shorter would have), and only lines that share one go on. These emit all their
variants, the line itself and every deletion of one character, as hashed keys; equal variants
join; the edit distance of each joined pair is verified on its characters.

The lines that go on are read from the documents again. A table of the PRESENT_BITS low bits of
their hashes, of 2**PRESENT_BITS rows at most whatever the corpus, is sent to all tasks and spares
most other lines the shuffle in which the hashes themselves are joined.

Cases: blank lines stay and are nobody's copy. A null text stays null and an empty one empty.
A row whose non-blank lines all go is dropped, as it holds nothing of its own. Rows without a
doc_id come last in the order. Of rows equal in doc_id and text, whatever their other columns
hold, one stays (that of least hash over all columns), as the others' lines are all repeated. Rows
of one doc_id with different texts, and those without a doc_id, are ordered by text hash. A row is
known by its doc_id and 64 bits of its text, without a doc_id by 128 bits. Other columns stay as
they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import cut, one_of_each, row_hash
from leafmill.llm.tokens import INVERSE, Powers, mix

NEAR_CHARS, PRESENT_BITS = 16, 20

MARK = "__leafmill_"


def deletion_variants(line: str, powers: Powers) -> np.ndarray:
    """Hashes of the line and of the line less each one of its characters, in linear time from prefix sums."""
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(points)
    up, _ = powers.to(n + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mix(points) * up[:n], out=prefix[1:])
        less = prefix[:-1] + (prefix[n] - prefix[1:]) * np.uint64(INVERSE)
        sizes = np.uint64(0xD6E8FEB86659FD93)
        return mix(np.concatenate([less + np.uint64(max(n - 1, 0)) * sizes, prefix[n:] + np.uint64(n) * sizes]))


def half_keys(line: Column) -> Column:
    """Hashes of the halves that one edit elsewhere would leave alone, for its own length and those one off."""
    size = F.length(line)
    return F.array_distinct(
        F.array(
            *[F.xxhash64(F.lit(0), F.substring(line, F.lit(1), F.floor((size + d) / 2).cast("int"))) for d in (-1, 0, 1)],
            *[F.xxhash64(F.lit(1), F.right(line, F.ceil((size + d) / 2).cast("int"))) for d in (-1, 0, 1)],
        )
    )


def place_of() -> list[Column]:
    """no_id, id and row: rows of one doc_id are told apart by 64 bits, those without one by 128."""
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("bigint"), row_hash(1, "text")).alias("id"), row_hash(0, "text").alias("row")]


def lines_of(docs: DataFrame) -> DataFrame:
    """(no_id, id, row, line_no, line) of the non-blank lines."""
    own = docs.select(*place_of(), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return own.withColumn("line", F.trim("line", F.lit(" \t\r\x0b\x0c"))).where("line <> ''")


def near_pairs(lines: DataFrame, firsts: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(h1, h2, place): the earlier copies by one edit that distinct lines have. firsts: (h1, h2, size, place, n, halves)."""
    spark = lines.sparkSession
    long = firsts.where(F.col("size") >= near_chars)
    keyed = long.select("h1", "h2", F.explode("halves").alias("key"))
    shared = keyed.groupBy("key").agg(F.min(F.struct("h1", "h2")).alias("a"), F.max(F.struct("h1", "h2")).alias("b")).where("a <> b").select("key")
    alive = cut(keyed.join(shared, "key", "left_semi").select("h1", "h2").distinct())
    texts = lines.where(F.length("line") >= near_chars).select("line", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))
    # the lines come back from the documents
    bits = lambda c: F.pmod(F.col(c), F.lit(1 << PRESENT_BITS)).cast("int").alias("bits")
    present = F.broadcast(alive.select(bits("h1")).distinct())  # 2**PRESENT_BITS rows at most
    texts = texts.withColumn("bits", bits("h1")).join(present, "bits", "left_semi").drop("bits")
    texts = texts.dropDuplicates(["h1", "h2"]).join(alive, ["h1", "h2"], "left_semi")

    def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for line, h1, h2 in zip(batch.column("line").to_pylist(), batch.column("h1").to_pylist(), batch.column("h2").to_pylist()):
                keys = np.unique(deletion_variants(line, powers)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), h1)), pa.array(np.full(len(keys), h2, dtype=np.int32))], names=["variant", "h1", "h2"])

    texts = cut(texts.join(firsts.select("h1", "h2", "place"), ["h1", "h2"]))
    if texts.isEmpty():
        return spark.createDataFrame([], f"h1 bigint, h2 int, place {firsts.schema['place'].dataType.simpleString()}")
    emitted = texts.select("line", "h1", "h2").mapInArrow(variants, "variant bigint, h1 bigint, h2 int")
    left = emitted.select("variant", F.struct("h1", "h2").alias("x"))
    right = emitted.select("variant", F.struct("h1", "h2").alias("y"))
    joined = left.join(right, "variant").where("x < y").select("x", "y").distinct()
    both = joined.join(texts.select(F.struct("h1", "h2").alias("x"), F.col("line").alias("a"), F.col("place").alias("pa")), "x").join(
        texts.select(F.struct("h1", "h2").alias("y"), F.col("line").alias("b"), F.col("place").alias("pb")), "y"
    )
    verified = both.where(F.levenshtein("a", "b", 1) >= 0)
    late = F.when(F.col("pa") < F.col("pb"), F.col("y")).otherwise(F.col("x"))
    return verified.select(late.alias("x"), F.least("pa", "pb").alias("place")).groupBy("x").agg(F.min("place").alias("place")).select("x.h1", "x.h2", "place")


def removals(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(no_id, id, row, gone): numbers of the lines that go from each row that loses some."""
    lines = lines_of(docs)
    place = F.struct("no_id", "id", "row", "line_no")
    hashed = lines.select(F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"), place.alias("place"), F.length("line").alias("size"), F.when(F.length("line") >= near_chars, half_keys(F.col("line"))).alias("halves"))
    firsts = cut(hashed.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("halves").alias("halves")))
    near = near_pairs(lines, firsts, near_chars).select("h1", "h2", F.lit(True).alias("near"))
    judged = firsts.select("h1", "h2", "n", F.col("place").alias("first")).join(near, ["h1", "h2"], "left").where("n > 1 or near")
    hit = hashed.select("h1", "h2", "place").join(judged, ["h1", "h2"]).where("near or place <> first")
    return hit.groupBy("place.no_id", "place.id", "place.row").agg(F.array_distinct(F.collect_list("place.line_no")).alias("gone"))


def deduplicated(docs: DataFrame, near_chars: int = NEAR_CHARS) -> DataFrame:
    """docs with the lines that go cut from their texts, and rows of which no line is left dropped."""
    gone, keys = MARK + "gone", [MARK + "no_id", MARK + "id", MARK + "row"]
    found = removals(docs, near_chars).toDF(*keys, gone)
    marked = docs.select("*", *[c.alias(k) for c, k in zip(place_of(), keys)])
    joined = marked.join(found, keys, "left")
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(F.col(gone), i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn("text", text).where(F.col(gone).isNull() | F.col("text").rlike("\\S"))
    repeated = cut(marked.where(F.col("text").rlike("\\S")).groupBy(*keys).count().where("count > 1").select(*keys))
    if not repeated.isEmpty():  # equal rows have equal places in the order: one of each stays
        out = out.join(repeated, keys, "left_anti").unionByName(one_of_each(out.join(repeated, keys, "left_semi"), keys))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = f"""
WITH l AS (
  SELECT doc_id, i, line AS raw, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL)),
f AS (SELECT line, min((doc_id, i)) AS place, length(line) AS n FROM l WHERE line <> '' GROUP BY line),
near AS (
  SELECT DISTINCT b.line FROM f a JOIN f b ON a.n BETWEEN b.n - 1 AND b.n + 1 AND a.place < b.place
    AND a.n >= {NEAR_CHARS} AND b.n >= {NEAR_CHARS}
  WHERE levenshtein(a.line, b.line) <= 1),
g AS (
  SELECT l.doc_id, l.i, l.raw, (l.line <> '' AND ((l.doc_id, l.i) <> f.place OR near.line IS NOT NULL)) AS gone
  FROM l LEFT JOIN f ON l.line = f.line LEFT JOIN near ON l.line = near.line)
SELECT doc_id, coalesce(text, '') AS text FROM (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY i) FILTER (NOT coalesce(gone, false)) AS text, bool_or(coalesce(gone, false)) AS lost
  FROM g GROUP BY doc_id) WHERE NOT lost OR regexp_matches(coalesce(text, ''), '\\S')
"""

