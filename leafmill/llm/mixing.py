"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target share of the characters; the mix is to hold as many characters as
the corpus has (times scale). A document of source s is due share_s * total / size_s copies,
a whole number and a fraction. The whole number is given; fractions are rounded dependently:
two documents' fractions a and b meet, and mass moves at random from one to the other until
one is 0 or 1, in expectation leaving both as they were; the other goes on as the residual.
So each document gets its due copies or one more or less of a fraction, and each source's
number of documents comes out at its exact expectation, rounded up or down.

Leaves of about LEAF documents of a source, by a hash of the row, are rounded first, each in one
task; every leaf leaves one residual. FAN residuals at a time meet at the next level until one
is left for each source, which a last draw rounds. All draws come from hashes of the rows met
and the seed, so a task that runs again decides alike. Only narrow rows (hash, source) move
in this; the copies then join the documents once. Rows that are equal in every column are told
apart by a number, which also spreads them over the leaves; they are counted and written out
RUN at a time, so that many of them are no single task's work.

Targets: weights per source, missing sources having 0 and a null source being a source of its
own named by None; by default every source has the same weight. Weights are taken relative to
their sum over sources that have characters.

Cases: a null or empty text has no characters but is a document of its source like any other:
it gets the copies that its source's texts are due; a source without any characters keeps one
copy of each. Equal rows are documents of their own, and rows that differ in any column get copies
of their own (columns of a type that can't be compared, such as maps, aside; of rows alike but for
those one stands for all). Copies of equal rows are numbered together. A null doc_id is no matter. An empty
table gives an empty one. Other columns stay as they are; the copy's number is a new column
copy (a column of that name in the input is replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import cut, hashable, row_key

LEAF, FAN, RUN, SEED, SLIP = 8192, 64, 4096, 20240701, 1e-9

MARK = "__leafmill_"


def uniform(*keys: int) -> float:
    """A number in [0, 1) that the keys settle."""
    x = 0x9E3779B97F4A7C15
    for k in keys:
        x = ((x ^ (k & 0xFFFFFFFFFFFFFFFF)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 31)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 29
    return (x >> 11) / (1 << 53)


def pivotal(fractions: list[float], keys: list[int], seed: int) -> tuple[list[int], int | None, float]:
    """Rounds fractions in order. Returns 0 or 1 for each (-1: undecided), and the place and fraction of the residual, if any."""
    out, at, mass = [-1] * len(fractions), None, 0.0
    for i, f in enumerate(fractions):
        if f <= SLIP or f >= 1 - SLIP:
            out[i] = int(f > 0.5)
        elif at is None:
            at, mass = i, f
        else:
            both, u = mass + f, uniform(keys[at], keys[i], seed)
            if both < 1:  # one of them becomes 0
                if u * both < f:
                    out[at], at = 0, i
                else:
                    out[i] = 0
                mass = both
            else:  # one of them becomes 1
                if u * (2 - both) < 1 - f:
                    out[at], at = 1, i
                else:
                    out[i] = 1
                mass = both - 1
            if mass <= SLIP or mass >= 1 - SLIP:
                out[at], at = int(mass > 0.5), None
    return out, at, mass


def sizes_of(docs: DataFrame) -> DataFrame:
    return docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("documents"), F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("bigint").alias("characters"))


def due_copies(docs: DataFrame, weights: dict | None = None, scale: float = 1.0) -> DataFrame:
    """(source, due): the copies that each document of a source is due."""
    spark = docs.sparkSession
    sizes = cut(sizes_of(docs))  # one row a source
    if weights is None:
        weighed = sizes.withColumn("weight", F.when(F.col("characters") > 0, 1.0).otherwise(0.0))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        given = spark.createDataFrame([(k, float(w)) for k, w in weights.items()], "name string, given double")
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("name")), "left").withColumn("weight", F.when(F.col("characters") > 0, F.coalesce("given", F.lit(0.0))).otherwise(0.0)).drop("name", "given")
    totals = weighed.agg(F.sum("characters").alias("total"), F.sum("weight").alias("weights"))
    due = F.when(F.col("characters") == 0, 1.0).when(F.col("weights") > 0, F.col("weight") / F.col("weights") * F.col("total") * F.lit(scale) / F.col("characters")).otherwise(0.0)
    return weighed.crossJoin(totals).select("source", due.alias("due"), "documents")


def level(rows: DataFrame, seed: int, last: bool = False) -> DataFrame:
    """Rounds each group's fractions; the residual keeps its fraction with decided -1, but the last one of a source is drawn."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("row", "ascending"), ("nth", "ascending")])
        keys = [int.from_bytes(r[:8], "big") ^ n * 0x9E3779B97F4A7C15 & (1 << 64) - 1 for r, n in zip(group["row"].to_pylist(), group["nth"].to_pylist())]
        decided, at, mass = pivotal(group["fraction"].to_pylist(), keys, seed)
        if last and at is not None:
            decided[at] = int(uniform(keys[at], seed, 0) < mass)
        decided = np.array(decided, dtype=np.int8)
        fraction = np.where(decided < 0, mass, 0.0)
        field = group.schema.get_field_index
        return group.set_column(field("fraction"), "fraction", pa.array(fraction)).append_column("decided", pa.array(decided.astype(np.int32)))

    return rows.groupBy("source", "node").applyInArrow(run, "source string, node bigint, row binary, nth bigint, fraction double, decided int")


def copy_counts(docs: DataFrame, weights: dict | None = None, scale: float = 1.0, seed: int = SEED, leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """(row, many, copies): for each row hash, how many equal rows there are and the copies they get in all."""
    due = cut(due_copies(docs, weights, scale))
    largest = due.agg(F.max("documents")).first()[0] or 0
    rows = docs.select(F.col("source").cast("string").alias("source"), row_key(*hashable(docs)).alias("row"))
    per = rows.groupBy("source", "row").agg(F.count("*").alias("many")).join(due, rows["source"].eqNullSafe(due["source"])).drop(due["source"])
    runs = per.select("source", "row", "due", "documents", "many", F.explode(F.sequence(F.lit(1).cast("bigint"), "many", F.lit(RUN).cast("bigint"))).alias("from"))
    each = runs.select("source", "row", (F.col("due") - F.floor("due")).alias("fraction"), "documents", F.explode(F.sequence("from", F.least(F.col("from") + RUN - 1, F.col("many")))).alias("nth"))
    # leaves by the row's hash, as many as each source's size asks for
    node = F.pmod(F.xxhash64("row", "nth", F.lit(seed)), F.greatest(F.lit(1), F.ceil(F.col("documents") / leaf)).cast("bigint"))
    nodes, step = -(-largest // leaf), 1
    now = cut(level(each.select("source", node.alias("node"), "row", "nth", "fraction"), seed, nodes <= 1))
    decisions = now.where("decided >= 0")
    while nodes > 1:
        residual = now.where("decided < 0").select("source", F.floor(F.col("node") / fan).cast("bigint").alias("node"), "row", "nth", "fraction")
        nodes = -(-nodes // fan)
        now = cut(level(residual, seed + step, nodes <= 1))
        decisions, step = decisions.unionByName(now.where("decided >= 0")), step + 1
    got = decisions.groupBy("source", "row").agg(F.count("*").alias("many"), F.sum("decided").alias("up"))
    whole = due.select(F.col("source").alias("s"), F.floor("due").cast("bigint").alias("whole"))
    return got.join(whole, F.col("source").eqNullSafe(F.col("s"))).select("row", "many", (F.col("many") * F.col("whole") + F.col("up")).alias("copies"))


def mixed(docs: DataFrame, weights: dict | None = None, scale: float = 1.0, seed: int = SEED, leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """docs with each row as often as it was given copies, numbered from 1 in copy."""
    row, many, copies = MARK + "row", MARK + "many", MARK + "copies"
    counts = copy_counts(docs, weights, scale, seed, leaf, fan).where("copies > 0").toDF(row, many, copies)
    joined = docs.withColumn(row, row_key(*hashable(docs))).join(counts, row)
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "copy"]
    first = F.explode(F.sequence(F.lit(1).cast("bigint"), copies, F.lit(RUN).cast("bigint")))
    # equal rows are alike, so that one of them stands for all
    several = joined.where(F.col(many) > 1).dropDuplicates([row]).withColumn(MARK + "from", first)
    each = joined.where(F.col(many) == 1).withColumn(MARK + "from", first).unionByName(several)
    return each.select(*columns, F.explode(F.sequence(F.col(MARK + "from"), F.least(F.col(MARK + "from") + RUN - 1, F.col(copies))).cast("array<int>")).alias("copy"))
