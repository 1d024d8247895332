"""Paragraph chunks: a sliding window of about chunk_tokens words with an overlap, per run of one page."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from leafmill.config import DEFAULT, Config
from leafmill.functions.geometry import union_polygon
from leafmill.functions.grids import plain_values
from leafmill.functions.text import paragraph_chunk_id
from leafmill.llm.common import pieces, released


def band_first(left: DataFrame, right: DataFrame, keys: list[str], at: str, reach: int, order: list[str], value: str) -> DataFrame:
    """left with the value of the right row, first by order, whose `at` is less than reach away on either side; null without any.

    Right rows go to the three buckets of width reach about them, so the join has equal keys and
    a hot key is spread over its buckets.
    """
    b = right.select(*[F.col(k).alias(f"r_{k}") for k in keys], F.col(at).alias("r_at"), F.struct(*[F.col(o) for o in order], F.col(value).alias("v__")).alias("r_o"), F.explode(F.array(*[F.floor(F.col(at) / reach) + d for d in (-1, 0, 1)])).alias("r_bucket"))
    row = left.withColumn("bucket__", F.floor(F.col(at) / reach))
    on = F.col("bucket__") == F.col("r_bucket")
    for k in keys:
        on = on & (F.col(k) == F.col(f"r_{k}"))
    return row.join(b, on & (F.abs(F.col("r_at") - F.col(at)) < reach), "left").groupBy(*left.columns).agg(F.min("r_o").alias("r_o")).select(*left.columns, F.col("r_o.v__").alias(value))


def with_table_pointers(paragraphs: DataFrame, labels: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Paragraphs within pointer_chars of a table's start, the first such table, get [Table: label]. labels: (doc_id, offset, table_index, nth, label)."""
    near = band_first(paragraphs.select("doc_id", "ord", "offset"), labels, ["doc_id"], "offset", config.pointer_chars, ["table_index", "nth"], "label")
    return paragraphs.join(near.select("doc_id", "ord", "label"), ["doc_id", "ord"], "left").withColumn("content", F.when(F.col("label").isNotNull(), F.concat("content", F.lit(" [Table: "), "label", F.lit("]"))).otherwise(F.col("content"))).drop("label")


def window_ranges(tokens: Column, limit: int, overlap: int) -> Column:
    """Places of the chunks over an array of token counts: (lo, hi, polygons from), in order.

    A window takes items until it has limit tokens, is emitted, and goes on with its longest
    suffix of at most overlap tokens; what is left at the end is emitted too. Items have at
    least one token, so suffixes are found on the running totals.
    """
    kind = "struct<lo:int,plo:int,total:int,out:array<struct<lo:int,hi:int,plo:int>>>"
    start = F.struct(F.lit(0).alias("lo"), F.lit(0).alias("plo"), F.lit(0).alias("total"), F.array().cast("array<struct<lo:int,hi:int,plo:int>>").alias("out")).cast(kind)
    items = F.transform(tokens, lambda t, i: F.struct(t.cast("int").alias("t"), i.cast("int").alias("i")))

    def suffix(acc: Column, i: Column) -> Column:
        """The number of items that the overlap keeps, and their tokens."""
        back = F.reverse(F.slice(tokens, acc["lo"] + 1, i - acc["lo"] + 1))
        init = F.struct(F.lit(0).alias("n"), F.lit(0).alias("t"), F.lit(False).alias("stop"))
        return F.aggregate(
            back,
            init,
            lambda s, t: F.when(s["stop"] | (s["t"] + t > overlap), F.struct(s["n"].alias("n"), s["t"].alias("t"), F.lit(True).alias("stop"))).otherwise(F.struct((s["n"] + 1).alias("n"), (s["t"] + t).cast("int").alias("t"), F.lit(False).alias("stop"))),
        )

    def step(acc: Column, x: Column) -> Column:
        total = acc["total"] + x["t"]
        kept = suffix(acc, x["i"])
        emitted = F.struct(
            (x["i"] + 1 - kept["n"]).alias("lo"), x["i"].alias("plo"), kept["t"].alias("total"), F.concat(acc["out"], F.array(F.struct(acc["lo"].alias("lo"), x["i"].alias("hi"), acc["plo"].alias("plo")))).alias("out")
        )
        going = F.struct(acc["lo"].alias("lo"), acc["plo"].alias("plo"), total.alias("total"), acc["out"].alias("out"))
        return F.when(total >= limit, emitted.cast(kind)).otherwise(going.cast(kind))

    def finish(acc: Column) -> Column:
        rest = F.array(F.struct(acc["lo"].alias("lo"), (F.size(tokens) - 1).alias("hi"), acc["plo"].alias("plo")))
        return F.when(acc["lo"] < F.size(tokens), F.concat(acc["out"], rest.cast("array<struct<lo:int,hi:int,plo:int>>"))).otherwise(acc["out"])

    return F.aggregate(items, start, step, finish)


def windows(tokens: list[int], limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """window_ranges() of one list."""
    out, lo, polygons, total = [], 0, 0, 0
    for i, t in enumerate(tokens):
        total += t
        if total >= limit:
            out.append((lo, i, polygons))
            n = total = 0
            while n <= i - lo and total + tokens[i - n] <= overlap:
                total += tokens[i - n]
                n += 1
            lo, polygons = i + 1 - n, i
    return out + ([(lo, len(tokens) - 1, polygons)] if lo < len(tokens) else [])


class _Chunks:
    """Rows of chunks by column, from one document's paragraphs at a time."""

    def __init__(self, schema: pa.Schema, config: Config):
        self.schema, self.limit, self.overlap = schema, config.chunk_tokens, config.overlap_tokens
        self.columns: list[list] = [[] for _ in schema]

    def add(self, doc: object, rows: list[tuple]) -> None:
        """rows: (doc_id, source_file, page, offset, content, polygon) in order."""
        runs, island, before = {}, 0, None
        for _, file, page, offset, content, polygon in rows:
            words = content.split()
            if words:
                island += before is not None and page is not None and page != before[0]
                before = (page,) if page is not None else None
                runs.setdefault((file, page, island), []).append((offset, content.strip(), polygon, len(words)))
        for (file, page, _), items in runs.items():
            for lo, hi, polygons in windows([x[3] for x in items], self.limit, self.overlap):
                part = items[lo : hi + 1]
                values = (doc, file, page, part[0][0], " ".join(x[1] for x in part), [x[2] for x in items[polygons : hi + 1] if x[2]], len(part), sum(x[3] for x in part))
                for column, v in zip(self.columns, values, strict=True):
                    column.append(v)

    def taken(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)], schema=self.schema)
        self.columns = [[] for _ in self.schema]
        return batch


def paragraph_chunks(paragraphs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(doc_id, source_file, ord, role, content, page, offset, polygon) to chunks, with the number of paragraphs and tokens.

    One shuffle by document and one sort; then a document at a time is cut into runs of a page
    and each run folded. Roles of page furniture and blank paragraphs are left out before the
    runs are made.
    """
    own = paragraphs.where(~F.coalesce("role", F.lit("")).isin(*config.noise_roles)).where("content is not null")
    own = own.select("doc_id", "source_file", "page", F.coalesce("offset", F.lit(0)).cast("bigint").alias("offset"), "content", "polygon", "ord")
    kind = {f.name: f.dataType.simpleString() for f in own.schema}
    out = f"doc_id {kind['doc_id']}, source_file string, page {kind['page']}, offset bigint, text string, polygons array<array<double>>, n_paragraphs int, tokens int"
    schema = to_arrow_schema(StructType.fromDDL(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, doc, held = _Chunks(schema, config), None, []
        for batch in batches:
            for of, rows in groupby(zip(*[plain_values(batch.column(i)) for i in range(6)], strict=True), key=itemgetter(0)):
                if held and of != doc:
                    chunks.add(doc, held)
                    held = []
                doc = of
                held.extend(rows)
            yield chunks.taken()
        if held:
            chunks.add(doc, held)
        yield chunks.taken()

    made = own.repartition("doc_id").sortWithinPartitions("doc_id", "ord", "offset", "content").mapInArrow(released(run), out)
    return made.select(
        paragraph_chunk_id(F.col("doc_id"), F.col("page"), F.col("offset")).alias("chunk_id"), F.lit("paragraph").alias("type"), F.lit("layout").alias("source"), "source_file",
        F.col("text").alias("text_for_embedding"), F.lit(None).cast("string").alias("image_blob"), F.col("doc_id").alias("document_id"), "page",
        union_polygon(F.col("polygons")).alias("bounding_polygon"), F.lit(None).cast("int").alias("table_index"), F.lit(None).cast("int").alias("row_index"), F.lit(None).cast("int").alias("figure_index"),
        "n_paragraphs", "tokens",
    )


def text_paragraphs(docs: DataFrame, per_page: int = 20) -> DataFrame:
    """Plain texts as paragraphs: lines with their offsets; per_page lines make a page. Texts are cut where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            lines = pc.split_pattern(batch.column("text"), "\n")
            n = lines.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            first, flat = np.cumsum(n) - n, lines.flatten()
            doc = np.repeat(np.arange(len(n)), n)
            size = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            start = np.cumsum(size) - size
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), pa.array((np.arange(len(doc)) - first[doc]).astype(np.int32)), flat.cast(pa.string()), pa.array((start - start[first][doc]).astype(np.int32))], names=["doc_id", "ord", "content", "offset"])

    own = docs.where("text is not null").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = own.mapInArrow(released(run), "doc_id string, ord int, content string, offset int")
    return lines.select("doc_id", F.concat("doc_id", F.lit(".txt")).alias("source_file"), "ord", F.lit("").alias("role"), "content", (F.floor(F.col("ord") / per_page) + 1).cast("int").alias("page"), "offset", F.array().cast("array<double>").alias("polygon"))
