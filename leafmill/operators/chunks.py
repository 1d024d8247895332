"""All chunks of layout results in one plan: table rows, paragraphs and figures, ready for the index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill import schemas
from leafmill.config import DEFAULT, Config
from leafmill.operators import figures, layout, paragraphs, tables

COLUMNS = [c.split()[0] for c in schemas.CHUNK.split(", ") if not c.startswith("embedding ")]


def paragraph_rows(raw: DataFrame, labels: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(doc_id, ord, role, content, page, offset, polygon); paragraphs near a table's start point at it. labels: (doc_id, table_index, label)."""
    own = layout.paragraphs(raw).withColumn("offset", F.coalesce(F.get("spans", F.lit(0))["offset"], F.lit(0))).drop("spans", "regions")
    starts = layout.tables(raw).select("doc_id", "table_index", F.posexplode("spans").alias("nth", "s")).select("doc_id", "table_index", "nth", F.col("s.offset").alias("offset"))
    return paragraphs.with_table_pointers(own, starts.join(labels, ["doc_id", "table_index"]), config)


def document_chunks(raw: DataFrame, files: DataFrame, markdown: DataFrame, records: DataFrame, config: Config = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(chunks, table report). raw: layout results; files: (doc_id, source_file); markdown: (doc_id, page, markdown) of the second reader; records: the vision model's (doc_id, page, figure_index, understanding, outcome, record_crop)."""
    t, p = layout.tables(raw), layout.paragraphs(raw)
    c = layout.cells(t)
    sure = layout.table_confidence(layout.cell_confidence(c, layout.words(raw)), layout.pages(raw), config)
    rows, report = tables.table_path(t, c, p, sure, markdown, F.lit(None).cast("string"), config)
    labels = tables.described_tables(t, c, p, config).select("doc_id", "table_index", "label")
    texts = paragraphs.paragraph_chunks(paragraph_rows(raw, labels, config).withColumn("source_file", F.lit(None).cast("string")), config)
    candidates = figures.qualified_layout(raw, config).withColumn("crop", F.lit(None).cast("string"))
    plain = layout.figures(raw).withColumns({"source_file": F.lit(None).cast("string"), "layout_image": F.lit(None).cast("string")})
    pictures = figures.figure_chunks(plain, candidates, records)
    every = rows.select(*COLUMNS).unionByName(texts.select(*COLUMNS)).unionByName(pictures.select(*COLUMNS))
    named = every.drop("source_file").join(files.select(F.col("doc_id").alias("document_id"), "source_file"), "document_id", "left")
    return named.select(*COLUMNS), report


def step_counts(chunks: DataFrame) -> DataFrame:
    """(document_id, paragraphs, table_rows, figures, total)."""
    kind = lambda k: F.count_if(F.col("type") == k)
    return chunks.groupBy("document_id").agg(kind("paragraph").alias("paragraphs"), kind("table_row").alias("table_rows"), kind("figure").alias("figures"), F.count("*").alias("total"))
