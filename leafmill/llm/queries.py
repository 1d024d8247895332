"""The queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

import os

import corpus_pipeline
from leafmill.llm import contamination, fingerprints, increments, linededup, mixing, neardup, pii, suffixes, toxicity, urls
from leafmill.llm.common import table

#: Where the public tokenizers' vocabularies lie.
TOKENIZERS = os.environ.get("LEAFMILL_TOKENIZERS", "/opt/tokenizers")

QUERIES = {
    "op9_incremental_dedup": lambda spark, sf_dir: increments.incremental_spans(table(spark, sf_dir, "documents")),
    "op8_url_filter": lambda spark, sf_dir: urls.url_filter(table(spark, sf_dir, "pages"), f"{TOKENIZERS}/word_bpe_49k.json"),
    "op6_suffix_dedup": lambda spark, sf_dir: suffixes.repeated_spans(table(spark, sf_dir, "documents")),
    "op1_pii": lambda spark, sf_dir: pii.personal_data(table(spark, sf_dir, "documents")),
    "pipeline": corpus_pipeline.run,
    "op5_mixing": lambda spark, sf_dir: mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "source", "copy", "n_chars", "text"),
    "op3_toxicity": lambda spark, sf_dir: toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op2_line_dedup": lambda spark, sf_dir: linededup.deduplicated(table(spark, sf_dir, "documents")).select("doc_id", "text"),
    "op4_near_duplicates": lambda spark, sf_dir: neardup.near_duplicates(table(spark, sf_dir, "documents")),
    "op10_decontamination": lambda spark, sf_dir: contamination.contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op7_fingerprints": lambda spark, sf_dir: fingerprints.fingerprints(table(spark, sf_dir, "documents")),
}

ORACLES = {
    "op2_line_dedup": linededup.ORACLE_SQL,
    "op10_decontamination": contamination.ORACLE_SQL,
    "op7_fingerprints": fingerprints.ORACLE_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
