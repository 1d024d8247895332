"""Schemas of the layout result and of the derived records, as DDL."""

SPANS = "ARRAY<STRUCT<offset INT, length INT>>"
REGIONS = "ARRAY<STRUCT<page_number INT, polygon ARRAY<DOUBLE>>>"
CELL = f"STRUCT<kind STRING, row_index INT, column_index INT, row_span INT, column_span INT, content STRING, spans {SPANS}, bounding_regions {REGIONS}>"
PAGES = "ARRAY<STRUCT<page_number INT, width DOUBLE, height DOUBLE, unit STRING, angle DOUBLE, words ARRAY<STRUCT<content STRING, confidence DOUBLE, span STRUCT<offset INT, length INT>>>>>"
PARAGRAPHS = f"ARRAY<STRUCT<role STRING, content STRING, spans {SPANS}, bounding_regions {REGIONS}>>"
TABLES = f"ARRAY<STRUCT<row_count INT, column_count INT, caption STRUCT<content STRING>, spans {SPANS}, bounding_regions {REGIONS}, cells ARRAY<{CELL}>>>"
FIGURES = f"ARRAY<STRUCT<id STRING, caption STRUCT<content STRING>, bounding_regions {REGIONS}>>"
LAYOUT = f"doc_id STRING, content STRING, pages {PAGES}, paragraphs {PARAGRAPHS}, tables {TABLES}, figures {FIGURES}"

UNDERSTANDING = (
    "STRUCT<is_meaningful BOOLEAN, category STRING, model_confidence_label STRING, contains_text BOOLEAN, short_description STRING, visible_labels ARRAY<STRING>, device_or_component_terms ARRAY<STRING>, "
    "procedure_actions ARRAY<STRING>, warnings_or_constraints ARRAY<STRING>, search_keywords ARRAY<STRING>, uncertainty ARRAY<STRING>, needs_larger_context_crop BOOLEAN>"
)
CATEGORIES = (
    "anatomical_illustration background chart decorative device_component device_photo diagram header_footer logo procedure_illustration safety_symbol screenshot table_like unknown"
).split()
CONFIDENCES = ("high", "low", "medium")

CHUNK = (
    "chunk_id STRING, type STRING, source STRING, source_file STRING, text_for_embedding STRING, image_blob STRING, document_id STRING, page INT, bounding_polygon ARRAY<DOUBLE>, "
    "table_index INT, row_index INT, figure_index INT, embedding ARRAY<FLOAT>"
)
