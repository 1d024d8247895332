"""Figures: geometry features, qualification, the vision model's outcome, chunks and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill import schemas
from leafmill.config import DEFAULT, Config
from leafmill.functions.geometry import bbox, near, overlap_ratio
from leafmill.functions.text import all_of, figure_chunk_id, figure_text, first_of, position_group, strip
from leafmill.operators import layout

PAGE = ["doc_id", "page"]


def furniture_overlap(figures: DataFrame, furniture: DataFrame) -> DataFrame:
    """figures with the greatest share of their box that one furniture region of the page covers, 0 without any."""
    other = furniture.select(F.col("doc_id").alias("o_doc"), F.col("page").alias("o_page"), F.col("box").alias("o_box"))
    met = figures.join(other, (F.col("doc_id") == F.col("o_doc")) & (F.col("page") == F.col("o_page")), "left")
    best = met.groupBy("doc_id", "page", "figure_index").agg(F.max(overlap_ratio(F.col("box"), F.col("o_box"))).alias("header_overlap_ratio"))
    return figures.join(best, [*PAGE, "figure_index"], "left").withColumn("header_overlap_ratio", F.coalesce("header_overlap_ratio", F.lit(0.0)))


def with_references(figures: DataFrame, texts: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """figures with has_reference: a caption, or a reference term in a paragraph of the page near the figure."""
    hit = F.lit(False)
    for t in config.reference_terms:
        hit = hit | F.contains(F.lower("content"), F.lit(t))
    told = texts.where(hit).select(F.col("doc_id").alias("t_doc"), F.col("page").alias("t_page"), F.col("box").alias("t_box"))
    met = figures.join(told, (F.col("doc_id") == F.col("t_doc")) & (F.col("page") == F.col("t_page")) & near(F.col("box"), F.col("t_box"), config.reference_proximity_in), "left_semi")
    found = met.select(*PAGE, "figure_index").distinct().withColumn("near_term", F.lit(True))
    caption = strip(F.coalesce("caption", F.lit(""))) != ""
    return figures.join(found, [*PAGE, "figure_index"], "left").withColumn("has_reference", caption | F.coalesce("near_term", F.lit(False))).drop("near_term")


def with_features(figures: DataFrame) -> DataFrame:
    """Ratios to the page; figures without a box or a page size are left out."""
    w, h = F.greatest(F.col("box.x1") - F.col("box.x0"), F.lit(1e-9)), F.greatest(F.col("box.y1") - F.col("box.y0"), F.lit(1e-9))
    own = figures.where("box is not null and page_width > 0 and page_height > 0")
    return own.select(
        "*", (w / F.col("page_width")).alias("width_ratio"), (h / F.col("page_height")).alias("height_ratio"), (w * h / (F.col("page_width") * F.col("page_height"))).alias("area_ratio"), (F.greatest(w, h) / F.least(w, h)).alias("aspect_ratio"), F.lit(0.0).alias("footer_overlap_ratio"),
        position_group(F.col("box.x0") / F.col("page_width"), F.col("box.y0") / F.col("page_height"), w / F.col("page_width"), h / F.col("page_height")).alias("normalized_position_group"),
    )


def qualified(figures: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Adds status, rejection_reason and routing_signals; a figure that the text refers to is never rejected."""
    ref, overlap = F.col("has_reference"), F.greatest("header_overlap_ratio", "footer_overlap_ratio")
    captioned = F.coalesce("caption", F.lit("")) != ""
    furniture, small = overlap >= config.furniture_overlap, F.col("area_ratio") < config.min_area
    reason = F.when(furniture & ~ref, "structural_noise").when(small & ~ref, "low_value_graphic").when((F.col("aspect_ratio") > config.max_aspect) & ~captioned & ~ref, "decorative_geometry")
    signals = all_of([(~captioned, "caption_missing"), (small, "small_figure_with_reference"), (F.col("area_ratio") > config.max_area, "full_page_graphic"), (furniture, "furniture_overlap_with_reference")])
    done = figures.withColumn("rejection_reason", reason)
    return done.withColumn("status", F.when(F.col("rejection_reason").isNull(), "candidate").otherwise("rejected")).withColumn("routing_signals", F.when(F.col("rejection_reason").isNull(), signals).otherwise(F.array().cast("array<string>")))


def qualified_layout(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """The figures of a layout result with features, status, reason and signals; those without a usable box or page size aren't among them."""
    boxes = layout.bounding_boxes(raw)
    own = layout.page_sizes(layout.figures(raw).withColumn("box", bbox(F.col("polygon"))), layout.pages(raw))
    return qualified(with_features(with_references(furniture_overlap(own, layout.furniture(boxes, config)), layout.page_paragraphs(boxes), config)), config)


def outcome_counts(records: DataFrame, keys: list[str], field: str) -> DataFrame:
    """(keys..., counts): how many records of each value of field, as a map."""
    each = records.where(F.col(field).isNotNull()).groupBy(*keys, field).agg(F.count("*").alias("n"))
    return each.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(field, "n")))).alias("counts"))


def first_per_document(candidates: DataFrame, most: int, order: list[str]) -> DataFrame:
    """The first figures of each document, as many as the vision budget allows."""
    w = Window.partitionBy("doc_id").orderBy(*order)
    return candidates.withColumn("nth__", F.row_number().over(w)).where(F.col("nth__") <= most).drop("nth__")


def parsed_understanding(reply: Column) -> Column:
    """The model's reply as a struct; null unless it is JSON with all fields and known category and confidence."""
    u = F.from_json(reply, schemas.UNDERSTANDING)
    whole = u["category"].isin(*schemas.CATEGORIES) & u["model_confidence_label"].isin(*schemas.CONFIDENCES)
    for field in "is_meaningful contains_text short_description visible_labels device_or_component_terms procedure_actions warnings_or_constraints search_keywords uncertainty needs_larger_context_crop".split():
        whole = whole & u[field].isNotNull()
    exact = F.size(F.json_object_keys(reply)) == 12
    return F.when(whole & exact, u)


def vision_outcome(understanding: Column) -> Column:
    meaningful = F.coalesce(understanding["is_meaningful"], F.lit(False))
    return (
        F.when(understanding.isNull(), "retain_unverified").when(meaningful, "retain").when(understanding["model_confidence_label"] == "high", "reject").otherwise("retain_low_confidence")
    )


def latest_records(records: DataFrame, order: str) -> DataFrame:
    """Of several records of a figure the last one by order."""
    key = ["doc_id", "page", "figure_index"]
    return records.groupBy(*key).agg(F.max_by(F.struct(*[c for c in records.columns if c not in key]), order).alias("r")).select(*key, "r.*")


def figure_chunks(figures: DataFrame, candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Chunks of the figures that neither the rules nor the model rejected.

    candidates: (doc_id, page, figure_index, status, crop); records: (..., understanding,
    outcome, record_crop). A figure without either is kept.
    """
    key = ["doc_id", "page", "figure_index"]
    both = figures.join(candidates.select(*key, "status", "crop"), key, "left").join(records.select(*key, "understanding", "outcome", "record_crop"), key, "left")
    kept = both.where("not status <=> 'rejected' and not outcome <=> 'reject'")
    guess = F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("-layout-fig-0.jpeg"))
    return kept.select(
        figure_chunk_id(F.col("doc_id"), F.col("figure_index"), F.col("page")).alias("chunk_id"), F.lit("figure").alias("type"), F.lit("layout").alias("source"), "source_file",
        figure_text(F.col("caption"), F.col("page"), F.col("understanding")).alias("text_for_embedding"), first_of(F.col("record_crop"), F.col("crop"), F.col("layout_image"), guess).alias("image_blob"),
        F.col("doc_id").alias("document_id"), "page", F.col("polygon").alias("bounding_polygon"), F.lit(None).cast("int").alias("table_index"), F.lit(None).cast("int").alias("row_index"), "figure_index",
    )


def verdicts(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Each figure's stage: rejected by rule, not_analyzed, rejected_by_vision, or the outcome."""
    key = ["doc_id", "page", "figure_index"]
    stage = F.when(F.col("status") == "rejected", "rejected").when(F.col("outcome").isNull(), "not_analyzed").when(F.col("outcome") == "reject", "rejected_by_vision").otherwise(F.col("outcome"))
    return candidates.join(records.select(*key, "outcome"), key, "left").withColumn("stage", stage)


def verdict_counts(staged: DataFrame) -> DataFrame:
    """(stage, n, share): share in percent to one place."""
    counts = staged.groupBy("stage").agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).select("stage", "n", F.round(F.col("n") * 100 / F.col("total"), 1).alias("share"))  # one row
