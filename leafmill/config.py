"""Thresholds of the engine."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    table_confidence: float = 0.75
    ocr_enabled: bool = False
    ocr_figure_routing: bool = True
    furniture_overlap: float = 0.30
    min_area: float = 0.01
    max_area: float = 0.90
    max_aspect: float = 8.0
    crop_dpi: int = 200
    crop_padding_in: float = 0.06
    reference_proximity_in: float = 1.0
    figures_per_doc: int = 60
    chunk_tokens: int = 500
    overlap_tokens: int = 100
    lead_in_min_chars: int = 30
    fragmentation: float = 0.6
    artifact_confidence: float = 0.2
    pointer_chars: int = 200
    empty_ratio: float = 0.5
    strong_match: float = 0.86
    weak_match: float = 0.82
    noise_roles: tuple[str, ...] = ("pageNumber", "pageHeader", "pageFooter")
    reference_terms: tuple[str, ...] = tuple("figure|fig.|see |shown|illustrat|diagram|warning|caution|danger|note|legend|symbol".split("|"))


DEFAULT = Config()
