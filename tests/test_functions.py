"""Column functions on literal rows."""

import pytest
from pyspark.sql import functions as F

from leafmill import schemas
from leafmill.functions import geometry as g
from leafmill.functions import text as t


@pytest.fixture(scope="module")
def value(spark):
    return lambda column: spark.range(1).select(column.alias("v")).first()["v"]


def numbers(*v):
    return F.array(*[F.lit(float(x)) for x in v])


def strings(*v):
    return F.array(*map(F.lit, v)).cast("array<string>")


@pytest.mark.parametrize(("text", "n"), [("one two", 2), ("", 0), (" \n\t ", 0), (None, 0), ("a b c\x1fd", 4)])
def test_tokens(value, text, n):
    assert value(t.token_count(F.lit(text).cast("string"))) == n


@pytest.mark.parametrize(("text", "want"), [(":selected:", "checked"), (" :unselected: ", "unchecked"), ("a :selected:  b", "a b"), (None, "")])
def test_checkbox(value, text, want):
    assert value(t.checkbox_text(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("text", "n", "want"), [("Too short.", 2, ""), ("First sentence here. Second one here! Third?", 2, "Second one here! Third?"), ("A single sentence without a stop at all", 2, "A single sentence without a stop at all")])
def test_last_sentences(value, text, n, want):
    assert value(t.last_sentences(F.lit(text), n)) == want


def test_union_polygon(value):
    assert value(g.union_polygon(F.array(numbers(0, 1, 2, 1, 2, 3, 0, 3), numbers(5, 0, 6, 0)))) == [0, 0, 6, 0, 6, 3, 0, 3]
    assert value(g.union_polygon(F.array().cast("array<array<double>>"))) == []


@pytest.mark.parametrize(("a", "b", "hit"), [((0, 0, 2, 2), (1, 1, 3, 3), True), ((0, 0, 2, 2), (2, 0, 3, 2), False), ((0, 0, 5, 5), (1, 1, 2, 2), True), ((0, 0), (0, 0, 1, 1), False)])
def test_overlaps(value, a, b, hit):
    assert value(g.overlaps(g.bbox(numbers(*a)), g.bbox(numbers(*b)))) is hit


def test_overlap_ratio_and_crop(value):
    box = g.bbox(numbers(0, 0, 2, 2))
    assert value(g.overlap_ratio(box, g.bbox(numbers(1, 0, 3, 2)))) == pytest.approx(0.5)
    crop = value(g.crop_rect(g.bbox(numbers(1, 1, 9, 2)), F.lit(8.5), F.lit(11.0), 0.06))
    assert (crop["x0"], crop["x1"]) == pytest.approx((0.94 * 72, 8.5 * 72))
    assert value(g.crop_rect(g.bbox(numbers(9, 1, 9.5, 2)), F.lit(8.5), F.lit(11.0), 0.06)) is None


def test_row_text(value):
    text = t.row_text(strings("5", "", "x"), strings("Size", "Note"), F.lit("Parts"), F.lit("See below."))
    assert value(text) == "[Context: See below.] | [Table: Parts] | Size: 5 | Note | x"
    assert value(t.row_text(strings("", ""), strings("", ""), F.lit(""), F.lit(""))) == ""


def test_rounding_like_scripts(value):
    assert value(t.position_group(F.lit(0.125), F.lit(1.005), F.lit(0.5), F.lit(0.0))) == "0.12:1.00:0.50:0.00"
    assert [value(t.percent(F.lit(a), F.lit(b))) for a, b in ((1, 8), (3, 8), (0, 0))] == ["12%", "38%", "0%"]


def test_names(value):
    assert value(t.blob_name(F.lit("https://h/documents/a/documents/b.PDF"))) == "a/documents/b.PDF"
    assert value(t.is_pdf(F.lit("B.PDF"))) and value(t.blob_name(F.lit("b.pdf"))) == "b.pdf"
    assert value(t.short_name(F.lit("a" * 30 + "b" * 30))) == "a" * 22 + "…" + "b" * 17
    assert t.snake("boundingRegions") == t.snake("bounding_regions") == "bounding_regions" and t.snake("HTMLParser") == "h_t_m_l_parser"
    assert value(t.first_of(F.lit(""), F.lit(None), F.lit("x"))) == "x"
    assert [value(t.match_band(F.lit(x))) for x in (0.86, 0.82, 0.8)] == ["strong", "weak", "none"]


def test_figure_text(value):
    none = F.lit(None).cast(schemas.UNDERSTANDING)
    assert value(t.figure_text(F.lit(" Pump "), F.lit(3), none)) == "[Figure] Pump (Page 3)"
    said = F.from_json(F.lit('{"short_description": "A pump.", "visible_labels": ["A", " "], "search_keywords": ["k", "l"], "category": "unknown"}'), schemas.UNDERSTANDING)
    assert value(t.figure_text(F.lit(None).cast("string"), F.lit(3), said)) == "[Figure] A pump. Visible Labels: A Search Keywords: k, l (Page 3)"


def test_rename_images_and_context(value):
    assert value(t.rename_images(F.lit("![a](a.jpg) b.jpg"), F.lit(2), strings("a.jpg", "b.jpg"))) == "![a](p2-img-0.jpeg) p2-img-1.jpeg"
    assert value(t.vision_context(F.lit(1), F.lit(""), strings("caption_missing"), F.lit(0.1234), F.lit(2.0))) == "Page: 1\nLayout caption: (none detected)\nRouting signals: caption_missing\nOccupies 12.3% of the page (aspect ratio 2.0)"
