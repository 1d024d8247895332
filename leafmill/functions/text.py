"""Text scalars. White space is the Unicode set that scripting languages split on."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "[\\s\\x0b\\x1c-\\x1f\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
#: The same set for RE2.
SPACE_SQL = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def token_count(text: Column) -> Column:
    """Words between white space; 0 for null and blank."""
    return F.coalesce(F.size(F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")), F.lit(0))


def checkbox_text(content: Column) -> Column:
    raw = strip(F.coalesce(content, F.lit("")))
    plain = F.regexp_replace(strip(F.regexp_replace(raw, ":(?:un)?selected:", "")), f"{SPACE}+", " ")
    return F.when(raw == ":selected:", "checked").when(raw == ":unselected:", "unchecked").otherwise(plain)


def last_sentences(text: Column, n: int, least: int = 30) -> Column:
    """The last n sentences joined by a space; '' for texts under least characters."""
    own = strip(F.coalesce(text, F.lit("")))
    parts = F.split(own, f"(?<=[.!?]){SPACE}+")
    last = F.slice(parts, F.greatest(F.size(parts) - (n - 1), F.lit(1)), F.lit(n))
    return F.when(F.length(own) < least, "").otherwise(strip(F.array_join(last, " ")))


def joined(separator: str, *parts: Column) -> Column:
    """The parts that are neither null nor ''."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), separator)


def row_text(cells: Column, headers: Column, label: Column, lead_in: Column) -> Column:
    """[Context: ...] | [Table: ...] | header: value | ...; header or value alone where the other is blank."""

    def cell(value: Column, i: Column) -> Column:
        header, own = F.coalesce(F.get(headers, i), F.lit("")), F.coalesce(value, F.lit(""))
        return F.when((header != "") & (own != ""), F.concat(header, F.lit(": "), own)).otherwise(F.concat(header, own))

    context = F.when(lead_in != "", F.concat(F.lit("[Context: "), lead_in, F.lit("]"))).otherwise("")
    table = F.when(label != "", F.concat(F.lit("[Table: "), label, F.lit("]"))).otherwise("")
    return F.array_join(F.filter(F.concat(F.array(context, table), F.transform(cells, cell)), lambda x: x != ""), " | ")


def hashed(size: int, *parts: Column | str) -> Column:
    return F.substring(F.sha2(F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]), 256), 1, size)


def document_id(content: Column) -> Column:
    return F.substring(F.sha2(content, 256), 1, 16)


def name_key(name: Column) -> Column:
    return hashed(32, name)


def table_chunk_id(doc: Column, table: Column, row: Column) -> Column:
    return hashed(32, doc, "-table-", table, "-row-", row)


def paragraph_chunk_id(doc: Column, page: Column, offset: Column) -> Column:
    return hashed(32, doc, "-para-", page, "-", offset)


def figure_chunk_id(doc: Column, figure: Column, page: Column) -> Column:
    return hashed(32, doc, "-fig-", figure, "-p", page)


def position_group(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.concat_ws(":", *[formatted(v, "0.00") for v in (x, y, w, h)])


def formatted(x: Column, pattern: str) -> Column:
    """x by a decimal pattern such as 0.00, rounded half to even on its binary value."""
    return F.call_function("format_number", x, F.lit(pattern))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.concat(F.bround(part * 100 / whole).cast("int").cast("string"), F.lit("%"))).otherwise("0%")


def match_band(score: Column, strong: float = 0.86, weak: float = 0.82) -> Column:
    return F.when(score >= strong, "strong").when(score >= weak, "weak").otherwise("none")


def short_name(name: Column) -> Column:
    return F.when(F.length(name) > 40, F.concat(F.left(name, F.lit(22)), F.lit("…"), F.right(name, F.lit(17)))).otherwise(name)


def base_name(name: Column) -> Column:
    return F.substring_index(name, "/", -1)


def blob_name(url: Column) -> Column:
    """What follows the first /documents/, or all of it."""
    return F.regexp_replace(url, "(?s)^.*?/documents/", "")


def is_pdf(name: Column) -> Column:
    return F.lower(name).endswith(".pdf")


def first_of(*parts: Column) -> Column:
    """The first part that is neither null nor ''."""
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in parts])


LISTS = (("visible_labels", "Visible Labels"), ("device_or_component_terms", "Device Or Component Terms"), ("procedure_actions", "Procedure Actions"), ("warnings_or_constraints", "Warnings Or Constraints"), ("search_keywords", "Search Keywords"))


def figure_text(caption: Column, page: Column, u: Column) -> Column:
    """The text of a figure chunk; u: what the vision model said of it, or null."""
    own, number = strip(F.coalesce(caption, F.lit(""))), F.concat(F.lit("(Page "), page.cast("string"), F.lit(")"))
    base = F.concat(F.lit("[Figure] "), own, F.lit(" "), number)

    def listed(field: str, title: str) -> Column:
        values = F.filter(F.transform(F.coalesce(u[field], F.array().cast("array<string>")), lambda v: strip(F.coalesce(v, F.lit("")))), lambda v: v != "")
        return F.when(F.size(values) > 0, F.concat(F.lit(title + ": "), F.array_join(values, ", "))).otherwise("")

    category = F.when((F.coalesce(u["category"], F.lit("")) != "") & (u["category"] != "unknown"), F.concat(F.lit("Category: "), u["category"])).otherwise("")
    full = joined(" ", F.lit("[Figure]"), own, strip(F.coalesce(u["short_description"], F.lit(""))), *[listed(*x) for x in LISTS], category, number)
    return F.when(u.isNull(), base).otherwise(full)


def vision_context(page: Column, caption: Column, signals: Column, area: Column, aspect: Column) -> Column:
    shown = F.coalesce(F.nullif(caption, F.lit("")), F.lit("(none detected)"))
    signal = F.when(F.size(signals) > 0, F.concat(F.lit("Routing signals: "), F.array_join(signals, ", "))).otherwise("")
    taken = F.when(area.isNotNull(), F.concat(F.lit("Occupies "), formatted(area * 100, "0.0"), F.lit("% of the page (aspect ratio "), formatted(aspect, "0.0"), F.lit(")"))).otherwise("")
    return joined("\n", F.concat(F.lit("Page: "), page.cast("string")), F.concat(F.lit("Layout caption: "), shown), signal, taken)


def rename_images(markdown: Column, page: Column, ids: Column) -> Column:
    """Image ids of a second reading replaced, in order, by p{page}-img-{i}.jpeg."""
    numbered = F.transform(ids, lambda x, i: F.struct(x.alias("id"), i.alias("i")))
    return F.aggregate(numbered, markdown, lambda acc, x: F.replace(acc, x["id"], F.concat(F.lit("p"), page.cast("string"), F.lit("-img-"), x["i"].cast("string"), F.lit(".jpeg"))))


def snake(name: str) -> str:
    """camelCase to snake_case, each capital apart."""
    return "".join(("_" if i and c.isascii() and c.isupper() else "") + c for i, c in enumerate(name)).lower()


def all_of(conditions: Iterable[tuple[Column, Column | str]]) -> Column:
    """The values whose conditions hold, in order."""
    return F.filter(F.array(*[F.when(c, v if isinstance(v, Column) else F.lit(v)) for c, v in conditions]), lambda x: x.isNotNull())
