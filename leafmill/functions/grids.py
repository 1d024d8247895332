"""Grids of one table as plain lists, with the results of the DataFrame operators of operators/tables.py. White space is str.split()'s, the set of functions/text.py."""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHECKBOX = re.compile(":(?:un)?selected:")
SEPARATOR = re.compile(r"\|[\s|:-]+\|")


class Cell(NamedTuple):
    cell: int
    head: bool
    row: int | None
    col: int | None
    row_span: int | None
    column_span: int | None
    column_count: int | None
    content: str | None
    polygon: list[float] | None


def checkbox_text(content: str | None) -> str:
    raw = (content or "").strip()
    if ":" in raw:
        if raw in (":selected:", ":unselected:"):
            return "checked" if raw == ":selected:" else "unchecked"
        raw = CHECKBOX.sub("", raw)
    return " ".join(raw.split())


def headers(cells: list[Cell], columns: int) -> list[str]:
    """fused_headers() of one table."""
    at: list[list[str]] = [[] for _ in range(max(0, columns))]
    for row, col, text, span in sorted((c.row, c.col, t, c.column_span or 1) for c in cells if c.head and c.row is not None and c.col is not None and (t := " ".join((c.content or "").split()))):
        for i in range(max(0, col), min(col + max(span, 1), columns)):
            at[i].append(text)
    return [" / ".join(a) for a in at]


def first_row(cells: list[Cell]) -> list[str]:
    return [t for _, _, t in sorted(((c.col is not None, c.col or 0), c.cell, checkbox_text(c.content)) for c in cells if c.row == 0)]


def body_rows(body: list[Cell]) -> list[tuple[int | None, list[list[float]]]]:
    """(row, polygons) of the rows that have a cell, from top to bottom."""
    rows: dict = {}
    for c in sorted(body, key=lambda c: c.cell):
        rows.setdefault(c.row, []).append(c.polygon)
    return sorted(rows.items(), key=lambda x: (x[0] is not None, x[0]))


def grid(body: list[Cell], rows: int, columns: int) -> tuple[list[list[str]], list[list[bool]]]:
    """cell_grid() of one table: the texts and whether a span's later row is there."""
    texts, spanned = [[""] * columns for _ in range(rows)], [[False] * columns for _ in range(rows)]
    for c in sorted(body, key=lambda c: c.cell):
        if c.row is None or c.col is None or c.row >= rows or c.col >= columns:
            continue
        text, high = checkbox_text(c.content), c.row_span or 1
        for r in range(max(0, c.row), min(c.row + max(high, 1), rows)):
            for i in range(max(0, c.col), min(c.col + max(c.column_span or 1, 1), columns)):
                if text:
                    texts[r][i] = text
                if r > c.row:
                    spanned[r][i] = True
    return texts, spanned


def fill_label_runs(texts: list[list[str]]) -> list[list[str]]:
    out, lo = [list(r) for r in texts], 0
    for hi in range(1, len(texts) + 1):
        if hi < len(texts) and texts[hi][0] == texts[lo][0]:
            continue
        if hi - lo > 1 and texts[lo][0]:
            for i in range(1, len(texts[lo])):
                filled = [texts[r][i] for r in range(lo, hi) if texts[r][i]]
                if len(filled) == 1:
                    for r in range(lo, hi):
                        out[r][i] = filled[0]
        lo = hi
    return out


def pipe_lines(markdown: str) -> list[str]:
    out: list[str] = []
    for line in markdown.split("\n"):
        last = out[-1].strip() if out else ""
        if last.startswith("|") and not last.endswith("|") and not (t := line.strip()).startswith("|"):
            out[-1] = f"{out[-1].rstrip()} {t}"
        else:
            out.append(line)
    return out


def pipe_tables(markdown: str) -> list[tuple[list[list[str]], list[list[str]]]]:
    """(header rows, body rows) of each pipe table with a row."""
    found, heads, body, past = [], [], [], False
    for line in [x.strip() for x in pipe_lines(markdown)] + [""]:
        if len(line) > 1 and line[0] == "|" and line[-1] == "|":
            if SEPARATOR.fullmatch(line):
                past = True
            else:
                (body if past else heads).append([x.strip() for x in line.split("|")[1:-1]])
            continue
        if heads or body:
            found.append((heads, body))
        heads, body, past = [], [], False
    return found


def fill_right(cells: list[str], layout: list[str]) -> list[str]:
    out, left = [], ""
    for own, there in zip(cells, layout, strict=True):
        own, there = own.strip(), there.strip()
        left = left if own == "" and left and there and there != left and there in left else own
        out.append(left)
    return out


def second_rows(theirs: list[list[str]], rows: list[tuple[int | None, list]], texts: list[list[str]], spanned: list[list[bool]]) -> list[tuple[int, list[str], list]]:
    """(row, cells, polygons): the second reader's rows of one table, as second_reader_rows() fills them."""
    width = max(map(len, theirs), default=0)
    if not width:
        return []
    places, lines, spans, layouts = [], [], [], []
    for nth, cells in enumerate(theirs):
        row, polygons = rows[nth] if nth < len(rows) else (None, [])
        there = row is not None and 0 <= row < len(texts)
        layout, span = (texts[row], spanned[row]) if there else ([], [])
        layout, span = (layout + [""] * width)[:width], (span + [False] * width)[:width]
        places.append((nth if row is None else row, polygons))
        lines.append(fill_right((cells + [""] * width)[:width], layout))
        layouts.append(layout)
        spans.append(span)
    last = [""] * width
    for nth, line in enumerate(lines):
        for i in range(width):
            span = spans[nth][i] or (nth + 1 < len(lines) and spans[nth + 1][i])
            last[i] = line[i] = (layouts[nth][i].strip() if span else "") or line[i] or last[i]
    return [(row, line, polygons) for (row, polygons), line in zip(places, lines, strict=True)]


def plain_values(column: pa.Array) -> list:
    """The values as Python's; numbers and strings without a step for each."""
    if pa.types.is_list(column.type):
        if not len(column.flatten()):
            return [None if x else [] for x in column.is_null().to_pylist()]
        return column.to_pylist()
    if column.null_count == len(column):
        return [None] * len(column)
    if column.null_count and (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)):
        out = column.fill_null(0).to_numpy(zero_copy_only=False).tolist()
        for i in np.flatnonzero(column.is_null().to_numpy(zero_copy_only=False)).tolist():
            out[i] = None
        return out
    return column.to_numpy(zero_copy_only=False).tolist()
