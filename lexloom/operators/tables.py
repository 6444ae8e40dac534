"""Labelled values from HTML tables: one pass over the tags of a page, for all labels at once."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F

_TAG = re.compile(r"<(/?)(table|tr|td|th)\b[^>]*>", re.IGNORECASE)


class _Table:
    """A table that is being read: the cells of its row, and where the open cell, and the part of it that is no inner table, began."""

    def __init__(self) -> None:
        self.row, self.cells, self.begun, self.own_from, self.own = -1, [], -1, -1, ""


def first_cells(html: str) -> list[tuple[str, str]]:
    """The first two cells of each row that has two, in the order in which rows begin: of the first what is no inner table, of the second all.

    A cell ends with the next of its table, or with its row or table; rows likewise; what is open at the end ends there.
    """
    out: list[tuple[int, str, str]] = []
    tables = [_Table()]

    def close_cell(t: _Table, at: int) -> None:
        if t.begun >= 0:
            t.cells.append(html[t.begun : at] if t.cells else t.own + html[t.own_from : at])
            t.begun = -1

    def close_row(t: _Table, at: int) -> None:
        close_cell(t, at)
        if len(t.cells) > 1:
            out.append((t.row, *t.cells[:2]))
        t.cells, t.row = [], -1

    for tag in _TAG.finditer(html):
        end, name, t = bool(tag[1]), tag[2].lower(), tables[-1]
        if name == "table":
            if not end:
                t.own += html[t.own_from : tag.start()] if t.begun >= 0 else ""
                tables.append(_Table())
            else:
                close_row(t, tag.start())
                if len(tables) > 1:
                    tables.pop()
                    tables[-1].own_from = tag.end()
        elif name == "tr":
            close_row(t, tag.start())
            if not end:
                t.row = tag.start()
        else:
            close_cell(t, tag.start())
            if not end:
                t.row = tag.start() if t.row < 0 else t.row
                if len(t.cells) < 2:
                    t.begun = t.own_from = tag.end()
                    t.own = ""
    while tables:
        close_row(tables.pop(), len(html))
    return [(a, b) for _, a, b in sorted(out, key=lambda r: r[0])]


def table_values(html: Column, labels: dict[str, str]) -> Column:
    """A struct with a text for each name: the second cell of the first row whose first cell holds the label, in any case, else an empty one."""
    wanted = {name: label.lower() for name, label in labels.items()}

    @F.pandas_udf(", ".join(f"`{n}` string" for n in wanted))
    def values(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            cells = [(a.lower(), b) for a, b in first_cells(page or "")]
            rows.append([next((b.strip() for a, b in cells if label in a), "") for label in wanted.values()])
        return pd.DataFrame(rows, columns=list(wanted), dtype=str)

    return values(html)
