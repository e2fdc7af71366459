"""Partition expressions: a column, or year, month, day of one."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_CALL = re.compile(r"\s*(year|month|day)\s*\(\s*(.+?)\s*\)\s*", re.IGNORECASE)
_FUNCTIONS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


@dataclass(frozen=True)
class Part:
    column: str
    transform: str | None = None

    @property
    def hidden(self) -> str:
        """Name of the directory column; never part of what a reader sees."""
        return f"__p_{self.transform}_{self.column}" if self.transform else f"__p_{self.column}"

    def expression(self) -> Column:
        c = F.col("`" + self.column.replace("`", "``") + "`")
        return _FUNCTIONS[self.transform](c) if self.transform else c


def split_list(text: str | None) -> list[str]:
    """A comma list; commas inside parentheses or backticks don't split. Blanks around are cut, blank items left out."""
    items, depth, quoted, item = [], 0, False, ""
    for ch in text or "":
        if ch == "`":
            quoted = not quoted
        elif not quoted:
            depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0 and not quoted:
            items.append(item)
            item = ""
        else:
            item += ch
    return [i.strip() for i in [*items, item] if i.strip()]


def parse(spec: str | list[str] | None) -> list[Part]:
    """Partition expressions in order, e.g. ``year(created_at), status``."""
    out = []
    for item in split_list(spec) if isinstance(spec, str) or spec is None else spec:
        m = _CALL.fullmatch(item)
        if m:
            out.append(Part(m[2].strip("`"), m[1].lower()))
        elif "(" in item:
            raise ValueError(f"unknown partition transform: {item}")
        else:
            out.append(Part(item.strip("`")))
    return out


def check(parts: list[Part], schema: StructType) -> None:
    names = {n.lower() for n in schema.fieldNames()}
    for p in parts:
        if p.column.lower() not in names:
            raise ValueError(f"partition column {p.column} isn't in the table")
