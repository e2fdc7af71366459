"""Identifiers in SQL text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def quote(name: str, mark: str = "`") -> str:
    """A name as SQL identifier: bare if it is plain, else between marks with inner marks doubled."""
    if name is None:
        raise ValueError("an identifier can't be null")
    return name if _PLAIN.fullmatch(name) else f"{mark}{name.replace(mark, mark * 2)}{mark}"


def quote_column(c: Column | str, mark: str = "`") -> Column:
    """The same for a column of names; null for null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(f"^{_PLAIN.pattern}$"), c).otherwise(F.concat(F.lit(mark), F.replace(c, F.lit(mark), F.lit(mark * 2)), F.lit(mark)))


def column(name: str) -> str:
    """A column name for Spark expressions, always between backticks, so that dots and odd characters stay inside."""
    if name is None:
        raise ValueError("an identifier can't be null")
    return f"`{name.replace('`', '``')}`"
