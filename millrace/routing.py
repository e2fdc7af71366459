"""Topics to tables."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TABLE = re.compile(r"[A-Za-z_][A-Za-z0-9_-]*")


def parse(text: str | None) -> dict[str, str]:
    """``topic:table`` pairs, comma separated; blank text is an empty map. A pair of other than two parts, a table name that
    isn't one, and a topic or table that appears twice raise."""
    out: dict[str, str] = {}
    if not text or not text.strip():
        return out
    for pair in text.split(","):
        parts = [p.strip() for p in pair.split(":")]
        if len(parts) != 2 or not all(parts):
            raise ValueError(f"not topic:table: {pair.strip()!r}")
        topic, table = parts
        if not _TABLE.fullmatch(table):
            raise ValueError(f"not a table name: {table!r}")
        if topic in out:
            raise ValueError(f"topic {topic} appears twice")
        if table in out.values():
            raise ValueError(f"table {table} appears twice")
        out[topic] = table
    return out


def table_of(topic: str, routes: dict[str, str]) -> str:
    """The mapped table; a topic without one is its own."""
    return routes.get(topic, topic)


def route(topic: Column | str, routes: dict[str, str]) -> Column:
    c = F.col(topic) if isinstance(topic, str) else topic
    if not routes:
        return c
    pairs = [F.lit(x) for kv in routes.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), c)
