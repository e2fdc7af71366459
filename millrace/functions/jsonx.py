"""Nested values as JSON text, and short descriptions of values for error messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSS", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSS"}
LONGEST = 512


def to_json(c: Column | str) -> Column:
    """A struct, array or map as JSON text; null fields are kept, a null value stays null."""
    return F.to_json(c, _OPTIONS)


def describe(value: object) -> str:
    """A value on one line of at most 512 characters; byte strings by their length."""
    if isinstance(value, (bytes, bytearray)):
        return f"byte[{len(value)}]"
    text = str(value).replace("\r\n", " ").replace("\n", " ").replace("\r", " ")
    return text if len(text) <= LONGEST else text[: LONGEST - 3] + "..."


def describe_column(c: Column | str) -> Column:
    """The same for a column of text."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.regexp_replace(c, r"\r\n|\r|\n", " ")
    return F.when(F.length(text) <= LONGEST, text).otherwise(F.concat(F.substring(text, 1, LONGEST - 3), F.lit("...")))
