"""ISO-8601 text and timestamps as column expressions; all stay inside the JVM and give the same in every session time zone:
times without zone mean UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted ISO text (fixed pattern).
ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:?\d{2})?$"
#: Names of these endings hold identifiers, never times.
ID_LIKE = "(id|key)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_micros(us: Column) -> Column:
    """Microseconds since the epoch as a time without zone, in UTC."""
    return F.timestamp_add("MICROSECOND", us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def micros(c: Column | str, dtype: str = "timestamp_ntz") -> Column:
    """Microseconds since the epoch of a timestamp, or of a time without zone in UTC; None of other types."""
    c = _col(c)
    if dtype == "timestamp":
        return F.unix_micros(c)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz"))


def utc(c: Column | str) -> Column:
    """A timestamp as a time without zone, in UTC."""
    return from_micros(F.unix_micros(_col(c)))


def now() -> Column:
    """The time of the query as a time without zone, in UTC."""
    return utc(F.current_timestamp())


def _instant(c: Column) -> Column:
    t = F.trim(c)
    # 24:00:00 is no time of day here; Spark's cast rejects it too
    zoned = F.regexp_replace(F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2"), r"(T[^Z+-]*)$", "$1Z")
    return F.when(t.rlike(ISO), zoned.try_cast("timestamp"))


def is_timestamp(c: Column | str) -> Column:
    """True for accepted ISO text that names a real time; false for anything else, null included."""
    return F.coalesce(_instant(_col(c)).isNotNull(), F.lit(False))


def epoch_millis(c: Column | str) -> Column:
    """Milliseconds since the epoch of accepted ISO text, finer digits cut off; no zone means UTC; null for other text."""
    return F.unix_millis(_instant(_col(c)))


def epoch_micros(c: Column | str) -> Column:
    """The same in microseconds."""
    return F.unix_micros(_instant(_col(c)))


def require_epoch_millis(c: Column | str) -> Column:
    """As :func:`epoch_millis`, but text that isn't accepted raises."""
    c = _col(c)
    return F.when(c.isNull(), None).otherwise(F.coalesce(epoch_millis(c), F.raise_error(F.concat(F.lit("not a timestamp: "), c)).cast("long")))


def to_timestamp(c: Column | str, dtype: str) -> Column:
    """A cell of a timestamp column from its raw value: milliseconds, ISO text, dates and timestamps; null otherwise."""
    c = _col(c)
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return from_micros(c.cast("long") * 1000)
    if dtype == "string":
        return from_micros(epoch_millis(c) * 1000)
    if dtype == "timestamp":
        return utc(c)
    if dtype in ("date", "timestamp_ntz"):
        return c.cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def is_id_like(c: Column | str) -> Column:
    """Whether a name ends like an identifier's, in any letter case; null and blank names don't."""
    return F.coalesce(F.lower(_col(c)).rlike(ID_LIKE), F.lit(False))
