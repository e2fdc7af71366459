"""Reading times from text, without Spark: calendar checks, zones, notations. Used inside Arrow-batched Python stages."""

from __future__ import annotations

import re
from datetime import date, datetime, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

_EPOCH = date(1970, 1, 1).toordinal()
_DAY_US = 86_400_000_000

#: Accepted ISO text of the ingestion rules (pattern is a fixed value).
ISO = re.compile(r"^([0-9]{4})-([0-9]{2})-([0-9]{2})T([0-9]{2}):([0-9]{2}):([0-9]{2})(\.[0-9]{1,9})?(Z|[+-][0-9]{2}:?[0-9]{2})?$")
DATE = re.compile(r"^([0-9]{4})-([0-9]{2})-([0-9]{2})$")

_MONTHS = {m: i for i, ms in enumerate((("jan", "january"), ("feb", "february"), ("mar", "march"), ("apr", "april"), ("may",), ("jun", "june"), ("jul", "july"), ("aug", "august"), ("sep", "sept", "september"), ("oct", "october"), ("nov", "november"), ("dec", "december")), 1) for m in ms}


def days(year: int, month: int, day: int) -> int | None:
    """Days since 1970-01-01, or None where there is no such date."""
    try:
        return date(year, month, day).toordinal() - _EPOCH
    except ValueError:
        return None


def offset_minutes(text: str) -> int | None:
    """Minutes of ``Z``, ``UTC``, ``GMT``, ``+hh``, ``+hhmm`` or ``+hh:mm``; None beyond 18 hours."""
    if text.upper() in ("Z", "UTC", "GMT"):
        return 0
    digits = text[1:].replace(":", "")
    hours, minutes = int(digits[:2]), int(digits[2:] or 0)
    if minutes > 59 or hours * 60 + minutes > 18 * 60:
        return None
    return (-1 if text[0] == "-" else 1) * (hours * 60 + minutes)


def iso_micros(text: str) -> int | None:
    """Microseconds since the epoch of an accepted ISO text (blanks around don't count, no zone means UTC), else None."""
    m = ISO.fullmatch(text.strip())
    if m is None:
        return None
    d = days(int(m[1]), int(m[2]), int(m[3]))
    h, mi, s = int(m[4]), int(m[5]), int(m[6])
    if d is None or h > 23 or mi > 59 or s > 59:
        return None
    off = offset_minutes(m[8]) if m[8] else 0
    if off is None:
        return None
    frac = int((m[7] or ".0")[1:7].ljust(6, "0"))
    return d * _DAY_US + ((h * 60 + mi - off) * 60 + s) * 1_000_000 + frac


@lru_cache(maxsize=4096)
def zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except Exception:  # unknown names, odd characters, directories
        return None


@lru_cache(maxsize=1 << 18)
def _local_minute_us(minutes: int, name: str) -> int | None:
    z = zone(name)
    if z is None:
        return None
    day, rest = divmod(minutes, 1440)
    try:
        d = date.fromordinal(day + _EPOCH)
        at = datetime(d.year, d.month, d.day, rest // 60, rest % 60, tzinfo=z)  # fold=0: the earlier instant; a skipped time keeps the offset before the gap
        return int((at.astimezone(timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds()) * 1_000_000
    except (ValueError, OverflowError):
        return None


def local_micros(micros: int, name: str | None) -> int | None:
    """UTC microseconds of a clock time (as if UTC) in a zone; None or blank zone is UTC. Twice: earlier; skipped: moved on by the gap."""
    if not name or not name.strip():
        return micros
    minutes, rest = divmod(micros, 60_000_000)
    base = _local_minute_us(minutes, name.strip())
    return None if base is None else base + rest


CANONICAL = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}Z")
_COUNT = re.compile(r"([0-9]{10})(\.[0-9]+)?|[0-9]{13}|[0-9]{16}|[0-9]{19}")
_CLOCK = r"(?P<h>[0-9]{1,2}):(?P<mi>[0-9]{2})(?::(?P<s>[0-9]{2})(?:[.,](?P<f>[0-9]+))?)?(?:\s?(?P<ap>[AaPp]\.?[Mm]\.?))?"
_TAIL = r"(?:\s*(?P<z>[Zz]|UTC|GMT|[+-][0-9]{2}(?::?[0-9]{2})?)?(?:\s*\[(?P<zb>[A-Za-z0-9_+\-/]+)\])?|\s+(?P<zn>[A-Za-z_]+/[A-Za-z0-9_+\-/]+))"
_SEP = r"(?:[Tt]|,?\s+)"
_NOTATIONS = tuple(
    (name, re.compile(pattern, re.ASCII))
    for name, pattern in (
        ("ymd", r"(?P<y>[0-9]{4})(?P<q>[-/.])(?P<mo>[0-9]{1,2})(?P=q)(?P<d>[0-9]{1,2})" + _SEP + _CLOCK + _TAIL),
        ("numeric", r"(?P<a>[0-9]{1,2})(?P<q>[-/.])(?P<b>[0-9]{1,2})(?P=q)(?P<y>[0-9]{4})" + _SEP + _CLOCK + _TAIL),
        ("day_month_name", r"(?:[A-Za-z]{3,9},?\s+)?(?P<d>[0-9]{1,2})[-\s](?P<mn>[A-Za-z]{3,9})\.?[-\s,]\s*(?P<y>[0-9]{4})" + _SEP + _CLOCK + _TAIL),
        ("month_name_day", r"(?:[A-Za-z]{3,9},\s+)?(?P<mn>[A-Za-z]{3,9})\.?\s+(?P<d>[0-9]{1,2}),?\s+(?P<y>[0-9]{4})" + _SEP + _CLOCK + _TAIL),
        ("compact", r"(?P<y>[0-9]{4})(?P<mo>[0-9]{2})(?P<d>[0-9]{2})[Tt]?(?P<h>[0-9]{2})(?P<mi>[0-9]{2})(?:(?P<s>[0-9]{2})(?:[.,](?P<f>[0-9]+))?)?(?P<ap>)" + _TAIL),
    )
)


def _clock_us(g: dict) -> int | None:
    h, mi, s = int(g["h"]), int(g["mi"]), int(g["s"] or 0)
    if g["ap"]:
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if g["ap"][0] in "pP" else 0)
    if h > 23 or mi > 59 or s > 59:
        return None
    return ((h * 60 + mi) * 60 + s) * 1_000_000 + int((g["f"] or "0")[:6].ljust(6, "0"))


def interpretations(text: str, zone_name: str | None) -> tuple[str, int | None, int | None]:
    """(notation, UTC microseconds read day first, read month first). Both are equal unless the notation is ``numeric``
    with ``/`` or ``-``; None where that reading names no real date and time. Notation ``none`` fits no pattern."""
    t = text.strip()
    m = _COUNT.fullmatch(t)
    if m:
        if m[1]:
            us = int(m[1]) * 1_000_000 + int((m[2] or ".0")[1:7].ljust(6, "0"))
        else:
            us = {13: lambda x: x * 1000, 16: lambda x: x, 19: lambda x: x // 1000}[len(t)](int(t))
        return "count", us, us
    for name, pattern in _NOTATIONS:
        m = pattern.fullmatch(t)
        if m is None:
            continue
        g = m.groupdict()
        clock = _clock_us(g)
        if name == "numeric":
            y, a, b = int(g["y"]), int(g["a"]), int(g["b"])
            dates = (days(y, b, a), None if g["q"] == "." else days(y, a, b))
            if g["q"] == ".":
                name, dates = "dotted", (dates[0], dates[0])
            else:
                name = "numeric" + g["q"]
        else:
            month = int(g["mo"]) if "mo" in g else _MONTHS.get(g["mn"].lower())
            d = days(int(g["y"]), month, int(g["d"])) if month else None
            dates = (d, d)
        out = []
        for d in dates:
            if d is None or clock is None:
                out.append(None)
                continue
            us = d * _DAY_US + clock
            if g["z"]:
                off = offset_minutes(g["z"])
                out.append(None if off is None else us - off * 60_000_000)
            else:
                out.append(local_micros(us, g["zb"] or g["zn"] or zone_name))
        return name, out[0], out[1]
    return "none", None, None
