"""Evolution of a stored table's schema by that of a batch. Names are compared without case."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from millrace import types as mt


class IncompatibleType(ValueError):
    """A column of the batch can't be stored in the table's column of that name."""


@dataclass(frozen=True)
class Change:
    action: str  # add, widen
    column: str
    old: str | None
    new: str


def decide(stored: str, incoming: str) -> str:
    """keep, widen or reject. Integers and floats widen within their own kind only; JSON mixes with nothing."""
    if stored == incoming:
        return "keep"
    if "json" in (stored, incoming):
        return "reject"
    for ladder in (mt.INTEGERS, ("float32", "float64")):
        if stored in ladder and incoming in ladder:
            return "widen" if ladder.index(incoming) > ladder.index(stored) else "keep"
    return "reject"


def evolve(stored: T.StructType, incoming: T.StructType) -> tuple[T.StructType, list[Change]]:
    """The table's schema after the batch, and what changed. Stored columns the batch lacks stay untouched, new ones come
    last in the batch's order; the system column is the table's own and added where an older table lacks it."""
    fields = list(stored.fields)
    at = {f.name.lower(): i for i, f in enumerate(fields)}
    changes = []
    for f in mt.at_rest(incoming).fields:
        low = f.name.lower()
        if low == mt.SYSTEM_COLUMN:
            continue
        if low not in at:
            at[low] = len(fields)
            fields.append(f)
            changes.append(Change("add", f.name, None, mt.kind(f)))
            continue
        have = fields[at[low]]
        old, new = mt.kind(have), mt.kind(f)
        verdict = decide(old, new)
        if verdict == "reject":
            raise IncompatibleType(f"Incompatible type for column {have.name}: table has {mt.STORED[old]}, batch has {mt.STORED[new]}")
        if verdict == "widen":
            fields[at[low]] = mt.field(have.name, new)
            changes.append(Change("widen", have.name, old, new))
    if mt.SYSTEM_COLUMN not in at:
        fields.append(mt.field(mt.SYSTEM_COLUMN, "timestamp"))
        changes.append(Change("add", mt.SYSTEM_COLUMN, None, "timestamp"))
    return T.StructType(fields), changes
