"""Upsert of a batch into a table, on DataFrames; MERGE semantics without a catalog that has MERGE.

Keys match by SQL equality on all key columns: rows with a null key never match and are inserted every time. Matched rows
take all non-key columns of the batch, its nulls too, and keep what the batch lacks; ``_inserted_at`` is set when a row is
inserted and stays. Columns go by name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import idents
from millrace.functions import timestamps as ts
from millrace.types import SYSTEM_COLUMN


class DuplicateKeys(ValueError):
    """A strict batch has several rows of one key."""


def _c(name: str) -> Column:
    return F.col(idents.column(name))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def last_wins(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order`` (nulls first; of equal ones any). Rows with a null in the key are all kept. Rows are
    combined before the shuffle, so that a hot key is no burden to one task."""
    whole = _all([_c(k).isNotNull() for k in keys])
    row = F.struct(*[_c(c).alias(f"c{i}") for i, c in enumerate(batch.columns)])
    best = batch.where(whole).groupBy(*map(_c, keys)).agg(F.max_by(row, F.struct(*map(_c, order))).alias("__row"))
    fields = batch.schema.fields
    return best.select(*[F.col("__row").getField(f"c{i}").alias(f.name, metadata=f.metadata or {}) for i, f in enumerate(fields)]).unionByName(batch.where(~whole))


def require_unique(batch: DataFrame, keys: list[str]) -> None:
    whole = _all([_c(k).isNotNull() for k in keys])
    twice = batch.where(whole).groupBy(*map(_c, keys)).count().where("count > 1").limit(1).collect()
    if twice:
        raise DuplicateKeys(f"several rows of the batch have the key {twice[0].asDict()}")


def unknown(base: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key isn't in the base; those with a null in the key always."""
    known = base.select(*[_c(k).alias(f"__k_{i}") for i, k in enumerate(keys)])
    return batch.join(known, _all([_c(k) == F.col(f"__k_{i}") for i, k in enumerate(keys)]), "left_anti")


def _prepared(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch columns under names that can't clash with the table's."""
    drop = [c for c in batch.columns if c.lower() == SYSTEM_COLUMN]
    batch = batch.drop(*drop)
    return batch.select(*[_c(c).alias(f"__n_{c}") for c in batch.columns], F.lit(True).alias("__hit"))


def merge(base: DataFrame, batch: DataFrame, keys: list[str], now: Column | None = None, small: bool = False, matched: DataFrame | None = None) -> DataFrame:
    """The table after the upsert, with the base's columns, then new ones of the batch.

    ``small``: the batch's size was checked, so it is broadcast and the base isn't shuffled (a left join for the updates,
    an anti join for the inserts); otherwise one full outer join, co-partitioned on the keys. ``matched``: the batch's keys that
    are in the base, where they were looked up already (columns __k0, __k1 and so on). With only key columns in the
    batch nothing is updated and this is an insert of unknown keys."""
    if not keys:
        raise ValueError("an upsert needs key columns")
    lower = {c.lower(): c for c in base.columns}
    missing = [k for k in keys if k.lower() not in lower or k.lower() not in {c.lower() for c in batch.columns}]
    if missing:
        raise ValueError(f"key columns {missing} must be in the table and in the batch")
    of_batch = {c.lower(): f"__n_{c}" for c in batch.columns if c.lower() != SYSTEM_COLUMN}
    n = _prepared(batch, keys)
    on = _all([_c(lower[k.lower()]) == _c(of_batch[k.lower()]) for k in keys])
    now = ts.now() if now is None else now
    key_names = {k.lower() for k in keys}
    names = [*base.columns, *[c for c in batch.columns if c.lower() not in lower and c.lower() != SYSTEM_COLUMN]]

    def shaped(hit: Column, mine: bool) -> list[Column]:
        out = []
        for name in names:
            low = name.lower()
            old = _c(name) if mine and low in lower else F.lit(None)
            if low == SYSTEM_COLUMN:
                out.append(F.when(F.col("__old"), old).otherwise(now).alias(name) if mine else now.alias(name))
            elif low in key_names:
                out.append((F.coalesce(old, _c(of_batch[low])) if mine else _c(of_batch[low])).alias(name))
            elif low in of_batch:
                out.append(F.when(hit, _c(of_batch[low])).otherwise(old).alias(name) if mine else _c(of_batch[low]).alias(name))
            else:
                kind = dict(base.dtypes)[name]
                out.append(old.alias(name) if mine else F.lit(None).cast(kind).alias(name))
        return out

    hit = F.coalesce(F.col("__hit"), F.lit(False))
    marked = base.withColumn("__old", F.lit(True))
    if not small:
        return marked.join(n, on, "full_outer").withColumn("__old", F.coalesce("__old", F.lit(False))).select(*shaped(hit, True))
    updated = marked.join(F.broadcast(n), on, "left").select(*shaped(hit, True))
    same = _all([F.col(f"__k{i}") == _c(of_batch[k.lower()]) for i, k in enumerate(keys)])
    if matched is None:
        known = base.select(*[_c(lower[k.lower()]).alias(f"__k{i}") for i, k in enumerate(keys)])
        matched = known.join(F.broadcast(n.select(*[of_batch[k.lower()] for k in keys])), same, "left_semi").distinct()
    inserted = n.join(F.broadcast(matched), same, "left_anti")  # at most as many keys as the batch has
    return updated.unionByName(inserted.select(*shaped(F.lit(True), False)))
