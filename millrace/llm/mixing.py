"""Mixing sources to target weights, in tokens.

The size of a mix is cut into blocks of equal tokens. Sainte-Lague apportionment gives each block to the source of highest
quotient, so that sources get integer numbers of blocks; the same rule then shares a source's blocks among its shards, hash
ranges of its documents, which bound what any task orders; very many shards are dealt theirs in two steps. Within a shard the documents stand in an order drawn from the
seed: each is taken as often as the whole shard fits into its quota, and those first in the order once more for the rest.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut, registry_rows, ship

#: Blocks of a mix; the size of a mix is met to about one part in this.
BLOCKS = 10_000
#: Documents of one shard, about. Shards are dealt their quotas by the driver in at most so many parts; where there are more shards,
#: each part deals its own among them, in tasks.
SHARD_DOCS = 50_000
MOST_PARTS = 4096
#: Blocks per shard when a part deals its quota.
FINE = 8


def sainte_lague(weights: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by highest quotient weight / (2 * seats held + 1); ties go to the lower index. A party at its cap gets no more;
    seats nobody can take stay empty. Weights of 0 or less get nothing.

    Without caps the bulk of the seats is dealt at once: every quotient above total / (2 * (seats - parties)) is among the
    highest, so those are held from the start and only about as many seats as parties go through the heap."""
    n = len(weights)
    caps = [seats] * n if caps is None else caps
    w = [max(0.0, x) for x in weights]
    total = sum(w)
    if not total or seats <= 0:
        return [0] * n
    held = [0] * n
    heap = [(-w[i], i) for i in range(n) if w[i] > 0 and caps[i] > 0]
    if caps == [seats] * n or all(c >= seats for c in caps):
        level = total / (2 * max(1, seats - n))
        for i in range(n):
            if w[i] > 0 and seats > 2 * n:
                held[i] = max(0, min(caps[i], int((w[i] / (level * 1.0000001) - 1) / 2)))
        if sum(held) > seats:
            held = [0] * n
        heap = [(-w[i] / (2 * held[i] + 1), i) for i in range(n) if w[i] > 0 and held[i] < caps[i]]
    heapq.heapify(heap)
    left = seats - sum(held)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        held[i] += 1
        left -= 1
        if held[i] < caps[i]:
            heapq.heappush(heap, (-w[i] / (2 * held[i] + 1), i))
    return held


def quotas(targets: list, totals: dict[str, dict[int, int]], corpus_tokens: int, blocks: int = BLOCKS) -> list[tuple]:
    """Rows (mix_name, source, shard, quota, max_repeats, target_tokens): tokens to draw from each shard.

    A source beyond its capped repeats gives what it has; its missing blocks are not given to others, as that would move
    their shares. Repeated (mix, source) rows count by their first."""
    mixes: dict[str, list] = {}
    for r in sorted(targets, key=lambda r: (r.mix_name or "", r.source or "")):
        if r.mix_name is not None and r.source is not None and not any(x.source == r.source for x in mixes.setdefault(r.mix_name, [])):
            mixes[r.mix_name].append(r)
    out = []
    for mix, rows in sorted(mixes.items()):
        size = int((rows[0].corpus_ratio or 0) * corpus_tokens)
        block = max(1, size // blocks)
        shares = [max(0.0, r.target_share or 0.0) for r in rows]
        whole = sum(shares)
        # shares that leave a part of the mix to nobody leave its blocks unseated
        seats = sainte_lague([*shares, max(0.0, 1 - whole)] if whole < 1 - 1e-9 else shares, size // block if size else 0)
        for r, n in zip(rows, seats, strict=False):
            shards = totals.get(r.source, {})
            have = sum(shards.values())
            target = n * block
            most = (r.max_repeats if r.max_repeats is not None else 1) * have
            if target >= most:
                out += [(mix, r.source, s, t * (most // have), r.max_repeats or 0, target) for s, t in sorted(shards.items()) if have]
                continue
            order = sorted(shards)
            caps = [-(-shards[s] * (r.max_repeats or 0) // block) for s in order]
            for s, b in zip(order, sainte_lague([shards[s] for s in order], n, caps), strict=True):
                out.append((mix, r.source, s, min(b * block, shards[s] * (r.max_repeats or 0)), r.max_repeats or 0, target))
    return out


def deal(tokens: list[int], quota: int, repeats: int) -> list[int]:
    """A part's quota among its shards, by the same rule, in blocks of about an eighth of a shard's share; none gets more than its
    tokens times ``repeats``."""
    if quota >= repeats * sum(tokens):
        return [t * repeats for t in tokens]
    block = max(1, quota // (FINE * len(tokens)))
    caps = [-(-t * repeats // block) for t in tokens]
    return [min(b * block, t * repeats) for b, t in zip(sainte_lague(tokens, quota // block, caps), tokens, strict=True)]


_PLAN = "mix_name string, source string, shard int, quota long, max_repeats int, shard_tokens long"


def _dealt(usable: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan of parts as one of shards."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard").reset_index(drop=True)
        quota = deal([int(t) for t in pdf["t"]], int(pdf["quota"][0]), int(pdf["max_repeats"][0]))
        return pdf[["mix_name", "source", "shard"]].assign(quota=quota, max_repeats=pdf["max_repeats"], shard_tokens=pdf["t"])

    per_shard = usable.groupBy("source", "part", "shard").agg(F.sum("n_tokens").alias("t"))
    parts = plan.withColumnRenamed("shard", "part").drop("shard_tokens")
    return per_shard.join(F.broadcast(parts), ["source", "part"]).groupBy("mix_name", "source", "part").applyInPandas(one, _PLAN).where("quota > 0")  # the plan has at most MOST_PARTS rows a mix and source


def choose(counts: DataFrame, targets: DataFrame, seed: int = 0, blocks: int = BLOCKS, shard_docs: int = SHARD_DOCS, most_parts: int = MOST_PARTS) -> tuple[DataFrame, DataFrame]:
    """(chosen, shares) from counts (doc_id, source, n_tokens).

    chosen: mix_name, source, doc_id, n_tokens, repeats (1 to max_repeats). shares: a row per mix and source: target_share,
    target_tokens, available_tokens, actual_tokens, actual_share (of what was drawn), reached. Documents without source
    or without tokens are never drawn but count to the corpus; sources without documents get a row with nothing drawn."""
    spark = counts.sparkSession
    ship(spark)
    n_docs, corpus = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    n_shards = max(1, -(-n_docs // shard_docs))
    n_parts = min(n_shards, most_parts)
    n_shards = -(-n_shards // n_parts) * n_parts  # as many in each part
    wanted = registry_rows(targets.select("mix_name", "corpus_ratio", "source", "target_share", "max_repeats"))
    shard = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(n_shards)).cast("int")
    sources = sorted({r.source for r in wanted if r.source is not None})
    usable = counts.where((F.col("n_tokens") > 0) & F.col("source").isin(sources)).withColumn("shard", shard).withColumn("part", F.pmod("shard", F.lit(n_parts)))
    totals: dict[str, dict[int, int]] = {}
    per_part = usable.groupBy("source", "part").agg(F.sum("n_tokens").alias("t"))
    for r in registry_rows(per_part, most_parts * max(1, len(sources))):  # at most parts times sources rows
        totals.setdefault(r.source, {})[r.part] = r.t
    rows = quotas(wanted, totals, corpus, blocks)
    plan = spark.createDataFrame([(m, s, h, q, k, totals[s][h]) for m, s, h, q, k, _ in rows if q > 0], _PLAN)
    if n_shards > n_parts:
        plan = cut(_dealt(usable, plan))
    drawn = usable.join(plan, ["source", "shard"])
    order = Window.partitionBy("mix_name", "source", "shard").orderBy(F.xxhash64(F.lit(seed), "mix_name", "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("n_tokens").over(order)
    full = F.floor(F.col("quota") / F.col("shard_tokens"))
    rest = F.col("quota") - full * F.col("shard_tokens")
    # the document that crosses the quota is taken if that ends nearer to it
    extra = (upto - F.col("n_tokens") / 2 <= rest) & (rest > 0) & (full < F.col("max_repeats"))
    chosen = drawn.withColumn("repeats", (full + F.when(extra, 1).otherwise(0)).cast("int")).where("repeats > 0").select("mix_name", "source", "doc_id", "n_tokens", "repeats")
    chosen = cut(chosen)
    actual = chosen.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("actual_tokens"))
    whole: dict[str, float] = {}
    for r in wanted:
        whole[r.mix_name] = whole.get(r.mix_name, 0.0) + max(0.0, r.target_share or 0.0)
    goal = []
    for r in wanted:
        if r.mix_name is not None and r.source is not None:
            share = max(0.0, r.target_share or 0.0) / max(1.0, whole[r.mix_name])  # shares of more than the whole are scaled
            goal.append((r.mix_name, r.source, r.target_share, int(share * (r.corpus_ratio or 0) * corpus), sum(totals.get(r.source, {}).values())))
    goals = spark.createDataFrame(goal, "mix_name string, source string, target_share double, target_tokens long, available_tokens long").dropDuplicates(["mix_name", "source"])
    shares = goals.join(actual, ["mix_name", "source"], "left").withColumn("actual_tokens", F.coalesce("actual_tokens", F.lit(0)).cast("long"))
    total = F.sum("actual_tokens").over(Window.partitionBy("mix_name"))
    tolerance = F.col("target_tokens") * 0.01 + F.lit(2.0) * F.lit(n_shards) * F.lit((corpus or 0) / max(1, n_docs))
    shares = shares.withColumn("actual_share", F.when(total > 0, F.col("actual_tokens") / total).otherwise(0.0)).withColumn("reached", F.abs(F.col("actual_tokens") - F.col("target_tokens")) <= tolerance)
    return chosen, shares
