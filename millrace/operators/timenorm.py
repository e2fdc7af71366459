"""Mixed timestamp notations and zones to UTC microseconds.

A source (topic and column) writes its times in a mixture of formats: notations, all-numeric dates with ``/`` or ``-`` in two
orders. A text has likelihood under each format that reads it as a real time, and a little under none (a slip). Texts are
counted per source by the formats they fit, and expectation-maximisation over these counts learns the weights of the mixture.
An order registered for the source is a prior, strong but finite. Every text's reading is the format of highest posterior, a
slip included; a reading whose posterior stays below ``certainty`` while another format fits is marked ambiguous.

Texts are read once, in one Python pass; what they fit is written to the shared folder, the mixtures come from counts of it,
and a small table of posteriors, one row per source and set of fitting formats, picks each row's reading in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import clock
from millrace.session import cut, registry_rows, ship

#: Chance that a source writes a text of some notation that isn't a real time in the format meant.
SLIP = 0.01
#: A registered order weighs as so many observations per all-numeric date of its source, and one: it yields only where more than
#: 2 * (1 + STRENGTH) * SLIP of these dates, 82 %, are real in the other order alone.
STRENGTH = 40.0
#: Posteriors of at most so many rows are broadcast.
BROADCAST_ROWS = 200_000
CANONICAL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}Z$"


def formats(fits: str) -> list[str]:
    """The formats of a set, as :func:`_read` names it: ``notation:places``, places being those of the two readings that are real
    times (``a`` the only one or day first, ``b`` month first)."""
    notation, _, places = fits.partition(":")
    if notation.startswith("numeric"):
        return [{"a": "dmy", "b": "mdy"}[x] for x in places]
    return [notation] if places else []


def _family(fits: str) -> tuple[str, ...]:
    notation = fits.partition(":")[0]
    return ("dmy", "mdy") if notation.startswith("numeric") else (notation,)


def mixture(counts: dict[str, int], registered: str | None = None, prior: float = 1.0, rounds: int = 200) -> dict[str, float]:
    """Weights of a source's formats, from the numbers of its texts by the formats they fit.

    E-step: a text's share goes to the fitting formats by weight, and to a slip by SLIP times the weights of its notation; M-step:
    weights are the shares with the prior's observations (``prior`` each, for a registered order more)."""
    names = sorted({f for fits in counts for f in _family(fits)})
    if not names:
        return {}
    numeric = sum(n for fits, n in counts.items() if _family(fits) == ("dmy", "mdy"))
    alpha = {f: prior + (STRENGTH * (numeric + 1) if f == registered else 0.0) for f in names}
    weights = dict.fromkeys(names, 1 / len(names))  # from even weights, as a strong prior would be a trap of its own
    for _ in range(rounds):
        shares = dict(alpha)
        for fits, n in counts.items():
            for f, p in posterior(fits, weights).items():
                if f in shares:
                    shares[f] += n * p
        total = sum(shares.values())
        new = {f: x / total for f, x in shares.items()}
        moved = max(abs(new[f] - weights[f]) for f in names)
        weights = new
        if moved < 1e-9:
            break
    return weights


def posterior(fits: str, weights: dict[str, float]) -> dict[str, float]:
    """Probability of each fitting format, and of ``slip``."""
    of = {f: weights.get(f, 0.0) for f in formats(fits)}
    of["slip"] = SLIP * sum(weights.get(f, 0.0) for f in _family(fits)) or 1e-12
    total = sum(of.values())
    return {f: w / total for f, w in of.items()}


def choose(fits: str, weights: dict[str, float], certainty: float) -> tuple[str, str, float, str]:
    """(place of the reading, place of the other one, posterior, status) of a source's texts of a set; places are ``a``, ``b`` or
    empty."""
    notation, _, places = fits.partition(":")
    if notation == "canonical":
        return "a", "", 1.0, "canonical"
    p = posterior(fits, weights)
    by = {x: p[f] for x, f in zip(places, formats(fits), strict=True)}
    best = max(by, key=lambda x: (by[x], x == "a"), default="")
    if not best or by[best] < p["slip"]:
        return "", "", p["slip"], "unreadable"
    other = next((x for x in places if x != best), "")
    among = by[best] / sum(by.values())
    return best, other, among, "ambiguous" if other and among < certainty else "normalised"


_READ = "row_key long, topic string, field_name string, {text}fits string, a long, b long"


def _read(zones: dict[str, str], keep_text: bool):
    """Texts to the formats they fit and the instants these give."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fits, first, second = [], [], []
            for topic, text in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if clock.CANONICAL.fullmatch(text) and (us := clock.iso_micros(text)) is not None:
                    fits.append("canonical:a")
                    first.append(us)
                    second.append(None)
                    continue
                name, a, b = clock.interpretations(text, zones.get(topic))
                if name.startswith("numeric"):
                    fits.append(f"{name}:{'' if a is None else 'a'}{'' if b is None else 'b'}")
                    second.append(b)
                else:
                    fits.append(f"{name}:{'' if a is None else 'a'}")
                    second.append(None)
                first.append(a)
            cols = [*batch.columns[: 4 if keep_text else 3], pa.array(fits, pa.string()), pa.array(first, pa.int64()), pa.array(second, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _READ.format(text="text string, " if keep_text else "").split(", ")])

    return run


def melt(df: DataFrame, key: str, topic: str, columns: list[str]) -> DataFrame:
    """One row per key and time column: (key, topic, field_name, text). Null texts are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("text")) for c in columns])
    return df.select(F.col(key).cast("long").alias("row_key"), F.col(topic).alias("topic"), F.explode(pairs).alias("p")).select("row_key", "topic", "p.field_name", "p.text").where(F.col("text").isNotNull())


def learn(read: DataFrame, orders: dict[str, str], certainty: float, prior: float) -> DataFrame:
    """(topic, field_name, fits, place, other, posterior, status): a row per source and set of formats its texts fit."""
    counts = read.groupBy("topic", "field_name", "fits").agg(F.count(F.lit(1)).alias("n"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        topic = pdf["topic"].iloc[0]
        weights = mixture({f: n for f, n in zip(pdf["fits"], pdf["n"], strict=True) if f != "canonical:a"}, orders.get(topic), prior)
        chosen = [choose(f, weights, certainty) for f in pdf["fits"]]
        return pdf[["topic", "field_name", "fits"]].assign(place=[c[0] for c in chosen], other=[c[1] for c in chosen], posterior=[c[2] for c in chosen], status=[c[3] for c in chosen])

    return counts.groupBy("topic", "field_name").applyInPandas(one, "topic string, field_name string, fits string, place string, other string, posterior double, status string")


def _normalise(texts: DataFrame, topics: DataFrame, certainty: float, prior: float, keep_text: bool) -> DataFrame:
    ship(texts.sparkSession)
    zones, orders = {}, {}
    for r in registry_rows(topics.select("topic", "zone_name", "day_order").where(F.col("topic").isNotNull())):
        zones.setdefault(r.topic, r.zone_name)
        orders.setdefault(r.topic, r.day_order)
    read = cut(texts.mapInArrow(_read(zones, keep_text), _READ.format(text="text string, " if keep_text else "")))
    chosen = cut(learn(read, orders, certainty, prior).toDF("c_topic", "c_field", "c_fits", "place", "other", "posterior", "status"))
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    on = F.col("topic").eqNullSafe(F.col("c_topic")) & (F.col("field_name") == F.col("c_field")) & (F.col("fits") == F.col("c_fits"))
    at = lambda place: F.when(F.col(place) == "a", F.col("a")).when(F.col(place) == "b", F.col("b"))
    rows = read.join(chosen, on).withColumn("utc_us", at("place")).withColumn("other_us", F.nullif(at("other"), F.col("utc_us")))
    # day and month may be the same number: both orders are one reading
    same = (F.col("status") == "ambiguous") & F.col("other_us").isNull()
    return rows.withColumn("status", F.when(same, "normalised").otherwise(F.col("status"))).withColumn("notation", F.regexp_extract("fits", "^[^:]*", 0))


def normalise(df: DataFrame, topics: DataFrame, key: str = "row_id", topic: str = "topic", columns: tuple[str, ...] = ("created_at", "record_timestamp"), certainty: float = 0.95, prior: float = 1.0) -> DataFrame:
    """Every non-null text of ``columns`` with its instant in UTC.

    Result: row_key, topic, field_name, text, notation, utc_us (null where unreadable), other_us (the other reading of an
    all-numeric date), posterior (of the reading among those that fit; of a slip where unreadable), status (``canonical``,
    ``normalised``, ``ambiguous``, ``unreadable``). Null texts give no row, empty and blank ones are unreadable, repeated rows
    repeat, a null topic is UTC without order; other columns of ``df`` are not read, so clashing names don't matter."""
    rows = _normalise(melt(df, key, topic, list(columns)), topics, certainty, prior, True)
    return rows.select("row_key", "topic", "field_name", "text", "notation", "utc_us", "other_us", "posterior", "status")


def found(df: DataFrame, topics: DataFrame, certainty: float = 0.95, prior: float = 1.0) -> DataFrame:
    """Readable texts that weren't canonical: row_id, field_name, utc_us. An ambiguous date counts by its likelier reading.
    Canonical texts are left out before the texts are read."""
    texts = melt(df, "row_id", "topic", ["created_at", "record_timestamp"])
    # the mixtures are of the other texts alone, so that leaving these out changes nothing
    canonical = F.col("text").rlike(CANONICAL) & F.col("text").try_cast("timestamp").isNotNull()
    rows = _normalise(texts.where(~canonical), topics, certainty, prior, False)
    return rows.where(F.col("status").isin("normalised", "ambiguous")).select(F.col("row_key").alias("row_id"), "field_name", "utc_us")
