"""Timings and counts of writes: averages, maxima, rates and totals, overall and by operation."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPERATIONS = ("upsertWithMergeInto", "simpleInsert", "createTable", "evolveSchema")


class Sensor:
    """Count, total, average, maximum and rate per second of what is recorded."""

    def __init__(self, clock=time.monotonic):
        self.clock, self.begun, self.count, self.total, self.max = clock, clock(), 0, 0.0, 0.0

    def record(self, value: float) -> None:
        self.count += 1
        self.total += value
        self.max = max(self.max, value)

    def values(self) -> dict[str, float]:
        age = max(1e-9, self.clock() - self.begun)
        return {"count": self.count, "total": self.total, "avg": self.total / self.count if self.count else 0.0, "max": self.max, "rate": self.count / age}


class Metrics:
    def __init__(self, clock=time.monotonic):
        self.clock, self.lock, self.sensors = clock, threading.Lock(), {}

    def record(self, name: str, value: float) -> None:
        with self.lock:
            self.sensors.setdefault(name, Sensor(self.clock)).record(value)

    def records(self, n: int) -> None:
        """A batch of n records was written."""
        self.record("batch-size", n)

    @contextmanager
    def timer(self, operation: str) -> Iterator[None]:
        """Times the block in milliseconds, failures too; schema operations also count as such."""
        began = self.clock()
        try:
            yield
        finally:
            ms = (self.clock() - began) * 1000
            for name in ("query", f"query.{operation}", *(["schema"] if operation in ("createTable", "evolveSchema") else [])):
                self.record(name, ms)

    def snapshot(self) -> dict[str, dict[str, float]]:
        with self.lock:
            return {k: s.values() for k, s in sorted(self.sensors.items())}

    def close(self) -> None:
        with self.lock:
            self.sensors.clear()


def rollup(events: DataFrame, operation: str, value: str) -> DataFrame:
    """The same aggregates over recorded values: per operation count, total, average and maximum."""
    return events.groupBy(F.col(operation).alias("op")).agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("avg_value"), F.max(value).alias("max_value"))
