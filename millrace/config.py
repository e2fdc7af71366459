"""Settings of a sink, from flat string options.

Keys may carry one leading name, as in ``sink.flush.size``; per-table keys are ``table.<name>.id-columns``,
``table.<name>.partition-by`` and ``table.<name>.auto-create``. Keys that aren't known are refused, but for those of tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from millrace.functions.partitions import split_list
from millrace.sources.store import check_location


def _positive(name: str) -> Callable[[str], int]:
    def read(text: str) -> int:
        n = int(text)
        if n <= 0:
            raise ValueError(f"{name} must be positive, not {text}")
        return n

    return read


def _not_negative(name: str) -> Callable[[str], int]:
    def read(text: str) -> int:
        n = int(text)
        if n < 0:
            raise ValueError(f"{name} can't be negative")
        return n

    return read


def _flag(text: str) -> bool:
    if text.strip().lower() not in ("true", "false"):
        raise ValueError(f"true or false, not {text!r}")
    return text.strip().lower() == "true"


def _inlining(text: str) -> int | None:
    if text.strip().lower() == "off":
        return None
    return _not_negative("data.inlining.row.limit")(text)


def _catalog(text: str) -> str:
    """The folder of the tables' logs; blank: with the data. Services that aren't folders are refused."""
    return check_location(text) if text.strip() else ""


def _nothing(why: str) -> Callable[[str], str]:
    def read(text: str) -> str:
        if text.strip():
            raise ValueError(why)
        return ""

    return read


#: option: (default, reader). None as default: required (fixed values).
OPTIONS: dict[str, tuple[str | None, Callable]] = {
    "catalog_uri": ("", _catalog),
    "data_path": (None, check_location),
    "data.inlining.row.limit": ("10000", _inlining),
    "topic2table.map": ("", str),
    "consumer.override.max.poll.records": ("1024", _positive("consumer.override.max.poll.records")),
    "flush.size": ("1000000", _positive("flush.size")),
    "flush.interval.ms": ("60000", _positive("flush.interval.ms")),
    "file.size.bytes": ("268435456", _positive("file.size.bytes")),
    "threads": ("0", _not_negative("threads")),
    "parallel.partition.flush": ("true", _flag),
    "max_retry_count": ("10", _not_negative("max_retry_count")),
    "spill.enabled": ("false", _flag),
    "spill.directory": ("", _nothing("spilled data goes to spark.local.dir; set that instead")),
    "s3.url_style": ("", str),
    "s3.use_ssl": ("", str),
    "s3.endpoint": ("", str),
    "s3.access_key_id": ("", str),
    "s3.secret_access_key": ("", str),
}
_TABLE_KEYS = ("id-columns", "partition-by", "auto-create")


@dataclass(frozen=True)
class TableOptions:
    id_columns: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    auto_create: bool = False


@dataclass(frozen=True)
class Config:
    values: dict
    tables: dict = field(default_factory=dict)

    def __getitem__(self, name: str) -> object:
        return self.values[name]

    def table(self, name: str) -> TableOptions:
        return self.tables.get(name, TableOptions())

    def hadoop(self) -> dict[str, str]:
        """Settings of the object store, for s3 and s3a locations only."""
        if not str(self["data_path"]).startswith(("s3://", "s3a://")):
            return {}
        out = {}
        for key, name in (("s3.endpoint", "fs.s3a.endpoint"), ("s3.access_key_id", "fs.s3a.access.key"), ("s3.secret_access_key", "fs.s3a.secret.key"), ("s3.use_ssl", "fs.s3a.connection.ssl.enabled")):
            if self[key]:
                out[name] = str(self[key])
        if self["s3.url_style"]:
            out["fs.s3a.path.style.access"] = str(self["s3.url_style"] == "path").lower()
        return out

    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self['flush.interval.ms']} milliseconds"}

    def task_configs(self, n: int, options: dict[str, str]) -> list[dict[str, str]]:
        """The same options for each of n parallel writers, numbered."""
        return [{**options, "task.id": str(i)} for i in range(n)]


def _bare(key: str) -> str:
    if key in OPTIONS or key.startswith("table."):
        return key
    rest = key.partition(".")[2]
    return rest if rest in OPTIONS or rest.startswith("table.") else key


def parse(options: dict[str, str]) -> Config:
    """Checks and reads all options; the first wrong one raises ValueError with its name."""
    values, tables, seen = {}, {}, {}
    for key, text in options.items():
        name = _bare(key)
        if name == "task.id":
            continue
        if name.startswith("table."):
            table, _, what = name[len("table.") :].rpartition(".")
            if what in _TABLE_KEYS and table:
                seen.setdefault(table, {})[what] = text
            continue
        if name not in OPTIONS:
            raise ValueError(f"unknown option {key}")
        values[name] = text
    for name, (default, read) in OPTIONS.items():
        text = values.get(name, default)
        if text is None:
            raise ValueError(f"option {name} is required")
        try:
            values[name] = read(text)
        except ValueError as e:
            raise ValueError(f"option {name}: {e}") from e
    for table, o in seen.items():
        tables[table] = TableOptions(tuple(split_list(o.get("id-columns"))), tuple(split_list(o.get("partition-by"))), _flag(o.get("auto-create", "false")))
    return Config(values, tables)
