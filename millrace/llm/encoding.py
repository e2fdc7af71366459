"""Encoding of a whole corpus with a public byte-level tokenizer, whole texts, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.automaton import Encoder
from millrace.session import ship, spread

#: Where the vocabulary files lie; a parameter of every operator.
TOKENIZERS = "/opt/tokenizers"
TOKENIZER = "byte_bpe_50k.json"
#: A vocabulary file is sent to the executors up to this size.
MOST_BYTES = 64 << 20


def vocabulary(spark: SparkSession, folder: str = TOKENIZERS, name: str = TOKENIZER):
    """The tokenizer's file as a broadcast of checked size; read by the driver, so executors need no such folder."""
    content = Path(folder, name).read_bytes()
    if len(content) > MOST_BYTES:
        raise ValueError(f"{name} has {len(content)} bytes; at most {MOST_BYTES} are sent")
    return spark.sparkContext.broadcast(content)


_LOADED: dict[int, Encoder] = {}


def loaded(sent) -> Encoder:
    """The encoder of this worker, compiled once."""
    key = hash(sent.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(sent.value)
    return _LOADED[key]


def encode(docs: DataFrame, sent, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of each text, no special tokens. Empty and null texts give an empty list, blank ones the ids of
    their blanks; strings of special tokens in a text are plain text. Rows repeat as they come; other columns aren't read."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = loaded(sent)
        for batch in it:
            parts = [np.fromiter(enc.ids(t), np.int32) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, parts)])
            values = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[key, "ids"])

    kind = dict(docs.dtypes)[key]
    return spread(docs.select(key, text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, sent, key: str = "doc_id") -> DataFrame:
    """(key, text) of the ids: the arc labels' bytes, joined."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = loaded(sent)
        for batch in it:
            texts = [enc.decode(ids) if ids is not None else None for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    ship(encoded.sparkSession)
    kind = dict(encoded.dtypes)[key]
    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")


def token_counts(docs: DataFrame, sent, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and n_tokens (0 for empty and null texts)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = loaded(sent)
        for batch in it:
            n = pa.array([enc.count(t) for t in batch.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], n], names=[*keep, "n_tokens"])

    kinds = dict(docs.dtypes)
    src = docs.select(*keep, F.col(text).alias("__text"))
    return spread(src).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_tokens long")
