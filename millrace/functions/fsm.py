"""Finite-state tokenising of many records at once.

All records of an Arrow batch are cut into chunks of equal width. For every chunk the whole transition function (start
state -> end state) is computed by table steps over the chunk matrix, the functions of a record's chunks are composed in
order, and a second pass, with every chunk's start state now known, marks delimiters and the first error. Records of any
length take the same path; nothing depends on where a chunk ends.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDTH = 64
#: Cells (chunks x width) handled at a time, so that memory doesn't grow with the batch.
CELLS = 1 << 22


@dataclass(frozen=True)
class Machine:
    """``table[state, class]`` is the next state, ``classes[byte]`` the class; the last class is padding and keeps the state."""

    table: np.ndarray
    classes: np.ndarray
    start: int
    errors: tuple[int, ...]
    #: state, class pairs that end a field
    cuts: tuple[tuple[int, int], ...] = ()


def csv_machine(delimiter: str) -> Machine:
    """States: 0 field start, 1 unquoted, 2 quoted, 3 quote seen in quoted, then errors: 4 quote inside a field, 5 text
    after a closing quote, 6 line break outside quotes. Classes: 0 other, 1 quote, 2 delimiter, 3 line break, 4 padding."""
    classes = np.zeros(256, np.uint8)
    classes[ord('"')], classes[10], classes[13] = 1, 3, 3
    classes[ord(delimiter)] = 2
    table = np.array(
        [
            [1, 2, 0, 6, 0],
            [1, 4, 0, 6, 1],
            [2, 3, 2, 2, 2],
            [5, 2, 0, 6, 3],
            [4, 4, 4, 4, 4],
            [5, 5, 5, 5, 5],
            [6, 6, 6, 6, 6],
        ],
        np.uint8,
    )
    return Machine(table, classes, 0, (4, 5, 6), ((0, 2), (1, 2), (3, 2)))


def json_machine() -> Machine:
    """States: 0 outside strings, 1 in a string, 2 after a backslash, 3 error (control character in a string).
    Classes: 0 other, 1 quote, 2 backslash, 3 control character, 4 padding."""
    classes = np.zeros(256, np.uint8)
    classes[:32] = 3
    classes[ord('"')], classes[ord("\\")] = 1, 2
    table = np.array([[0, 1, 0, 0, 0], [1, 0, 2, 3, 1], [1, 1, 1, 3, 2], [3, 3, 3, 3, 3]], np.uint8)
    return Machine(table, classes, 0, (3,))


@dataclass
class Tokens:
    end_state: np.ndarray
    #: byte offset in the record of the first step into an error state, -1 for none
    error_at: np.ndarray
    #: byte offsets of field ends in the record, and the first index of each record in them
    cuts: np.ndarray
    first_cut: np.ndarray


def _slice(machine: Machine, data: np.ndarray, offsets: np.ndarray, width: int) -> Tokens:
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    per = np.maximum(1, -(-lengths // width))
    first = np.concatenate([[0], np.cumsum(per)])
    owner = np.repeat(np.arange(n), per)
    within = np.arange(first[-1]) - first[owner]
    begin = offsets[owner] + within * width
    size = np.minimum(offsets[owner + 1] - begin, width)
    pad = machine.table.shape[1] - 1
    index = begin[:, None] + np.arange(width)[None, :]
    valid = np.arange(width)[None, :] < size[:, None]
    cls = np.where(valid, machine.classes[data[np.minimum(index, max(len(data) - 1, 0))]] if len(data) else pad, pad).astype(np.uint8)
    states = machine.table.shape[0]
    # first pass: every chunk's transition function
    end = np.tile(np.arange(states, dtype=np.uint8), (len(owner), 1))
    for j in range(int(size.max(initial=0))):
        end = machine.table[end, cls[:, j][:, None]]
    # composition over a record's chunks, all records side by side
    start = np.full(len(owner), machine.start, np.uint8)
    final = np.full(n, machine.start, np.uint8)
    live = np.arange(n)
    k = 0
    while len(live):
        c = first[live] + k
        start[c] = final[live]
        final[live] = end[c, final[live]]
        k += 1
        live = live[per[live] > k]
    # second pass, start states known
    is_cut = np.zeros(machine.table.shape, bool)
    for s, c in machine.cuts:
        is_cut[s, c] = True
    bad = np.zeros(states, bool)
    bad[list(machine.errors)] = True
    state = start.copy()
    marks = np.zeros(cls.shape, bool)
    first_bad = np.full(len(owner), -1, np.int64)
    for j in range(int(size.max(initial=0))):
        marks[:, j] = is_cut[state, cls[:, j]]
        new = machine.table[state, cls[:, j]]
        hit = bad[new] & ~bad[state]
        first_bad[hit] = (within[hit] * width) + j
        state = new
    error_at = np.full(n, -1, np.int64)
    hit = first_bad >= 0
    error_at[owner[hit]] = first_bad[hit]
    rows, cols = np.nonzero(marks)
    cuts = within[rows] * width + cols
    first_cut = np.searchsorted(owner[rows], np.arange(n + 1))
    return Tokens(final, error_at, cuts, first_cut)


def tokenize(machine: Machine, records: list[bytes], width: int = WIDTH) -> Tokens:
    """Runs the machine over all records, a bounded number of cells at a time."""
    parts: list[Tokens] = []
    i = 0
    while i < len(records):
        j, cells = i, 0
        while j < len(records) and (j == i or cells + len(records[j]) + width <= CELLS):
            cells += len(records[j]) + width
            j += 1
        some = records[i:j]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in some])]).astype(np.int64)
        parts.append(_slice(machine, np.frombuffer(b"".join(some), np.uint8), offsets, width))
        i = j
    if not parts:
        empty = np.zeros(0, np.int64)
        return Tokens(empty, empty, empty, np.zeros(1, np.int64))
    base = np.cumsum([0, *(len(p.cuts) for p in parts)])
    first = np.concatenate([*(p.first_cut[:-1] + b for p, b in zip(parts, base, strict=False)), [base[-1]]])
    return Tokens(np.concatenate([p.end_state for p in parts]), np.concatenate([p.error_at for p in parts]), np.concatenate([p.cuts for p in parts]), first)
