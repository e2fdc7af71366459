"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that the merges produce. It is built by one gadget per merge, in order:
after merge (u, v) -> w, a ``u`` no longer leads to a state that reads ``v``, and ``w`` is read wherever ``u`` was, leading
where ``v`` led. All arcs of a label lead to one state, so a state is a label and a time: which merges had been applied
when the label's target was last copied. States are kept implicitly like that, as writing out the arcs of 50,000 states
takes billions of entries; :meth:`Automaton.reads` answers for one (state, token) and remembers it in the transition table.

A byte string has one accepted path. It is found by table steps over the tokens that start at each position, longest
first; a position from which the end can't be reached is left for the next shorter token and never tried again.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import regex

#: Splits text into words; the tokenizer's own pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ANY = regex.compile(PATTERN)
_BLANK = r" \t\n\r\x0b\x0c"
#: The same for ASCII texts without the control characters 1c to 1f, on character classes alone.
_ASCII = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^{_BLANK}A-Za-z0-9]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Words longer than this are encoded but not remembered; so many words are remembered at most.
LONGEST_KEPT = 64
MOST_KEPT = 200_000
#: Transitions remembered at most.
MOST_TRANSITIONS = 500_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    def __init__(self, pieces: dict[int, bytes], merges: list[tuple[int, int, int]]):
        """pieces: token -> bytes. merges: (left, right, merged) in the order they apply."""
        self.pieces = pieces
        self.size = max(pieces, default=0) + 1
        self.left: list[int] = [-1] * self.size
        self.right: list[int] = [-1] * self.size
        self.born: list[int] = [-1] * self.size
        self.merged_at: dict[int, int] = {}
        self.table: dict[int, bool] = {}
        dead = set()
        for at, (u, v, w) in enumerate(merges):
            if u in dead or v in dead or self.born[w] >= 0 or not self._reads(u, at, v):
                if self.born[w] < 0 and len(pieces[w]) > 1:
                    dead.add(w)
                continue
            dead.discard(w)
            self.merged_at[u * self.size + v] = at
            self.left[w], self.right[w], self.born[w] = u, v, at
        self.tokens = {b: t for t, b in pieces.items() if len(b) == 1 or self.born[t] >= 0}
        self.longest: dict[bytes, int] = {}
        for b in self.tokens:
            self.longest[b[:2]] = max(self.longest.get(b[:2], 1), len(b))

    def _reads(self, label: int, time: int, token: int) -> bool:
        """Whether the state that ``label`` led to before merge number ``time`` reads ``token``."""
        left, right, born, merged_at, size = self.left, self.right, self.born, self.merged_at, self.size
        while True:
            at = merged_at.get(label * size + token)
            if at is not None and at < time:
                return False  # the gadget of that merge took the arc away
            label_born, token_born = born[label], born[token]
            if token_born < 0 and label_born < 0:
                return True  # bytes, and no merge between them
            if token_born > label_born:
                time, token = token_born + 1, left[token]  # the arc came with the token, where its left part was read
            else:
                if token_born == label_born:
                    token = left[token]
                time, label = label_born, right[label]  # the label's first target: where its right part led then

    def reads(self, last: int, token: int) -> bool:
        key = last * self.size + token
        known = self.table.get(key)
        if known is None:
            if len(self.table) > MOST_TRANSITIONS:
                self.table.clear()
            known = self.table[key] = self._reads(last, 1 << 60, token)
        return known

    def encode(self, word: bytes) -> tuple[int, ...]:
        """Arc labels of the one accepted path that spells ``word``."""
        tokens = self.tokens
        whole = tokens.get(word)
        if whole is not None:
            return (whole,)
        n = len(word)
        path: list[int] = []
        starts = [0]
        lengths = [min(n, self.longest.get(word[:2], 1))]
        lost: set[tuple[int, int]] = set()
        while True:
            at, length = starts[-1], lengths[-1]
            while length > 0:
                token = tokens.get(word[at : at + length])
                if token is not None and (not path or self.reads(path[-1], token)) and (at + length, token) not in lost:
                    break
                length -= 1
            lengths[-1] = length - 1
            if length <= 0:
                starts.pop()
                lengths.pop()
                if not path:
                    raise ValueError("the vocabulary lacks bytes of the text")
                lost.add((at, path.pop()))
                continue
            path.append(token)
            at += length
            if at == n:
                return tuple(path)
            starts.append(at)
            lengths.append(min(n - at, self.longest.get(word[at : at + 2], 1)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def read_vocabulary(content: bytes) -> tuple[dict[int, bytes], list[tuple[int, int, int]]]:
    """Pieces and merges of a byte-level ``tokenizer.json``. Special tokens are left out: in a text they are plain text."""
    model = json.loads(content)
    special = {t["id"] for t in model.get("added_tokens", []) if t.get("special")}
    symbols = byte_symbols()
    vocab = model["model"]["vocab"]
    pieces = {i: bytes(map(symbols.__getitem__, s)) for s, i in vocab.items() if i not in special}
    pairs = (m if isinstance(m, (list, tuple)) else m.split(" ") for m in model["model"]["merges"])
    return pieces, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]


class _Words(dict):
    def __init__(self, encode, keep):
        super().__init__()
        self.encode, self.keep = encode, keep

    def __missing__(self, word: str):
        out = self.keep(self.encode(word.encode("utf-8", "surrogatepass")))
        if len(word) <= LONGEST_KEPT:
            if len(self) >= MOST_KEPT:
                self.clear()
            self[word] = out
        return out


class Encoder:
    """Texts to ids. Words repeat, so their paths are remembered, up to a fixed number of words."""

    def __init__(self, content: bytes):
        self.automaton = Automaton(*read_vocabulary(content))
        self._ids = _Words(self.automaton.encode, tuple)
        self._counts = _Words(self.automaton.encode, len)

    @staticmethod
    def words(text: str) -> list[str]:
        return (_ASCII if text.isascii() and not _SEPARATORS.search(text) else _ANY).findall(text)

    def ids(self, text: str | None):
        """An iterator over the ids of a text; of none for null and empty ones."""
        return chain.from_iterable(map(self._ids.__getitem__, self.words(text))) if text else iter(())

    def count(self, text: str | None) -> int:
        return sum(map(self._counts.__getitem__, self.words(text))) if text else 0

    def decode(self, ids: list[int]) -> str:
        return self.automaton.decode(ids).decode("utf-8", "replace")
