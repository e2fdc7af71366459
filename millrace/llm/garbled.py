"""Text decoded with the wrong encoding: find the stretches, restore what can be restored.

A hidden Markov model labels the characters of a text with one clean state, one state per pair (encoding it was written in,
encoding it was read with; read twice counts as a pair of its own), and one for characters that were lost (U+FFFD). A state
emits units: the characters that one original character turns into; the clean state emits single characters. What a unit costs
is what its original costs as clean text (rarity of the character, fit with its neighbours), so a state explains a stretch
better than the clean state exactly if the original is the more ordinary text. Transitions cost what they are rare, and
staying in a garbled state costs a little per unit, so that many small gains over sound text don't add up.

ASCII is alike in all states and not observed, so blanks part a text into words that share nothing but the state they are
entered and left in. A word's best paths by these two states are exact Viterbi paths over its characters; they are remembered,
and the path of a text is joined from them. Every labelled span gets its state's inverse transform, also several within a word;
what was replaced by U+FFFD on the way is beyond repair and is left so.

The model is trained on the corpus itself, by rounds of Viterbi training: all texts are labelled, the characters labelled clean
and their neighbours, and the transitions, are counted over all texts, and every distribution becomes an even mixture of its
initial and its counted form. Garbled stretches don't train the clean state.
"""

from __future__ import annotations

import json
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.session import registry_rows, ship, spread

#: Costs in nats of entering a garbled state and of leaving it, before training; of pairs of two older encodings, which are rarer,
#: entering costs more.
ENTER, ENTER_OLD, LEAVE = 7.0, 10.0, 2.0
#: Costs of a clean character amid a garbled state: of one the state can't have emitted, and of one it can have.
ODD, ODD_UNIT = 3.0, 5.0
#: What a transition amid the characters of a word costs more than one between words.
INSIDE = 3.0
#: What two ways to the same place can still differ by, as the classes of their last characters differ.
SLACK = 15.0
LOST = "�"
#: Cost of U+FFFD as clean text and as a lost character.
LOST_CLEAN, LOST_GARBLED = 24.0, 6.0
#: Letters of Russian text by falling frequency (fixed value); the cost follows Zipf's law over the ranks.
_CYRILLIC = "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё"
_OFTEN = "éèàùâêîôûçëïüöäßñáíóúãõ"
#: Share of the counted distribution in the trained one, what an unseen character's cost grows by, and rounds of training.
TRAINED_SHARE = 0.5
ROUNDS = 2
MIX_COST = -math.log(1 - TRAINED_SHARE)
#: Words of more characters are labelled but not remembered; so many are remembered at most.
LONGEST_KEPT, MOST_KEPT = 120, 100_000


@lru_cache(maxsize=1 << 16)
def kind(c: str) -> str:
    """Class of a character: a/A ASCII letters, l/L other Latin, c/C Cyrillic, g/G Greek, K kana, H han, F wide
    punctuation, d digits, w blanks, o other ASCII, p punctuation, s symbols, b boxes and arrows, e emoji, x controls and
    unassigned, u other letters, r U+FFFD."""
    o = ord(c)
    if o < 128:
        return "a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "d" if c.isdigit() else "w" if c in " \t\r\n" else "o"
    if c == LOST:
        return "r"
    if o < 0xA0:
        return "x"
    cat = unicodedata.category(c)
    if cat in ("Cn", "Co", "Cc", "Cs"):
        return "x"
    if cat[0] == "L" or cat[0] == "M":
        if 0x3040 <= o <= 0x30FF or 0xFF66 <= o <= 0xFF9F:
            return "K"
        if 0x3400 <= o <= 0x9FFF or 0xF900 <= o <= 0xFAFF or o >= 0x20000:
            return "H"
        low = cat != "Lu"
        if o < 0x250 or 0x1E00 <= o < 0x1F00:
            return "s" if c in "ªº" else "l" if low else "L"
        if 0x400 <= o < 0x530:
            return "c" if low else "C"
        if 0x370 <= o < 0x400:
            return "g" if low else "G"
        return "u"
    if 0x2190 <= o < 0x2200 or 0x2500 <= o < 0x25A0 or o in (0x2310, 0x2320, 0x2321):
        return "b"
    if 0x3000 <= o < 0x3040 or 0xFF00 <= o < 0xFFF0 or o == 0x30FB:
        return "F"
    if o >= 0x1F000 or 0x2600 <= o < 0x27C0:
        return "e"
    if cat[0] == "P" or cat == "Pi":
        return "p"
    return "s"


def _common(c: str) -> bool:
    """Whether a han character is among the few thousand common ones, as the first levels of two national sets have them."""
    for encoding, low, high in (("gb2312", 0xB0A1, 0xD7F9), ("cp932", 0x889F, 0x9872)):
        try:
            raw = c.encode(encoding)
        except UnicodeEncodeError:
            continue
        if low <= int.from_bytes(raw, "big") <= high:
            return True
    return False


@lru_cache(maxsize=1 << 16)
def rarity(c: str) -> float:
    """What a character costs as such in clean text, before training."""
    k = kind(c)
    if ord(c) < 128:
        return 2.5 if k in "aAdw" else 3.5
    low = c.lower()
    if 0xFF61 <= ord(c) <= 0xFF9F:
        return 10.0  # half-width kana
    if k in "lL":
        cost = 3.0 if low in _OFTEN else 4.0 if ord(c) < 0x180 else 9.0
        return cost + (2.0 if k == "L" else 0.0)
    if k in "cC":
        rank = _CYRILLIC.find(low)
        return (2.1 + 0.11 * rank if rank >= 0 else 8.0) + (2.0 if k == "C" else 0.0)
    if k == "H":
        return 7.0 if _common(c) else 9.5
    if "가" <= c <= "힣":
        return 6.8
    if k == "p" and c in "’‘“”–—…«»„¿¡·•":
        return 4.0
    return {"g": 6.0, "G": 7.0, "K": 4.0, "F": 4.0, "p": 7.0, "s": 4.5 if ord(c) < 0x100 or c == "€" else 7.5, "b": 6.0, "e": 9.0, "x": 14.0, "u": 8.0, "r": LOST_CLEAN}[k]


_SCRIPT = {"a": "l", "A": "l", "l": "l", "L": "l", "c": "c", "C": "c", "g": "g", "G": "g", "K": "k", "H": "k", "u": "u"}


_ALONE = {"l": 0.5, "L": 0.5, "c": 4.0, "C": 4.0, "g": 4.0, "G": 4.0}


@lru_cache(maxsize=1 << 12)
def _fit(a: str, b: str) -> float:
    """What it costs that a character of class b follows one of class a."""
    sa, sb = _SCRIPT.get(a), _SCRIPT.get(b)
    if sa and sb:
        if sa == sb:
            rising = a in "alcg" and b in "ALCG"
            return 4.0 if rising else 0.5 if a in "lL" and b in "lL" else 0.0
        return 2.5 if "k" in (sa, sb) and "l" in (sa, sb) and a in "aAHK" and b in "aAHK" else 6.0
    if sa and b == "s":
        return 4.0
    if a == "s" and sb:
        return 1.5
    if sa and b == "b" or a == "b" and sb:
        return 4.0
    if (a == "o" and b == "b") or (a == "b" and b == "o"):
        return 2.0
    if a in "sp" and b in "sp":
        return 2.5
    if (a == "b" and b in "spF") or (b == "b" and a in "spF"):
        return 3.0
    if a == "d" and b in "lLcC" or b == "d" and a in "lLcCsb":
        return 1.5
    if "F" in (a, b) and ({a, b} & set("lLcCgGsb")):
        return 3.0
    return 0.0


class Costs(dict):
    """Cost of each character in clean text: trained ones as given, any other at its initial cost and the mixture's."""

    def __init__(self, trained: dict[str, float] | None = None):
        super().__init__(trained or {})
        self.unseen = MIX_COST if trained else 0.0

    def __missing__(self, c: str) -> float:
        out = self[c] = rarity(c) + (0.0 if ord(c) < 128 else self.unseen)
        return out


def _bytes_of(encoding: str) -> dict[str, int]:
    """Character -> byte of a single-byte encoding; bytes it leaves undefined stay control characters, as readers do."""
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            pass
    for b in range(128, 256):
        if b not in out.values():
            out.setdefault(chr(b), b)
    return out


@dataclass(frozen=True)
class State:
    """written: the true encoding; read: the wrong one; times: how often it was misread so."""

    name: str
    written: str
    read: str
    times: int = 1
    wide: bool = False


#: Encodings that text is written in and read with (fixed values). Pairs that make letters of quotation marks, dashes, Greek letters
#: or signs (mac_roman, cp437 and cp850 read as cp1252 and the reverse) are left out: character by character they explain
#: sound texts that are rich in these a little better than the clean state, which adds up.
STATES = (
    *(State(f"utf-8>{r}", "utf-8", r) for r in ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "koi8-r", "cp866", "latin-1", "iso8859-15")),
    State("utf-8>cp1252 twice", "utf-8", "cp1252", 2),
    State("utf-8>latin-1 twice", "utf-8", "latin-1", 2),
    State("utf-8>cp1252 three times", "utf-8", "cp1252", 3),
    State("utf-8>cp1251 twice", "utf-8", "cp1251", 2),
    *(State(f"{w}>{r}", w, r) for w in ("cp1251", "koi8-r", "cp866") for r in ("cp1252", "latin-1")),
    State("koi8-r>cp1251", "koi8-r", "cp1251"),
    State("cp1251>koi8-r", "cp1251", "koi8-r"),
    State("cp866>cp1251", "cp866", "cp1251"),
    *(State(f"{w}>{r}", w, r) for w in ("cp932", "gbk", "euc_jp", "big5", "euc_kr") for r in ("cp1252", "latin-1")),
    State("utf-8>gbk", "utf-8", "gbk", wide=True),
    State("utf-8>cp932", "utf-8", "cp932", wide=True),
)
_TABLES = {r: _bytes_of(r) for r in {s.read for s in STATES if not s.wide}}
_SHORT = {"cp932", "gbk", "euc_jp", "big5", "euc_kr"}


@lru_cache(maxsize=1 << 16)
def _decoded(raw: bytes, encoding: str) -> str | None:
    try:
        t = raw.decode(encoding)
    except UnicodeDecodeError:
        return None
    return t if len(t) == 1 and ord(t) >= 128 and t != LOST and not "\ue000" <= t <= "\uf8ff" else None  # no private use


def _unit(state: State, word: str, at: int, times: int) -> tuple[str, int] | None:
    """(original character, characters taken) of the unit at a position, if the state can have emitted it."""
    if times > 1:
        c, n = (lambda u: u or (None, 0))(_unit(state, word, at, times - 1)) if kind(word[at]) != "a" else (None, 0)
        if c is None:
            return None
        chars, used = [c], n
        table = _TABLES[state.read]
        lead = table.get(c)
        need = 0 if lead is None else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        while need and len(chars) < need:
            if at + used >= len(word):
                return None
            nxt = _unit(state, word, at + used, times - 1)
            if nxt is None:
                return None
            chars.append(nxt[0])
            used += nxt[1]
        if not need or any(x not in table for x in chars):
            return None
        t = _decoded(bytes(table[x] for x in chars), state.written)
        return (t, used) if t else None
    # what comes out may be a control character here; as an original it is costly
    table = _TABLES[state.read]
    lead = table.get(word[at])
    if lead is None:
        return None
    if state.written == "utf-8":
        n = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        if not n or at + n > len(word):
            return None
        rest = [table.get(c, 0) for c in word[at + 1 : at + n]]
        if any(not 0x80 <= b < 0xC0 for b in rest):
            return None
        t = _decoded(bytes([lead, *rest]), "utf-8")
        return (t, n) if t else None
    if state.written in _SHORT:
        if at + 1 < len(word):
            b = table.get(word[at + 1], ord(word[at + 1]) if word[at + 1] < "\x80" else None)
            if b is not None and b >= 0x40:
                t = _decoded(bytes([lead, b]), state.written)
                if t:
                    return t, 2
        t = _decoded(bytes([lead]), state.written)
        return (t, 1) if t else None
    t = _decoded(bytes([lead]), state.written)
    return (t, 1) if t else None


@lru_cache(maxsize=1 << 16)
def _encoded(c: str, encoding: str) -> bytes | None:
    try:
        return c.encode(encoding)
    except UnicodeEncodeError:
        return None


def _length(lead: int) -> int:
    """Bytes of the UTF-8 character of a first byte; 0 if it is none."""
    return 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0


def _sequences(raw: bytes, rest: int) -> tuple[str, bytes, int] | None:
    """(characters, bytes of an unfinished one, ``rest``) of UTF-8 bytes; None if they are none. ``rest``: so many bytes, at
    most, may still belong to a character that lost one; they are passed over."""
    out, i = "", 0
    while i < len(raw):
        lead = raw[i]
        if rest and 0x80 <= lead < 0xC0:
            rest -= 1
            i += 1
            continue
        rest = 0
        n = _length(lead)
        part = raw[i : i + n]
        if not n or any(not 0x80 <= x < 0xC0 for x in part[1:]):
            return None
        if len(part) < n:
            return out, part, 0
        try:
            c = part.decode()
        except UnicodeDecodeError:
            return None
        if kind(c) == "x":
            return None
        out += c
        i += n
    return out, b"", rest


#: Number of the state of lost characters, and of the clean state; the others are places in STATES.
GONE, SOUND = -2, -1


def name_of(state: int) -> str:
    return "lost" if state == GONE else STATES[state].name


class Model:
    """Costs of characters, of neighbours by class, and of transitions, by state."""

    def __init__(self, trained: dict | None = None):
        trained = trained or {}
        self.costs = Costs(trained.get("chars"))
        self.fits = trained.get("fits", {})
        states = [GONE, *range(len(STATES))]
        self.enter = {n: trained.get("enter", {}).get(n, ENTER if n < 0 or STATES[n].written == "utf-8" else ENTER_OLD) for n in states}
        self.leave = {n: trained.get("leave", {}).get(n, LEAVE) for n in states}
        self.stay = {n: -math.log(1 - math.exp(-c)) for n, c in self.leave.items()}
        self.steps: dict[str, float] = {}
        self.emitted: dict[tuple[str, str], tuple[float, str]] = {}

    def step(self, before: str, k: str) -> float:
        """What it costs that a character of class ``k`` follows two of classes ``before``, whatever the character."""
        key = before + k
        known = self.steps.get(key)
        if known is None:
            a, b = before
            known = self.fits.get(b + k, _fit(b, k))
            if k == "l" and b == "l" and a == "l":
                known += 1.5  # the third accented letter in a row and on
            elif k == "L" and b in "AL":
                known -= 1.5  # a capital among capitals
            if b in _ALONE and _SCRIPT.get(a) != _SCRIPT[b] != _SCRIPT.get(k):
                known += _ALONE[b]  # a letter by itself
            self.steps[key] = known
        return known

    def emit(self, before: str, c: str) -> tuple[float, str]:
        """Cost of a character after two of classes ``before``, and the classes for the next one."""
        known = self.emitted.get((before, c))
        if known is None:
            if len(self.emitted) >= MOST_KEPT:
                self.emitted.clear()
            k = kind(c)
            known = self.emitted[before, c] = (self.step(before, k) + (self.costs[c] if c >= "\x80" else 0.0), before[1] + k)
        return known

    def least(self, c: str) -> float:
        """What a character costs at least, whatever it follows."""
        return max(0.0, self.costs[c] - 1.5)


def paths(word: str, start: int, model: Model) -> dict[int, tuple[float, tuple]]:
    """Best ways through a word from a state: state at its end -> (cost, spans), a span being (state, offset, length, original).

    A mode is a state, the classes of the last two characters, and in a wide state the bytes of an unfinished character and the
    number of a lost one's to come. A mode is given up if it costs more than the clean one, entering its state anew and SLACK, or
    if with the least that the rest of the word can cost it ends above the clean path and entering its state after the word."""
    ways: list[dict | None] = [None] * (len(word) + 1)  # mode -> (cost, link)
    ways[0] = {(start, "ww", b"", 0): (0.0, None)}
    enter, leave, stay, emit = model.enter, model.leave, model.stay, model.emit

    def go(at: int, mode: tuple, total: float, link: tuple | None) -> None:
        there = ways[at]
        if there is None:
            there = ways[at] = {}
        if mode not in there or total < there[mode][0]:
            there[mode] = (total, link)

    i, n = 0, len(word)
    first = next((j for j, c in enumerate(word) if c >= "\x80"), n)
    units: list[dict | None] = [_units(word, j) if c >= "\x80" else None for j, c in enumerate(word)]
    wide = any(u is not None and any(STATES[o].wide for o in u) for u in units)
    rest_of = [0.0] * (n + 1)
    for j in range(n - 1, -1, -1):
        if units[j] is None:
            rest_of[j] = rest_of[j + 1]
        else:
            c = word[j]
            low = min(model.least(c), 1.0) if wide or c == LOST else model.least(c)
            rest_of[j] = min([low + rest_of[j + 1], *(model.least(u[0]) + rest_of[j + u[1]] for u in units[j].values() if u is not None)])
    limit, before = model.leave[start] if start != SOUND else 0.0, "ww"
    for c in word:
        more, before = emit(before, c)
        limit += more
    limit += model.step(before, "w") + 1e-9
    # a path in one state throughout bounds the clean end as well
    for s in {o for u in units if u for o, x in u.items() if x is not None} if limit > ENTER else ():
        total, before, j = leave[s] + 1e-9 + (0.0 if s == start else enter[s] + (leave[start] if start != SOUND else 0.0)), "ww", 0
        while j < n and total < limit:
            u = units[j].get(s) if units[j] is not None else None
            more, after = emit(before, u[0] if u else word[j])
            total += more + (stay[s] if u else ODD if units[j] is not None else 0.0)
            before, j = after, j + (u[1] if u else 1)
        limit = min(limit, total + model.step(before, "w")) if j >= n else limit
    while i < n:
        inside = INSIDE if i > first else 0.0
        here = ways[i]
        if here is None:
            i += 1
            continue
        ways[i] = None
        c = word[i]
        # transitions: to the clean state from any that is between two units, and from there on into others
        for (s, before, part, _), (total, link) in list(here.items()):
            if s != SOUND and not part:
                sound, out = (SOUND, before, b"", 0), total + leave[s] + inside
                if sound not in here or out < here[sound][0]:
                    here[sound] = (out, link)
        base = min((w[0] for m, w in here.items() if m[0] == SOUND), default=None)
        if base is not None:
            low = min(base + SLACK, limit - rest_of[i])
            for mode in [m for m, w in here.items() if w[0] > low + (enter[m[0]] if m[0] != SOUND else 0.0)]:
                del here[mode]
        if c < "\x80":
            end = i + 1
            while end < n and word[end] < "\x80" and ways[end] is None:  # a unit may end amid ASCII, which its second byte can be
                end += 1
            last = end == n or word[end] >= "\x80"
            tail = kind(word[end - 2]) + kind(word[end - 1]) if last and end - i > 1 else None
            for (s, before, part, _), (total, link) in here.items():
                if s != SOUND and part:
                    continue  # a character broken off
                for x in word[i : min(end, i + 2) if last else end]:  # from the third on the classes before are the same in all modes
                    more, before = emit(before, x)
                    total += more
                go(end, (s, tail or before, b"", 0), total, link)
            i = end
            continue
        found = units[i]
        for (s, before, _, _), (total, link) in list(here.items()):
            if s == SOUND:
                for o in (*((GONE,) if c == LOST else ()), *found):
                    mode, into = (o, before, b"", 0), total + enter[o] + inside
                    if into + rest_of[i] < limit + enter[o] and (mode not in here or into < here[mode][0]):
                        here[mode] = (into, link)
        for (s, before, part, rest), (total, link) in here.items():
            if s == SOUND:
                more, after = emit(before, c)
                go(i + 1, (s, after, b"", 0), total + more, link)
            elif s == GONE:
                if c == LOST:
                    go(i + 1, (s, before[1] + "r", b"", 0), total + LOST_GARBLED, (link, s, i, 1, LOST))
            elif not STATES[s].wide:
                u = found.get(s)
                if u is not None:
                    more, after = emit(before, u[0])
                    go(i + u[1], (s, after, b"", 0), total + more + stay[s], (link, s, i, u[1], u[0]))
                more, after = emit(before, c)
                go(i + 1, (s, after, b"", 0), total + more + (ODD if u is None else ODD_UNIT), link)
            elif c == LOST:
                rest = _length(part[0]) - len(part) - 1 if part else rest - 1 if rest else 2
                go(i + 1, (s, before[1] + "r", b"", rest), total + LOST_GARBLED, (link, s, i, 1, LOST))
            elif (raw := _encoded(c, STATES[s].read)) is not None and (read := _sequences(part + raw, rest)) is not None:
                for x in read[0]:
                    more, before = emit(before, x)
                    total += more + stay[s]
                go(i + 1, (s, before, read[1], read[2]), total, (link, s, i, 1, read[0]))
        i += 1
    out: dict[int, tuple[float, tuple | None]] = {}
    for (s, before, part, _), (total, link) in (ways[n] or {}).items():
        total += model.step(before, "w")
        if not part and (s not in out or total < out[s][0]):
            out[s] = (total, link)
    for s, (total, link) in list(out.items()):
        if s != SOUND and (SOUND not in out or total + leave[s] < out[SOUND][0]):
            out[SOUND] = (total + leave[s], link)
    return {s: (total, _spans(link)) for s, (total, link) in out.items() if s == SOUND or total < out[SOUND][0] + enter[s]}


#: Number of the state of each pair, read once, twice and three times.
_DEEPER = {n: tuple(m for m, t in enumerate(STATES) if (t.written, t.read) == (s.written, s.read) and t.times > 1) for n, s in enumerate(STATES) if s.times == 1 and not s.wide}


@lru_cache(maxsize=1 << 17)
def _plain_units(piece: str) -> dict[int, tuple[str, int] | None]:
    """State -> unit (original character, characters taken) at the start of a piece; for wide states, whose units depend on what
    came before, None."""
    out: dict[int, tuple[str, int] | None] = {}
    for n, s in enumerate(STATES):
        if s.wide:
            if piece[0] != LOST and (raw := _encoded(piece[0], s.read)) is not None and _sequences(raw, 0) is not None:
                out[n] = None
        elif s.times == 1 and (u := _unit(s, piece, 0, 1)) is not None:
            out[n] = u
    return out


def _units(word: str, at: int) -> dict[int, tuple[str, int] | None]:
    """The same at a place of a word, with states of texts read twice and more: these need a unit of the text read once."""
    plain = _plain_units(word[at : at + 4])
    deeper = {m: u for n in plain for m in _DEEPER.get(n, ()) if (u := _unit(STATES[m], word, at, STATES[m].times)) is not None}
    return {**plain, **deeper} if deeper else plain


def _spans(link: tuple | None) -> tuple:
    """Units of a path as spans: units of one state that touch are one span. Spans of which more is lost than known are lost."""
    units = []
    while link is not None:
        link, *unit = link
        units.append(unit)
    out: list[list] = []
    for s, at, length, text in reversed(units):
        if out and out[-1][0] == s and out[-1][1] + out[-1][2] == at:
            out[-1][2] += length
            out[-1][3] += text
        else:
            out.append([s, at, length, text])
    return tuple(tuple(x) for x in out)


class Words(dict):
    """(word, state it is entered in) -> its paths."""

    def __init__(self, model: Model | None = None):
        super().__init__()
        self.model = Model() if model is None else model

    def __missing__(self, key: tuple[str, int]):
        out = paths(*key, self.model)
        if len(key[0]) <= LONGEST_KEPT:
            if len(self) >= MOST_KEPT:
                self.clear()
            self[key] = out
        return out


def words_of(text: str) -> list[tuple[int, str]]:
    """(offset, word) of the blank-separated words with characters beyond ASCII."""
    out, at = [], 0
    for line in text.split("\n"):
        if not line.isascii():
            p = at
            for w in line.split(" "):
                if not w.isascii():
                    out.append((p, w))
                p += len(w) + 1
        at += len(line) + 1
    return out


def label(text: str, words: Words) -> list[tuple[str, int, int, str]]:
    """Garbled spans of a text: (state, offset, length, original), from the Viterbi path over its characters."""
    enter = words.model.enter
    best: dict[int, tuple[float, tuple | None]] = {SOUND: (0.0, None)}
    for at, w in words_of(text):
        new: dict[int, tuple[float, tuple | None]] = {}
        for s, (total, link) in best.items():
            for end, (more, spans) in words[w, s].items():
                if end not in new or total + more < new[end][0]:
                    new[end] = (total + more, (link, at, spans) if spans else link)
        low = new[SOUND][0]
        best = {s: w for s, w in new.items() if s == SOUND or w[0] < low + enter[s]}
    link, out = min(best.values(), key=lambda w: w[0])[1], []
    while link is not None:
        link, at, spans = link
        out += [(name_of(s), at + p, n, t) for s, p, n, t in reversed(spans)]
    return out[::-1]


def restore(text: str, labels: list[tuple[str, int, int, str]]) -> str:
    out, at = [], 0
    for _, p, n, t in labels:
        out += [text[at:p], t]
        at = p + n
    return "".join([*out, text[at:]])


_WORDS: dict[str, Words] = {}


def _words(sent) -> Words:
    """This worker's remembered words under a sent model (None: the initial one)."""
    text = "" if sent is None else sent.value
    if text not in _WORDS:
        _WORDS.clear()
        _WORDS[text] = Words(Model(_read(text) if text else None))
    return _WORDS[text]


def _read(text: str) -> dict:
    d = json.loads(text)
    return {k: {int(n): c for n, c in v.items()} if k in ("enter", "leave") else v for k, v in d.items()}


def _mixed(initial: float, share: float) -> float:
    """Cost of an even mixture of an initial and a counted probability."""
    return -math.log((1 - TRAINED_SHARE) * math.exp(-initial) + TRAINED_SHARE * min(1.0, share))


def trained(counts: dict[tuple[str, str], int]) -> dict:
    """Model parameters from counts: ``c`` characters of clean stretches in words beyond ASCII, ``p`` pairs of classes there, and per
    state ``e`` entered, ``u`` units emitted, ``l`` left."""
    of: dict[str, dict[str, int]] = {w: {} for w in "cpeul"}
    for (what, x), n in counts.items():
        of[what][x] = n
    total = sum(of["c"].values())
    if not total:
        return {}
    first, second = Counter(), Counter()
    for pair, n in of["p"].items():
        first[pair[0]] += n
        second[pair[1]] += n
    pairs = sum(first.values())
    plain = Model()
    return {
        "chars": {c: _mixed(rarity(c), n / total) for c, n in of["c"].items() if ord(c) >= 128 and c != LOST},
        # how much likelier two classes are side by side than apart; classes that are ASCII both are alike in all states
        "fits": {a + b: _mixed(_fit(a, b), of["p"].get(a + b, 0) * pairs / (first[a] * second[b])) for a in first for b in second if not (a in _PLAIN and b in _PLAIN)},
        "enter": {n: _mixed(c, of["e"].get(str(n), 0) / total) for n, c in plain.enter.items()},
        "leave": {n: _mixed(c, of["l"].get(str(n), 0) / of["u"][str(n)]) for n, c in plain.leave.items() if of["u"].get(str(n))},
    }


_PLAIN = "aAdwo"


def count(text: str, words: Words, counts: Counter, clean: Counter) -> None:
    """Adds a text's path to the counts; words that are clean throughout go to ``clean``, to be counted once with their number."""
    spans: dict[int, list] = {}
    starts = words_of(text)
    labels = label(text, words)
    at = 0
    for s, p, n, t in labels:
        while at + 1 < len(starts) and starts[at + 1][0] <= p:
            at += 1
        spans.setdefault(at, []).append((s, p - starts[at][0], n, t))
    last, end = None, -1
    for s, p, n, t in labels:
        number = str(_NUMBERS[s])
        if s != last or not text[end:p].isascii():
            counts["e", number] += 1
            counts["l", number] += 1
        counts["u", number] += len(t)
        last, end = s, p + n
    for i, (_, w) in enumerate(starts):
        if i not in spans:
            clean[w] += 1
            continue
        p = 0
        for _, q, n, _ in [*spans[i], (None, len(w), 0, None)]:
            _characters(w[p:q], 1, counts)
            p = q + n


def _characters(stretch: str, n: int, counts: Counter) -> None:
    """A clean stretch's characters, and pairs of classes within it."""
    if stretch.isascii():
        return
    before = None
    for c in stretch:
        counts["c", c] += n
        k = kind(c)
        if before is not None:
            counts["p", before + k] += n
        before = k


def _add(counts: Counter, clean: Counter) -> None:
    for w, n in clean.items():
        _characters(f" {w} ", n, counts)
        counts["c", " "] -= 2 * n  # the blanks are there for the pairs
    clean.clear()


_NUMBERS = {name_of(n): n for n in (GONE, *range(len(STATES)))}


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS) -> dict:
    """Viterbi training over all texts. Counts are summed in every task before the shuffle; what reaches the driver is a row per
    distinct character, pair of classes and state, of which there are fewer than the registry limit."""

    def run_with(sent):
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, counts, clean = _words(sent), Counter(), Counter()
            for batch in it:
                for t in batch.column(0).to_pylist():
                    if t and not t.isascii():
                        count(t, words, counts, clean)
                if len(clean) > MOST_KEPT:
                    _add(counts, clean)
            _add(counts, clean)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["what", "x", "n"])

        return run

    ship(docs.sparkSession)
    out: dict = {}
    for _ in range(rounds):
        rows = spread(docs.select(text)).mapInArrow(run_with(_sent(docs, out)), "what string, x string, n long").groupBy("what", "x").sum("n").toDF("what", "x", "n")
        out = trained({(r.what, r.x): r.n for r in registry_rows(rows) if r.n > 0})
        if not out:
            break
    return out


def _sent(docs: DataFrame, parameters: dict):
    """The model's parameters as a broadcast: a number per distinct character, pair of classes and state."""
    return docs.sparkSession.sparkContext.broadcast(json.dumps(parameters)) if parameters else None


OUT = "`{key}` {kind}, n_spans int, states array<string>, whole boolean, restored string"


def repair(docs: DataFrame, key: str = "doc_id", text: str = "text", training: bool = True) -> DataFrame:
    """A row per garbled text: key, n_spans (garbled spans), states (encoding pairs met), whole (nothing of it is lost),
    restored (the text with every span's inverse transform applied).

    Null, empty and ASCII texts have no row. Whole texts are read, of any length; rows repeat as they come; other columns
    aren't read. The model is trained on the same texts first, unless ``training`` is off."""
    k = dict(docs.dtypes)[key]
    sent = _sent(docs, train(docs, text) if training else {})

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(sent)
        for batch in it:
            rows = []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if t and not t.isascii() and (labels := label(t, words)):
                    fixed = restore(t, labels)
                    rows.append((i, len(labels), sorted({x[0] for x in labels}), LOST not in fixed, fixed))
            take = pa.array([r[0] for r in rows], pa.int64())
            cols = [pa.array([r[j] for r in rows], kind_) for j, kind_ in ((1, pa.int32()), (2, pa.list_(pa.string())), (3, pa.bool_()), (4, pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), *cols], names=[key, "n_spans", "states", "whole", "restored"])

    ship(docs.sparkSession)
    return spread(docs.select(key, text)).mapInArrow(run, OUT.format(key=key, kind=k))


def found(docs: DataFrame) -> DataFrame:
    return repair(docs).select("doc_id")
