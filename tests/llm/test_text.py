"""Encoding, mixing and garbled text: against the libraries, brute force and planted cases."""

import os
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import automaton, encoding, garbled, mixing

FOLDER = encoding.TOKENIZERS
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tokenizer files")


@pytest.fixture(scope="module")
def encoder():
    with open(f"{FOLDER}/{encoding.TOKENIZER}", "rb") as f:
        return automaton.Encoder(f.read())


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{FOLDER}/{encoding.TOKENIZER}")
    t.encode_special_tokens = True
    return t


# ------------------------------------------------------------------------------------------ 6


def merged(word, merges):
    """Merges applied one after another, the lowest rank first, leftmost first."""
    parts = list(word)
    rank = {(a, b): i for i, (a, b, _) in enumerate(merges)}
    to = {(a, b): w for a, b, w in merges}
    while True:
        best = min((rank[p] for p in zip(parts, parts[1:], strict=False) if p in rank), default=None)
        if best is None:
            return tuple(parts)
        out, i = [], 0
        while i < len(parts):
            p = tuple(parts[i : i + 2])
            if len(p) == 2 and rank.get(p) == best:
                out.append(to[p])
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out


@settings(max_examples=200, deadline=None)
@given(st.randoms(use_true_random=False))
def test_automaton_of_random_merges_equals_merging(rnd):
    """Merges of any kind, repeated letters and unreachable tokens among them."""
    pieces, merges = {i: bytes([97 + i]) for i in range(3)}, []
    for _ in range(rnd.randint(0, 12)):
        a, b = rnd.choice(sorted(pieces)), rnd.choice(sorted(pieces))
        new = pieces[a] + pieces[b]
        if new not in pieces.values() and len(new) <= 8:
            pieces[len(pieces)] = new
            merges.append((a, b, len(pieces) - 1))
    auto = automaton.Automaton(pieces, merges)
    for _ in range(30):
        word = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 14)))
        want = merged([c - 97 for c in word], merges)
        got = auto.encode(word)
        assert got == want, (word, merges)
        assert auto.decode(got) == word


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_encoder_equals_library(encoder, library, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = list(encoder.ids(text))
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert encoder.count(text) == len(ids)
    assert encoder.decode(ids) == text


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 3000, "-=" * 2500, "日本" * 2000, "\r\n" * 500, "don't I'LL 's", "<|endoftext|>", "\x1c \x1f\x85\xa0　x", "½٣Ⅷ é"])
def test_long_and_odd_texts(encoder, library, text):
    assert list(encoder.ids(text)) == library.encode(text, add_special_tokens=False).ids


def test_encode_column(spark, library):
    rows = [(1, "", "x"), (2, None, "x"), (3, "  \n", "x"), (4, "héllo wörld", "x"), (4, "héllo wörld", "x"), (None, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    sent = encoding.vocabulary(spark)
    out = encoding.encode(df, sent)
    assert out.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    got = out.collect()
    assert sorted((repr(r.doc_id), tuple(r.ids)) for r in got) == sorted((repr(i), tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    back = {r.doc_id: r.text for r in encoding.decode(out, sent).collect()}
    assert back[4] == "héllo wörld" and back[3] == "  \n" and back[2] == ""
    assert encoding.encode(df.limit(0), sent).collect() == []
    counts = {r.doc_id: r.n_tokens for r in encoding.token_counts(df, sent, ["doc_id"]).collect()}
    assert counts[1] == counts[2] == 0 and counts[None] == 1
    with pytest.raises(FileNotFoundError):
        encoding.vocabulary(spark, FOLDER, "none.json")


# ------------------------------------------------------------------------------------------ 7


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(0, 100), min_size=1, max_size=7), st.integers(0, 150), st.booleans(), st.randoms(use_true_random=False))
def test_apportionment_equals_brute_force(weights, seats, capped, rnd):
    caps = [rnd.randint(0, 40) for _ in weights] if capped else None
    held = [0] * len(weights)
    for _ in range(seats):
        open_ = [(weights[i] / (2 * held[i] + 1), -i) for i in range(len(weights)) if weights[i] > 0 and (caps is None or held[i] < caps[i])]
        if not open_:
            break
        held[-max(open_)[1]] += 1
    assert mixing.sainte_lague(weights, seats, caps) == held


MIX = "mix_name string, corpus_ratio double, source string, target_share double, max_repeats int"


def test_mix_meets_its_shares(spark):
    rnd = random.Random(2)
    docs = [(i, rnd.choice(["big"] * 8 + ["mid"] * 3 + ["small", None]), rnd.randint(0, 200), "x", "x") for i in range(6000)]
    counts = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint, shard string, quota string").drop("shard", "quota")
    corpus = sum(d[2] for d in docs)
    targets = spark.createDataFrame([("a", 0.5, "big", 0.5, 1), ("a", 0.5, "mid", 0.25, 2), ("a", 0.5, "small", 0.15, 3), ("a", 0.5, "none", 0.1, 5), ("b", 3.0, "small", 1.0, 2), (None, 1.0, "big", 1.0, 1)], MIX)
    chosen, shares = mixing.choose(counts, targets, shard_docs=500)
    rows, by = chosen.collect(), defaultdict(int)
    tokens = {d[0]: d[2] for d in docs}
    assert all(tokens[r.doc_id] == r.n_tokens > 0 for r in rows)
    assert len({(r.mix_name, r.doc_id) for r in rows}) == len(rows)
    for r in rows:
        by[r.mix_name, r.source] += r.n_tokens * r.repeats
    got = {(r.mix_name, r.source): r for r in shares.collect()}
    for source, most in (("big", 1), ("mid", 2)):
        r = got["a", source]
        assert r.actual_tokens == by["a", source] and abs(r.actual_tokens - r.target_tokens) < 0.02 * r.target_tokens and r.reached
        assert max(x.repeats for x in rows if (x.mix_name, x.source) == ("a", source)) <= most
    have = sum(d[2] for d in docs if d[1] == "small")
    assert by["a", "small"] == min(3 * have, by["a", "small"]) and got["b", "small"].actual_tokens == 2 * have and not got["b", "small"].reached
    assert got["a", "none"].actual_tokens == 0 and got["a", "none"].target_tokens == int(0.1 * 0.5 * corpus)
    again = {tuple(r) for r in mixing.choose(counts.repartition(3), targets, shard_docs=500)[0].collect()}
    assert again == {tuple(r) for r in rows}
    other = {tuple(r) for r in mixing.choose(counts, targets, seed=1, shard_docs=500)[0].collect()}
    assert other != again


def test_parts_deal_to_shards(spark):
    """Two steps meet the targets as one does, and no document comes too often."""
    import random

    assert mixing.deal([10, 20, 30], 60, 1) == [10, 20, 30] and mixing.deal([10, 10], 100, 2) == [20, 20]
    assert sum(mixing.deal([100, 300, 600], 500, 1)) == pytest.approx(500, rel=0.05)
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a", "a", "a", "b"]), rnd.randint(1, 50)) for i in range(4000)]
    counts = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("m", 0.5, "a", 0.3, 1), ("m", 0.5, "b", 0.7, 2)], MIX)
    for parts in (4096, 4):
        chosen, shares = mixing.choose(counts, targets, shard_docs=100, most_parts=parts)
        assert all(abs(r.actual_tokens - r.target_tokens) < 0.03 * r.target_tokens for r in shares.collect()), parts
        got = chosen.collect()
        assert len({r.doc_id for r in got}) == len(got) and max(r.repeats for r in got) <= 2


def test_mix_of_nothing(spark):
    counts = spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, "big", 1.0, 1), ("n", None, "big", None, None)], MIX)
    chosen, shares = mixing.choose(counts, targets)
    assert chosen.collect() == [] and all(r.actual_tokens == 0 for r in shares.collect())
    assert mixing.choose(counts, targets.limit(0))[0].collect() == []


# ------------------------------------------------------------------------------------------ 8

CLEAN = [
    "Größe überschritten, Übersicht für alle Gäste", "préparé par l’équipe; déjà prêt — à revoir", "Só acontece após 640 execuções. ATENÇÃO: NÃO USAR", "żółta łódź, Wcześniej trwało to", "Исправлена ошибка в модуле catalog. ВСЁ ГОТОВО",
    "二つ目の分岐にはまだテストがない。使われていない設定を削除", "此次修改只影响 tokeniser。关闭 #3330。", "The “fast” path wasn’t fast: 3232 µs per row… €5", '"Ã" and "Õ" stay upper case; "Â" "â" ÄÖÜ = "ÄÖÜ"', "│ limit │ ──┐ ├── └──", "© row ® limit § 368 ±5 ×18 498 °C", "\\u00e9 &eacute; %C3%A9 =C3=A9 \\xc3\\xa9", "Ödön Faluvár 織田川 みろ Мелана 🎉 ← →",
]


def misread(text, written, read):
    """Decoded with the wrong encoding, bytes it leaves undefined kept as control characters."""
    out = []
    for b in text.encode(written):
        try:
            out.append(bytes([b]).decode(read))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@pytest.mark.parametrize("text", [*CLEAN, "", "ascii only", "x" * 200_000 + "é"])
def test_clean_texts_stay(text):
    assert garbled.label(text, garbled.Words()) == []


PAIRS = [("utf-8", r) for r in ("cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437")]


@pytest.mark.parametrize(("written", "read"), PAIRS)
@pytest.mark.parametrize("text", CLEAN[:4] + CLEAN[5:8])
def test_garbled_texts_are_restored(text, written, read):
    bad = f"plain words before\n{misread(text, written, read)}\nand clean é after\n"
    labels = garbled.label(bad, garbled.Words())
    assert labels
    assert garbled.restore(bad, labels) == f"plain words before\n{text}\nand clean é after\n"


@pytest.mark.parametrize(("text", "written", "read"), [(CLEAN[4], "koi8-r", "cp1251"), (CLEAN[4], "cp1251", "cp1252"), (CLEAN[5], "cp932", "cp1252"), (CLEAN[6], "gbk", "latin-1")])
def test_older_pairs_are_found(text, written, read):
    bad = misread(text, written, read)
    labels = garbled.label(bad, garbled.Words())
    assert labels
    back = garbled.restore(bad, labels)
    assert sum(a == b for a, b in zip(back, text, strict=False)) > 0.75 * len(text)


def test_twice_lost_and_wide():
    twice = misread(misread("Größe é für Łódź", "utf-8", "cp1252"), "utf-8", "cp1252")
    labels = garbled.label(twice, garbled.Words())
    assert garbled.restore(twice, labels) == "Größe é für Łódź"
    assert garbled.label("Gr��e c�digo", garbled.Words())[0][0] == "lost"
    wide = "加快列表加载速度".encode().decode("gbk")
    assert garbled.restore(wide, garbled.label(wide, garbled.Words())) == "加快列表加载速度"


def test_repair_column(spark):
    good = "Größe überschritten"
    bad = misread(good, "utf-8", "cp1252")
    rows = [(1, good, "x"), (2, bad, "x"), (3, None, "x"), (4, "", "x"), (5, "Gr��e", "x"), (2, bad, "x"), (None, bad, "x"), (6, "word " * 50_000 + bad, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, states string")
    got = garbled.repair(df).collect()
    assert sorted((repr(r.doc_id), r.whole) for r in got) == [("2", True), ("2", True), ("5", False), ("6", True), ("None", True)]
    assert all(r.restored == good for r in got if r.doc_id == 2) and got[0].states
    assert sorted(r.doc_id for r in garbled.found(df.where("doc_id is not null")).collect()) == [2, 2, 5, 6]
    assert garbled.found(df.limit(0)).collect() == []


def test_training_counts_what_is_clean(spark):
    bad = misread(CLEAN[0], "utf-8", "cp1252")
    rows = [(i, t) for i, t in enumerate([*CLEAN * 5, bad, None, ""])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = garbled.train(df, rounds=1)
    counts, pairs = defaultdict(int), defaultdict(int)
    for t in CLEAN * 5:
        for _, w in garbled.words_of(t):
            for c in w:
                counts[c] += 1
            for x, y in zip(f" {w}", f"{w} ", strict=True):
                pairs[garbled.kind(x) + garbled.kind(y)] += 1
    of_pairs = {("c", c): n for c, n in counts.items()} | {("p", p): n for p, n in pairs.items()}
    want = garbled.trained(of_pairs)
    assert model["chars"] == pytest.approx(want["chars"], rel=1e-3)
    assert "Ÿ" not in model["chars"] and model["chars"]["ö"] < garbled.rarity("ö") + garbled.MIX_COST
    written = [n for n, s in enumerate(garbled.STATES) if s.name == "utf-8>cp1252"][0]
    other = [n for n, s in enumerate(garbled.STATES) if s.name == "utf-8>cp850"][0]
    assert model["enter"][written] < model["enter"][other] and written in model["leave"] and other not in model["leave"]
    for training in (True, False):
        assert [r.doc_id for r in garbled.repair(df, training=training).collect()] == [len(CLEAN) * 5]
    assert garbled.train(df.limit(0)) == {} and garbled.train(df.where("text = ''")) == {}


def fixed(text):
    return garbled.restore(text, garbled.label(text, garbled.Words()))


@pytest.mark.parametrize(
    ("bad", "good"),
    [
        ("Ã©té_été", "été_été"),  # one garbled letter among accents, in a word
        ("été_dÃ©jÃ\xa0_été", "été_déjà_été"),
        (misread("Größe", "utf-8", "cp1252") + "/" + misread("загрузка", "utf-8", "cp1251"), "Größe/загрузка"),  # two encodings in a word
        (misread("проверка", "utf-8", "cp1251") + "," + misread("この設定", "utf-8", "cp1252") + ",naïve", "проверка,この設定,naïve"),
        ("使われていない設定を削除。" + misread("二つ目の分岐にはまだテスト", "utf-8", "cp1252") + "。使われていない設定", "使われていない設定を削除。二つ目の分岐にはまだテスト。使われていない設定"),  # no blanks at all
        ("Gr��e" + misread("Größe", "utf-8", "cp1252"), "Gr��eGröße"),
    ],
)
def test_spans_are_cut_at_characters(bad, good):
    assert fixed(bad) == good and fixed(good) == good


@pytest.mark.parametrize(
    "text",
    ["‘one’ “two” — three… ", "„eins“ – zwei‚ ‘drei’ ", "α β Γ π Σ σ µ τ Φ Θ Ω δ φ ε ", "±5 ×18 ÷2 ½ ¼ ² ³ 20 °C § 3 ", "Šest žen, „šuma“ i „žito“, što je još ", "PREMIÈRE ÉTAPE À REVOIR, ÇA ÔTE ", "à é è ó ", "안녕하세요 세계 이번 변경은 ", "此次修改只影響設定，刪除沒有使用的選項。", "• item † note ‡ other ‰ ™ "],
)
def test_sound_texts_rich_in_odd_characters_stay(text):
    """Small gains over many characters don't add up to a garbled stretch."""
    assert garbled.label(text * 300, garbled.Words()) == []


@pytest.mark.parametrize(
    ("text", "written", "read"),
    [("이번 변경은 설정만 수정합니다. 테스트가 아직 없습니다", "euc_kr", "cp1252"), ("此次修改只影響設定，刪除沒有使用的選項。", "big5", "latin-1"), ("此次修改只影响配置，删除没有使用的选项。", "gbk", "cp1252")],
)
def test_more_pairs_are_restored(text, written, read):
    assert fixed(misread(text, written, read)) == text


def test_cyrillic_misread_twice():
    text = "Исправлена ошибка в модуле"
    assert fixed(misread(misread(text, "utf-8", "cp1251"), "utf-8", "cp1251")) == text


def test_paths_are_exact():
    """Against all labellings of short words, one by one."""
    from itertools import product

    model = garbled.Model()
    states = [garbled.SOUND, *(n for n, s in enumerate(garbled.STATES) if s.name in ("utf-8>cp1252", "cp1251>cp1252"))]

    def brute(word):
        best = {}

        def walk(at, state, before, total, out):
            if at == len(word):
                total += model.step(before, "w")
                key = state
                if key not in best or total < best[key][0]:
                    best[key] = (total, out)
                return
            c, first = word[at], next(j for j, x in enumerate(word) if x >= "\x80")
            if c < "\x80":
                more, after = model.emit(before, c)
                walk(at + 1, state, after, total + more, out + c)
                return
            inside = garbled.INSIDE if at > first else 0.0
            for s in states:
                move = 0.0
                if s != state:
                    move += (model.leave[state] + inside if state != garbled.SOUND else 0.0) + (model.enter[s] + inside if s != garbled.SOUND else 0.0)
                u = garbled._unit(garbled.STATES[s], word, at, 1) if s != garbled.SOUND else None
                if s != garbled.SOUND and s != state and u is None:
                    continue
                more, after = model.emit(before, c)
                walk(at + 1, s, after, total + move + more + (0.0 if s == garbled.SOUND else garbled.ODD if u is None else garbled.ODD_UNIT), out + c)
                if u is not None:
                    more, after = model.emit(before, u[0])
                    walk(at + u[1], s, after, total + move + more + model.stay[s], out + u[0])

        walk(0, garbled.SOUND, "ww", 0.0, "")
        return min(best.values())

    alphabet = ["Ã©", "é", "x", "ï", "Ñ", "Ã", "¼"]
    for k in (1, 2, 3, 4):
        for parts in product(alphabet, repeat=k):
            word = "".join(parts)
            if word.isascii() or len(word) > 5:
                continue
            found = {s: w for s, w in garbled.paths(word, garbled.SOUND, model).items()}
            shown = [p for w in found.values() for p in w[1]]
            if any(s not in states for s, *_ in shown):
                continue  # explained by a state that isn't among the three
            total, text = brute(word)
            mine, spans = min(found.values())
            assert mine <= total + 1e-9 and garbled.restore(word, [("", p, n, t) for _, p, n, t in spans]) == text, word


def test_queries_run(spark, sf):
    from millrace.llm import queries

    for name, f in queries.QUERIES.items():
        assert f(spark, sf).count() > 0, name


@pytest.mark.parametrize("read", ["gbk", "cp932", "cp1252", "latin-1"])
def test_garbled_text_joined_to_clean(read):
    scores = garbled.Words()
    fixed = lambda t: garbled.restore(t, garbled.label(t, scores))
    before, after = "修改：", "，已经完成了全部的工作。今天也没有其他的问题需要我们继续处理"
    for original in ("更新文档内容", "更新文档内容以及测"):  # an even and an odd number of bytes
        garbage = original.encode().decode(read, "replace")
        alone = fixed(garbage)
        assert alone[:2] == original[:2]
        assert fixed(before + garbage) == before + alone
        assert fixed(garbage + after) == alone + after
        assert fixed(before + garbage + after) == before + alone + after
    assert fixed(before + after) == before + after


@pytest.mark.parametrize(
    ("text", "written", "read"),
    [("温度±5以内、誤差±12以内", "cp932", "latin-1"), ("再起動しても同じ結果になる。#2581", "cp932", "cp1252"), ("設定ソ123と表456を確認", "cp932", "latin-1"), ("設定の表1234と再起動の表5678を確認、能力10と20", "cp932", "cp1252"), ("資料庫功能異常123功456", "big5", "cp1252")],
)
def test_units_that_end_amid_ascii(text, written, read):
    """The second byte of a character can be ASCII, and more ASCII can follow it."""
    bad = misread(text, written, read)
    assert garbled.restore(bad, garbled.label(bad, garbled.Words())) == text


def test_every_word_has_a_clean_end():
    """From any state, also where ASCII follows a unit's second byte; the path in that state costs no more than its units."""
    from itertools import product

    model = garbled.Model()
    state = next(n for n, s in enumerate(garbled.STATES) if s.name == "cp932>latin-1")
    for parts in product(["\x81}", "\x95\\", "}", "54", "é"], repeat=3):
        word = "".join(parts)
        if word.isascii():
            continue
        for start in (garbled.SOUND, garbled.GONE, *range(len(garbled.STATES))):
            assert garbled.SOUND in garbled.paths(word, start, model), (word, start)
    total, before = 0.0, "ww"
    for c in "±54":
        more, before = model.emit(before, c)
        total += more + (model.stay[state] if c == "±" else 0.0)
    assert garbled.paths("\x81}54", state, model)[state][0] <= total + model.step(before, "w") + 1e-9
