import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomwork.llm import mixing, sentences, tokens

ENCODER = tokens.encoder(tokens.vocabulary_path())
PARTS = ["a", "b", " ", "  ", "\n", "\r\n", "'", "s", "'s", "'re", "t", "12", ".", "--", "é", "漢字", " ", "🙂", "_", "aaaa", "th", "ing", "A"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40), st.integers(1, 9))
def test_tree_concatenation_is_exact(parts, size):
    text = "".join(parts)
    pieces = [ENCODER.piece(text[i : i + size]) for i in range(0, len(text), size)]
    assert ENCODER.join_all(pieces).ids == ENCODER.encode(text)


def test_unbroken_runs():
    rng = random.Random(1)
    for alphabet in ("a", "ab", "ACGT", "=-", "漢字仮"):
        text = "".join(rng.choice(alphabet) for _ in range(30000))
        pieces = [ENCODER.piece(text[i : i + 4096]) for i in range(0, len(text), 4096)]
        assert ENCODER.join_all(pieces).ids == ENCODER.encode(text)


def test_corpus(spark):
    texts = [None, "", " ", "<|endoftext|> is text", "x" * 5000, "word " * 3000, "déjà vu\r\n" * 900, "short", "short"]
    rows = [(i, t, "c") for i, t in enumerate(texts)] + [(None, "no id", "c"), (4, "y" * 4001, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    want = sorted(((i, ENCODER.encode(t)) for i, t, _ in rows), key=str)
    for fan_in in (2, 64):
        got = sorted(((r.doc_id, r.ids) for r in tokens.encode_corpus(df, piece_chars=700, fan_in=fan_in).collect()), key=str)
        assert got == want
    counts = tokens.token_counts(df, ["doc_id", "ids"]).collect()
    assert sorted(((r.doc_id, r.ids, r.n_tokens) for r in counts), key=str) == sorted(((i, c, len(ENCODER.encode(t))) for i, t, c in rows), key=str)
    assert tokens.encode_corpus(df.filter("false")).count() == 0


def cut(text):
    return [text[a:b] for a, b in sentences.units(text)]


@pytest.mark.parametrize(
    "units",
    [
        ["Dr. Velmar saw Mr. Lee at 6 p.m. in the U.K. with 3.5 kg, etc. and left.", "He slept."],
        ['"Is it safe?" asked Lee.', "It was.", 'He said "Go!" and went.', 'The log reads "All done."', "Next one!"],
        ["Wait ... the lock is held.", "It failed again...", "A new try?", "read_block returns early.", "x.sort() is called."],
        ["See Fig. 3 and No. 7.", "J. K. Lee came (it was late.)", "Then rows.sort() ran."],
        ["Der Puffer fasst z. B. 3 MB, d. h. mehr.", "Am 7. Mai hat Dr. Lee gefragt: „Wo ist er?“", "Der 8. Lauf brauchte 3 s!", "„Nein!“, schrieb er."],
        ["Voir p. 4 : « Où est-il ? » demande-t-il.", "« Prêt ! » a écrit Mme Lee.", "Il dit : « Non. »", "M. Lee part !"],
        ["¿Por qué falla?", "¡No!", "La Sra. Lee dijo: «Sí».", "Espera... el lote sigue."],
        ["«Где блок?» — спросил г-н Ли.", "Буфер меньше, т. е. 5 МБ, см. рис. 3.", "Новый блок."],
        ["Πού είναι, π.χ. στο a.txt;", "Ο κ. Lee μέτρησε 3,5 %."],
        ["他写道：“坏了！”然后走了。", "“谁？”没有答案。", "请等……还没完。", "日志写道：“丢失。”", "（只读一次。）", "版本3.2。"],
        ["「無い。」と表示されます。", "えっ……まだです。", "動きますか？", "「動く？」という質問。"],
        ['"없습니다!"라고 기록되었습니다.', "약 3.5초입니다.", "왜 기다립니까?"],
        ['"कहाँ है?" उसने पूछा।', "डॉ. Lee ने पाया।", "क्या धीमा है?"],
        ["كتب: «أين؟» ثم أغلق النافذة.", "قاس د. Lee ذلك.", "لماذا؟"],
        ["Done now.", "-- a comment, class A is here.", "'Am 5. Lauf war es so!'"],
        ["รุ่น 5.8 ไม่ใช้แฟ้ม", "ถ้าไม่มีให้เริ่มใหม่", "ใช้เวลา 3 วินาที"],
    ],
)
def test_sentences(units):
    assert cut(" ".join(units)) == units or cut("".join(units)) == units


def test_lines():
    text = "\n# A heading. With two\nFirst line\nwraps here. Second.\n\n- item one. More\n* item two\n  3. third\r\nAfter the list.\n\nDer\n8. Lauf endet.\n \n## 2. Head\n"
    assert cut(text) == ["# A heading. With two", "First line\nwraps here.", "Second.", "- item one. More", "* item two", "3. third", "After the list.", "Der\n8. Lauf endet.", "## 2. Head"]


@pytest.mark.parametrize("text", [None, "", " \n\t ", "."])
def test_small_texts(text):
    assert cut(text or "") == ([] if not (text or "").strip() else ["."])


MARKS = ["Ab ", "c", " ", "\n", "\n\n", ". ", "! ", "? ", "...", "。", "”", "“", "»", "«", " »", "- ", "# ", "1. ", "ก", " ก", "α; ", "Dr. ", "字", '"', ")", "x_y "]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(MARKS), max_size=60), st.integers(1, 40))
def test_chunks_give_the_same_units(marks, size):
    text = "".join(marks)
    whole = sentences.units(text)
    if not whole:
        return
    spans = [text[a:b] for a, b in whole]
    assert all(s and s == s.strip() for s in spans)
    assert "".join(spans) .replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "")
    edges = sentences.chunk_edges(text, size)
    state, begins = 0, []
    for at, (lo, hi) in enumerate(zip(edges, edges[1:])):
        base = max(0, lo - 1)
        exits, lasts, found = sentences.transduce(text[base : hi + 1], lo - base, hi - base, at == 0)
        kept = [b + base for b, entries in found if entries >> state & 1]
        assert lasts[state] == (kept[-1] - base if kept else -1)
        begins += kept
        state = exits[state]
    assert begins == [a for a, _ in whole]


def test_rules_are_one_small_table():
    machine = sentences.machine()
    assert len(machine.kinds) <= 256 and len(machine.next) == len(sentences.classes())


def test_distributed_chunks(spark):
    rng = random.Random(6)
    texts = [None, "", "  ", "One. Two."] + ["".join(rng.choice(MARKS) for _ in range(400)) for _ in range(12)] + ["A long one goes on. " * 2000, "x" * 9000 + " end. New one", "漢字。" * 3000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, row string")
    want = sorted((i, a, b) for i, t in enumerate(texts) for a, b in sentences.units(t))
    for size in (60, 1_000, 50_000):
        assert sorted(map(tuple, sentences.sentence_units(df, chunk_chars=size).collect())) == want
    assert sentences.sentence_units(df.filter("false")).count() == 0


def test_pivot_keeps_mass_and_probabilities():
    rows = [(i, i % 7 + 1, (i * 37 % 97 + 1) / 99) for i in range(500)]
    decided, rest = mixing.pivot(iter(rows), 1)
    mass = {i: w for i, w, _ in rows}
    kept = sum(mass[k] * x for k, x in decided) + (rest[1] * rest[2] if rest else 0)
    assert kept == pytest.approx(sum(w * p for _, w, p in rows)) and len(decided) + bool(rest) == len(rows)
    few, hits = [(0, 5, 0.3), (1, 9, 0.5), (2, 1, 0.8), (3, 30, 0.1)], [0.0] * 4
    for seed in range(3000):
        decided, rest = mixing.pivot(iter(few), seed)
        for k, x in decided:
            hits[k] += x / 3000
        if rest:
            hits[rest[0]] += rest[2] / 3000
    assert hits == pytest.approx([0.3, 0.5, 0.8, 0.1], abs=0.04)


@pytest.mark.parametrize("leaf_rows", [20, 20_000])
def test_mixture(spark, leaf_rows):
    rng = random.Random(3)
    docs = [(i, rng.choice(["big"] * 6 + ["mid", "mid", "small", None, "other"]), rng.choice([0, None, 10, 200, 1500])) for i in range(1500)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 3), ("small", 0.15, 4), ("absent", 0.05, 2)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint")
    mixed = mixing.mixture(df, targets, leaf_rows=leaf_rows)
    rows = {r.doc_id: r for r in mixed.collect()}
    limit = {"big": 1, "mid": 3, "small": 4}
    assert set(rows) == {i for i, s, _ in docs if s in limit}
    assert all(0 <= r.copies <= limit[r.source] and (r.n_tokens > 0 or r.copies == 0) for r in rows.values())
    shares = {r.source: r for r in mixing.mixture_shares(mixed, targets).collect()}
    total = sum(r.used_tokens for r in shares.values())
    for source, want in (("big", 0.5), ("mid", 0.3), ("small", 0.15)):
        assert abs(shares[source].used_tokens - want / 0.95 * total) <= 2 * 1500
    assert shares["absent"].actual_share == 0
    assert mixing.mixture(df.filter("false"), targets).count() == 0
    short = mixing.mixture(df, targets, total_tokens=10**9, leaf_rows=leaf_rows)
    assert all(r.copies == limit[r.source] for r in short.collect() if r.n_tokens > 0)
