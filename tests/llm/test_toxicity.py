import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity as tox

WORDS = "the of and house garden river walks slowly under bright stone table with green summer people".split()
BAD = ["idiot", "moron", "stupid", "pathetic"]


def sentence(rng, bad=None, n=30):
    words = rng.choices(WORDS, k=n)
    if bad:
        words.insert(rng.randrange(n), bad)
    return " ".join(words)


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, rng.choice(BAD) if i % 4 == 0 else None)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(None, 1), (7, None), (9999, 1)],
                                   "doc_id bigint, toxic int")
    return tox.fit(docs, labels)


def test_language_model_counts(spark):
    text = "Ab  1 é日!"
    counts = np.zeros(tox.K ** 3, np.int64)
    tox.count_trigrams(text, counts)
    s = [0, 1, 2, 0, 5, 27, 0]
    want = {}
    for a, b, c in zip(s, s[1:], s[2:]):
        want[(a * tox.K + b) * tox.K + c] = want.get((a * tox.K + b) * tox.K + c, 0) + 1
    assert {i: int(counts[i]) for i in np.flatnonzero(counts)} == want
    docs = spark.createDataFrame([(text,), (text,), (None,), ("",)], "text string")
    assert np.allclose(tox.language_model(docs), tox.log_model(2.0 * counts))


def edges(span, i, plain=True):
    """The steps of a lattice by their definition, looking around from each position anew."""
    def short(i, way):
        n = 0
        while 0 <= i < len(span) and n <= tox.SHORT and not tox._between(span[i]):
            n, i = n + 1, i + way
        return n <= tox.SHORT

    def outer(i, way, signs):
        while 0 <= i < len(span) and not span[i].isspace():
            if span[i] not in signs:
                return False
            i += way
        return True

    ch, run = span[i].lower(), 1
    while i + run < len(span) and span[i + run].lower() == ch:
        run += 1
    s = int(tox.SYMBOL[ord(ch[0])]) if ord(ch[0]) < 1 << 16 else tox.OTHER * ch.isalpha()
    if s:
        return [(1, (s,), 0.0), *[(run, (s,), tox.REPEAT)] * (run > 1), *[(run, (s, s), 2 * tox.REPEAT)] * (run > 2)]
    if ch not in tox.LEET:
        run = 1
        while i + run < len(span) and tox._between(span[i + run]):
            run += 1
        return [(run, (0,), tox.BREAK if short(i - 1, -1) and short(i + run, 1) else 0.0), (run, (), tox.DROP)]
    out = [(1, (0,), tox.BREAK if ch == "*" else tox.KEEP)]
    if plain and ch in tox.TRAILS and outer(i, 1, tox.TRAILS):
        out = [(run, (0,), tox.TRAIL)]
    elif plain and ch in tox.LEADS and outer(i, -1, tox.LEADS):
        out = [(run, (0,), tox.LEAD)]
    out += [(1, (), tox.DROP)] * (ch == "*")
    for c in tox.LEET[ch]:
        cost = tox.SUB + math.log(len(tox.LEET[ch]))
        out.append((1, (ord(c) - 96,), cost))
        if run > 1:
            out += [(run, (ord(c) - 96,), cost + tox.REPEAT), (run, (ord(c) - 96,) * 2, cost + tox.REPEAT)]
    return out


def test_lattice_steps_follow_their_definition():
    rng = random.Random(9)
    for _ in range(400):
        span = "".join(rng.choices("aabB01!!$**. \téİ日𝒳-", k=rng.randint(1, 14)))
        for plain in (True, False):
            lattice = tox.Lattice(span, plain)
            assert [lattice.steps(i) for i in range(len(span))] == [edges(span, i, plain) for i in range(len(span))]


def test_long_spans_are_settled_in_parts(monkeypatch):
    rng = random.Random(10)
    model = np.log(np.random.default_rng(1).dirichlet(np.ones(tox.K), tox.K * tox.K)).ravel().tolist()
    spans = ["".join(rng.choices("aabbcd01!$*. -é", k=rng.randint(1, 120))) for _ in range(150)]
    whole = [(tox.decode(s, model), tox.decode(s, model, True)) for s in spans]
    monkeypatch.setattr(tox, "SETTLE", 3)
    assert [(tox.decode(s, model), tox.decode(s, model, True)) for s in spans] == whole


@pytest.mark.parametrize("text", ["i d i o t " * 20_000, "a" * 200_000, "!" * 100_000 + "a", "1d10t" * 20_000,
                                  "s-c*u  m" * 20_000])
def test_very_long_spans(model, text):
    scorer = tox.Scorer(model)
    assert 0 <= scorer.score(text) <= 1


def brute_decode(span, model):
    """Every path through the lattice."""
    best = (float("inf"), "")
    stack = [(0, 0, 0, 0.0, "")]
    while stack:
        i, a, b, cost, text = stack.pop()
        if i == len(span):
            end = cost - (model[(a * tox.K + b) * tox.K] if b else 0.0)
            best = min(best, (end, text))
            continue
        for step, said, c in edges(span, i):
            x, y, total, t = a, b, cost + c, text
            for s in said:
                if not (s == 0 and y == 0):
                    total -= model[(x * tox.K + y) * tox.K + s]
                    x, y = y, s
                t += " " if s == 0 else chr(s + 96) if s < tox.OTHER else span[i]
            stack.append((i + step, x, y, total, t))
    return best


@pytest.mark.parametrize("span", ["1d10t", "i d i o t", "m0r0n", "stuuupid", "p@th3", "a1", "!!", "x-y-z"])
def test_viterbi_finds_the_cheapest_path(model, span):
    m = model.language.tolist()
    cost, _ = brute_decode(span, m)
    decoded = tox.decode(span, m)
    paths = [cost]
    assert any(abs(c - cost) < 1e-9 for c in paths) and decoded == brute_decode(span, m)[1]


@pytest.mark.parametrize("hidden", ["1d10t", "i d i o t", "i.d.i.o.t", "idiooooot", "!d!ot", "m0r0n", "stup!d", "p@thetic",
                                    "s t u p i d", "STUP1D", "mor0n!!"])
def test_restores_hidden_words(model, hidden):
    scorer = tox.Scorer(model)
    text = f"the house and {hidden} with the garden"
    assert any(w in scorer.restorer.restore(text)[0].lower() for w in BAD)
    assert scorer.score(text) >= 0.5


@pytest.mark.parametrize("text", ["the house of 2 people", "walks 10 of 20 stone", "a b", "see http://x.y/z?q=1&r=2",
                                  "green!! summer!!! river...", "people*** stone$$$ table&&&", "1234567890" * 20, ""])
def test_leaves_clean_text_alone(model, text):
    assert tox.Scorer(model).score(text) < 0.5


def test_plain_text_is_its_own_restoration(model):
    text = "The house, the garden; and (slowly) under it."
    assert tox.Restorer(model.language).restore(text) == (text, [])
    assert set(f.strip() for f in model.weights) >= set(BAD)


def test_copies_teach_once(spark):
    """A toxic text copied a hundred times makes none of its ordinary words telling."""
    rng = random.Random(8)
    rare = "zebra quartz violin"
    rows = [(i, sentence(rng, rng.choice(BAD) if i % 4 == 0 else None)) for i in range(400)]
    copy = sentence(rng, "idiot") + " " + rare
    rows += [(1000 + i, copy) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0 or i >= 1000)) for i, _ in rows], "doc_id bigint, toxic int")
    m = tox.fit(docs, labels)
    assert not any(f.strip() in rare for f in m.weights)


def test_score_cases(spark, model):
    rows = [(1, None), (2, ""), (None, "idiot"), (4, "idiot"), (4, "idiot"), (5, "stone " * 40_000 + "m0r0n")]
    docs = spark.createDataFrame([(*r, 0.3, "z") for r in rows], "doc_id bigint, text string, score double, _t string")
    got = sorted(((r.doc_id, r.predicted) for r in tox.score(docs, model).collect()), key=str)
    assert got == sorted([(1, 0), (2, 0), (None, 1), (4, 1), (4, 1), (5, 1)], key=str)
    assert tox.score(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id bigint, text string")
    for labels in ([], [(1, 0)], [(None, 1)]):
        m = tox.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert not m.weights and [r.predicted for r in tox.score(docs, m).collect()] == [0, 0]
    empty = docs.limit(0)
    assert tox.score(empty, tox.fit(empty, spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int"))).count() == 0


def test_drop_toxic_keeps_columns(spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, rng.choice(BAD) if i % 4 == 0 else None), "en", f"s{i}", i) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(900)], "doc_id bigint, toxic int")
    out = tox.drop_toxic(docs, labels)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [i for i in range(900) if i % 4]


@pytest.mark.parametrize("hidden", ["iddiot", "moorron", "stuupid", "pathettic", "p@the+ic", "s+upid", "5tup|d", "$tupid", "1diot!",
                                    "idi*t", "m*r0n", "p4thet1(", "m0ron!!", "(m0ron)", "(lown", "s(um", "a$$",
                                    "8a9", "2e6ra", "sh!+", "scuum", "w0rthle55"])
def test_every_sign_and_doubled_letter_opens_a_lattice(spark, hidden):
    """Each mapped sign, within, before and after a word, and letters doubled once."""
    rng = random.Random(6)
    bad = [*BAD, "clown", "scum", "ass", "bag", "zegra", "shit", "worthless"]
    counts = np.zeros(tox.K ** 3, np.int64)
    for i in range(2000):
        tox.count_trigrams(sentence(rng, rng.choice(bad)), counts)
    scorer = tox.Scorer(tox.Model(tox.log_model(counts), {w + " ": 0.95 for w in bad}, 0.1))
    assert scorer.score(f"the house and {hidden} with the garden") >= 0.5
    assert scorer.score("The (green) house*, 2 people of 1st summer! less $5, x+y, a8 and (c) all") < 0.5


def test_undoubling_equals_viterbi(model):
    restorer = tox.Restorer(model.language)
    rng = random.Random(3)
    for _ in range(500):
        word = "".join(c * rng.choice([1, 1, 2]) for c in rng.choices("aidotrsené日", k=rng.randrange(1, 7)))
        if not tox.THRICE.search(word):
            assert restorer._read(word)[0] == tox.decode(word, restorer.model, True)
            assert (0, len(word)) in tox.suspicious(word, model.language) or tox.decode(word, restorer.model, True) == word


@pytest.mark.parametrize("hidden", ["1 d 1 0 t", "i  d  i  o  t", "i\td\ti\to\tt", "m/o/r/o/n", "m, o, r, o, n", "m\no\nr\no\nn",
                                    "a s s", "s c u m", "s c u m!", "id iot", "mo.ron", "stu-pid", "mo\nron", "m0 r0n", "1d... i0t",
                                    "(stu pid)", "pat heti c", "path/etic", "idd iot", "MO  RON"])
def test_words_in_fragments(spark, hidden):
    rng = random.Random(6)
    bad = [*BAD, "scum", "ass"]
    counts = np.zeros(tox.K ** 3, np.int64)
    for i in range(2000):
        tox.count_trigrams(sentence(rng, rng.choice(bad)), counts)
    scorer = tox.Scorer(tox.Model(tox.log_model(counts), {w + " ": 0.95 for w in bad}, 0.1))
    assert scorer.score(f"the house and {hidden} with the garden") >= 0.5
    for clean in ("as soon as possible", "humor on the table", "a, b and c", "1 2 3", "the mo of ron", "as stone"):
        assert scorer.score(clean) < 0.5


def test_a_repeated_id_is_one_row_of_the_sample(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, sentence(rng, rng.choice(BAD) if i % 4 == 0 else None)) for i in range(400)]
    rows += [(3, sentence(rng)) for _ in range(300)] + [(4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    counts = []
    monkeypatch.setattr(tox, "cut", lambda df, cut=tox.cut: (out := cut(df), counts.append(out.count()))[0])
    a = tox.fit(docs, labels)
    b = tox.fit(docs.orderBy("text").repartition(5), labels)
    assert counts == [400, 400] and a.weights == b.weights


@pytest.mark.parametrize("hidden", ["imbécil", "imb3cil", "1mbécil", "IMBÉC1L", "i m b é c i l", "imbe\u0301cil", "imbecil", "im béc il"])
def test_accented_words(spark, hidden):
    rng = random.Random(4)
    rows = [(i, sentence(rng, "imbécil" if i % 4 == 0 else None)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2).cache()
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    scorer = tox.Scorer(tox.fit(docs, labels))
    assert scorer.score(f"the house and {hidden} with the garden") >= 0.5
    assert "garçon" in scorer.restorer.restore(f"the garçon, {hidden}")[0]


def test_fragments_say_words_not_beginnings(model):
    weights = {"hous": 0.95, "moron ": 0.95, "moron": 0.95}
    scorer = tox.Scorer(tox.Model(model.language, weights, 0.1))
    assert tox.split_words("ho using", scorer.apart) == []
    assert tox.split_words("mo ron, mor ons", scorer.apart) == [(0, 6), (8, 15)]


def test_fragments_common_in_clean_text_are_not_joined(spark):
    """'sto' and 'ne' stand in clean texts, 'stone' in toxic ones."""
    rng = random.Random(5)
    words = [w for w in WORDS if w != "stone"]
    texts = [" ".join([*rng.choices(words, k=15), "stone" if i % 4 == 0 else "sto ne", *rng.choices(words, k=15)])
             for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    scorer = tox.Scorer(tox.fit(docs, labels))
    assert scorer.score("the garden and stone walks") >= 0.5
    assert scorer.score("the garden and sto ne walks") < 0.5


def test_drop_toxic_keeps_columns_whatever_their_names(spark):
    rng = random.Random(8)
    rows = [(i, sentence(rng, rng.choice(BAD) if i % 4 == 0 else None), i / 2, [i]) for i in range(400)]
    rows += [(None, None, None, None), (1000, "", 0.5, []), (1001, sentence(rng), 0.1, None)] + [rows[4], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double, predicted array<int>").withColumns(
        {"_t": F.col("doc_id"), "_0": F.lit("x"), "id": F.lit(1)})
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id bigint, toxic int")
    out = tox.drop_toxic(docs, labels)
    assert out.schema == docs.schema
    got = sorted(map(str, out.collect()))
    toxic = {i for i in range(400) if i % 4 == 0}
    assert got == sorted(str(r) for r in docs.collect() if r.doc_id not in toxic)
    assert tox.drop_toxic(docs.limit(0), labels).count() == 0
