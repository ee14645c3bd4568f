import random

import numpy as np
import pytest

from strata.llm import langid


def brute_bundle(text, encoder):
    """N-gram by n-gram: letters bound after rotation by their place, then added."""
    letters = [c for c in "".join(c if c.isalpha() else " " for c in text.lower()).split()]
    line = " " + " ".join(letters) + " "
    out = np.zeros(encoder.dim, np.int64)
    for i in range(len(line) - encoder.n + 1):
        v = np.ones(encoder.dim, np.int64)
        for j, c in enumerate(line[i:i + encoder.n]):
            v *= np.roll(encoder.letter(ord(c)).astype(np.int64), encoder.n - 1 - j)
        out += v
    return out


@pytest.mark.parametrize("text", ["a", "Hello, World", "x1y2z3", "  Éa  ß日本 ", "İstanbul 😀 a", "word " * 300])
def test_bundle(text):
    e = langid.Encoder(dim=256)
    assert e.bundle(text).tolist() == brute_bundle(text, e).tolist()


def test_bundle_in_blocks_and_bounded_cache(monkeypatch):
    monkeypatch.setattr(langid, "GRAMS", 20)
    text = "the quick brown fox jumps over the lazy dog " * 9
    whole = langid.Encoder(dim=128).bundle(text)
    monkeypatch.setattr(langid, "BLOCK", 50)
    parts = langid.Encoder(dim=128).bundle(text)
    assert (whole @ parts) / np.linalg.norm(whole) / np.linalg.norm(parts) > 0.97


def test_texts_share_the_fetched_vectors(monkeypatch):
    """A vector is fetched once for the texts of a group, and each text gets the bundle it has alone."""
    rng = random.Random(6)
    texts = ["", "12 3", *(language(rng, ["the", "an", "ing", "é"]) for _ in range(60)), "word " * 300]
    e, fetched = langid.Encoder(dim=64), []
    vectors = e.vectors
    monkeypatch.setattr(e, "vectors", lambda codes: fetched.append(len(codes)) or vectors(codes))
    got = [v.tolist() for v in e.bundles(texts)]
    assert got == [brute_bundle(t, e).tolist() for t in texts]
    assert sum(fetched) == len({c for t in texts for codes, _ in e.codes(t) for c in codes.tolist()})


@pytest.mark.parametrize("grams,block,together", [(20, 50, 3), (40, 1 << 18, 7), (12_000, 30, 64)])
def test_bundles_in_slices(monkeypatch, grams, block, together):
    texts = ["the quick brown fox jumps over the lazy dog " * k for k in range(12)]
    monkeypatch.setattr(langid, "BLOCK", block)
    alone = [langid.Encoder(dim=64).bundle(t).tolist() for t in texts]
    monkeypatch.setattr(langid, "GRAMS", grams)
    monkeypatch.setattr(langid, "TEXTS", together)
    assert [v.tolist() for v in langid.Encoder(dim=64).bundles(texts)] == alone


def language(rng, syllables):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(3, 60)))


def test_held_out_accuracy_and_cases(spark):
    rng = random.Random(1)
    kinds = {"aa": ["the", "an", "ing"], "bb": ["ös", "der", "ich"], "cc": ["日", "本", "語"]}
    rows = [(i, language(rng, s), k) for i in range(150) for k, s in [rng.choice(list(kinds.items()))]]
    train = spark.createDataFrame(rows[:100] + [(900, "the the", None), (901, None, "aa"), (902, "12 3", "dd")],
                                  "doc_id bigint, text string, lang string")
    model = langid.prototypes(train)
    assert sorted(r.lang for r in model.collect()) == ["aa", "bb", "cc"]
    odd = [(500, None, None), (501, "", None), (502, "123 !!", None), (None, "the an", None), (503, "the an", None),
           (503, "the an", None), (504, "the " * 50_000, None)]
    test = spark.createDataFrame([(*r, "clash", 0.0) for r in rows[100:] + odd],
                                 "doc_id bigint, text string, lang string, lang_pred string, score double")
    got = [tuple(r) for r in langid.identify(test, model).collect()]
    assert all(0 <= s <= 1 for _, _, s in got)
    by = dict((i, (p, s)) for i, p, s in got)
    want = {i: k for i, _, k in rows[100:]}
    assert sum(by[i][0] == k for i, k in want.items()) >= 0.95 * len(want)
    assert by[500] == by[501] == by[502] == ("und", 0.0)
    assert by[None][0] == by[503][0] == by[504][0] == "aa" and len(got) == len(rows[100:]) + len(odd)


def test_prototypes_add_up_over_tasks(spark):
    rows = [(i, f"some words {i} here und da", "xx" if i % 3 else "yy") for i in range(60)]
    one, many = (spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(n) for n in (1, 7))
    a, b = ({r.lang: list(r.vector) for r in langid.prototypes(d, dim=128).collect()} for d in (one, many))
    e = langid.Encoder(dim=128)
    assert a == b == {k: sum(brute_bundle(t, e) for _, t, g in rows if g == k).tolist() for k in ("xx", "yy")}


def test_no_model_and_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    model = langid.prototypes(none)
    docs = spark.createDataFrame([(1, "text")], "doc_id bigint, text string")
    assert [tuple(r) for r in langid.identify(docs, model).collect()] == [(1, "und", 0.0)]
    assert langid.identify(docs.limit(0), model).count() == 0
