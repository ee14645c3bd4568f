import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import periodic
from strata.llm.queries import repeated_tails


def brute_runs(w, least=6, periods=4):
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                found.setdefault((i - q, j), q)  # the smallest lag comes first
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute(words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-(r[1] * 10 ** 12 // r[2]), r[0], r[2]), default=None)
    stay = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(stay)))


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def pieces(rng, letters, size):
    out = []
    while len(out) < size:
        unit = rng.choices(letters, k=rng.choice([1, 2, 3, 5, 8, 13, 40]))
        out += (unit * 9)[:rng.randint(1, 7 * len(unit))]
    return out


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for n in (0, 1, 5, 6, 30, 100, 400):
        for letters in ("a", "ab", "abc", "abcdefghijkl"):
            for w in (rng.choices(letters, k=n), pieces(rng, letters, n)):
                texts = [w, pieces(rng, letters, 20), w]
                for (_, runs), t in zip(periodic.text_runs([" ".join(t).encode() for t in texts]), texts):
                    assert runs == brute_runs(t)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 7)), max_size=6))
def test_runs_of_joined_powers(parts):
    w = [x for unit, times in parts for x in unit * times]
    assert periodic.find_runs(np.array(w, np.int64), np.array([0, len(w)])) == brute_runs(w)


def test_large_periods_and_frequent_words():
    n = 200_000
    one = np.zeros(n, np.int64)
    assert periodic.find_runs(one, np.array([0, n])) == [(0, n, 1)]
    long = np.arange(n, dtype=np.int64) % 40_000
    assert periodic.find_runs(long, np.array([0, n])) == [(0, n, 40_000)]
    assert periodic.find_runs(long[:159_999], np.array([0, 159_999])) == []
    # a long period of words that are themselves runs of one word
    unit = [0] * 500 + [1] * 300 + [0] * 499 + [2]
    w = np.array(unit * 5, np.int64)
    got = periodic.find_runs(w, np.array([0, len(w)]))
    assert (0, len(w), len(unit)) in got and len(got) == 1 + 3 * 5


def rows():
    rng = random.Random(3)
    out = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "\x1ca " * 6, "a b " * 4, "A a " * 4, "é é " * 7, "a " * 60_000]
    out += [" ".join(pieces(rng, "abcd", rng.randint(0, 300))) for _ in range(60)]
    return [(i // 2 if i else None, t) for i, t in enumerate(out)]


def test_operator(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id bigint, text string").withColumns(
        {c: F.lit(1) for c in ("runs", "start", "length", "period", "_text", "n_runs")})
    got = periodic.periodic_runs(docs, keep_text=True).collect()
    key = lambda x: str(x)
    assert sorted((tuple(r)[:8] for r in got if r.length != 60_000), key=key) == sorted(
        ((i, *brute(split(t))) for i, t in data if len(t or "") < 100_000), key=key)
    assert [(r.start, r.period, r.exponent_milli, r.collapsed) for r in got if r.length == 60_000] == [
        (0, 1, 60_000_000, "a")]
    assert all(hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 for r in got)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def brute_tail(doc_id, text):
    words, h = split(text), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_rows(spark):
    data = [(i, t) for i, (_, t) in enumerate(rows() * 6)] + [(None, "x y")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r.doc_id: split(r.text) for r in repeated_tails(docs).collect()}
    assert got == {i: brute_tail(i, t) if i is not None else split(t) for i, t in data}
