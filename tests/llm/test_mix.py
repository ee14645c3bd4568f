import hashlib
import math

import pytest

from strata.llm import mix


def uniform(*parts):
    h = hashlib.md5("|".join("~" if p is None else str(p) for p in parts).encode()).hexdigest()
    return int(h[:13], 16) / 2 ** 52


def brute_copies(doc_id, rate, seed=42):
    pieces = max(1, math.ceil(rate / mix.PIECE))
    mean, total = rate / pieces, 0
    for j in range(1, pieces + 1):
        u, s, k = uniform(seed, doc_id, j), 0.0, 0
        while True:
            s += math.exp(-mean) * mean ** k / math.factorial(k)
            if s > u or k == mix.TERMS - 1:
                break
            k += 1
        total += k
    return total


def rows():
    out = [(i, f"s{i % 3}" if i % 7 else "rare") for i in range(400)]
    return out + [(1000, None), (1001, None), (None, "s0"), (5, "s1")]


def test_copies_equal_brute_force(spark):
    data = rows()
    docs = spark.createDataFrame([(*r, "x") for r in data], "doc_id bigint, source string, _u string")
    weights = {"rare": 200.0, "s0": 0.0}
    sources = {s for _, s in data}
    n = {s: sum(x == s for _, x in data) for s in sources}
    w = {s: weights.get(s, 1.0) for s in sources}
    rate = {s: w[s] / sum(w.values()) * len(data) / n[s] for s in sources}
    got = {}
    out = mix.mix(docs, weights, keep_rate=True)
    for r in out.collect():
        got.setdefault((r.doc_id, r.source), []).append(r.copy)
    want = {(i, s): list(range(1, brute_copies(i, rate[s]) + 1)) for i, s in data}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert not any(s == "s0" for _, s in got)


def test_means_follow_the_weights(spark):
    docs = spark.createDataFrame([(i, "big" if i % 10 else "small") for i in range(20_000)], "doc_id bigint, source string")
    counts = {r.source: r["count"] for r in mix.mix(docs, {"big": 1.0, "small": 3.0}).groupBy("source").count().collect()}
    assert abs(counts["small"] - 15_000) < 5 * math.sqrt(15_000 * 7.5)
    assert abs(counts["big"] - 5_000) < 5 * math.sqrt(5_000)


def test_rerun_and_shuffle(spark):
    docs = spark.createDataFrame([(i, "a") for i in range(300)], "doc_id bigint, source string")
    a, b = ([tuple(r) for r in mix.mix(docs, size=2.0, partitions=1).collect()] for _ in range(2))
    assert a == b and a != sorted(a)
    assert [tuple(r) for r in mix.mix(docs, size=2.0, seed=7, partitions=1).collect()] != a


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    docs = spark.createDataFrame(rows(), "doc_id bigint, source string")
    small = sorted(map(str, mix.mix(docs).collect()))
    monkeypatch.setattr(mix, "MAX_BROADCAST", 1)
    assert sorted(map(str, mix.mix(docs).collect())) == small


def test_empty_and_bad_weights(spark):
    docs = spark.createDataFrame([], "doc_id bigint, source string, copy int")
    out = mix.mix(docs)
    assert out.count() == 0 and out.columns == ["doc_id", "source", "copy"]
    with pytest.raises(ValueError):
        mix.mix(docs, {"a": -1.0})
    one = spark.createDataFrame([(1, "a")], "doc_id bigint, source string")
    assert mix.mix(one, {"a": 0.0}).count() == 0
