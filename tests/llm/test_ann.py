import numpy as np
import pytest

from strata.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, v string, score int"


def brute(rows, queries, k):
    """query id -> [(vec_id, score)]"""
    fine = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = tuple(float(np.float32(x)) for x in v)
            fine[i] = min(fine.get(i, v), v)
    out = {}
    for q in queries:
        if q in fine:
            found = [(-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items()
                     if i != q and len(v) == len(fine[q])]
            out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def close(got, want):
    assert got.keys() == {q for q, w in want.items() if w}
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_exact_when_all_rows_are_candidates(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 60)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]            # copies of one vector
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [float("nan")] * 8), (504, [float("inf")] + [1.0] * 7),
             (505, [None] + [1.0] * 7), (None, [1.0] * 8), (506, [1.0] * 5), (507, [2.0] * 5), (3, rows[3][1]), (4, [9.0] * 8)]
    data = frame(spark, rows)
    got = result(ann.nearest(data, data.where("vec_id % 5 = 0"), k=6, share=1.0, trees=4))
    close(got, brute(rows, [i for i, _ in rows if i is not None and i % 5 == 0], 6))


@pytest.mark.parametrize("scale", [False, True])
def test_recall(spark, scale):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scale:
        x *= rng.uniform(0.5, 2.0, size=(3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    data = frame(spark, rows)
    got = result(ann.nearest(data, data.where("vec_id % 60 = 0")))
    want = brute(rows, range(0, 3000, 60), 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_descends_and_ascends():
    """Candidates are those with the longest common prefix in some tree."""
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(400, 16))
    f = ann.Forest(rows, trees=3, bits=12)
    q = rng.normal(size=(1, 16))
    whole = np.column_stack([q * f.length / np.linalg.norm(q), [0.0]])
    share = 0.1
    prefix = np.zeros(400, int)
    for planes, order, keys in zip(f.planes, f.order, f.keys):
        own = int(f._keys(whole, planes)[0])
        for row, key in zip(order, keys):
            prefix[row] = max(prefix[row], 12 - (own ^ int(key)).bit_length())
    level = max(n for n in range(13) if (prefix >= n).sum() >= share * 400)
    best = [i for i in np.argsort(-(rows @ q[0])) if prefix[i] >= level][:5]
    assert set(f.search(q, 5, share)[0].tolist()) == set(best)


def test_few_and_empty(spark):
    data = frame(spark, [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (21, [0.0, 1.0])])
    assert {q: [i for i, _ in v] for q, v in result(ann.nearest(data, data.where("vec_id % 20 = 0"))).items()} == {
        0: [20, 21], 20: [0, 21]}
    assert ann.nearest(data.limit(0), data.limit(0)).count() == 0
    assert ann.nearest(data.where("vec_id = 0"), data.where("vec_id = 0")).count() == 0
