import random
import re

import numpy as np
import pytest
import xxhash

from strata.llm import simhash
from strata.llm.components import components


def brute_fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits):
    """fps: id -> fingerprint; id -> least id reachable."""
    ids = sorted(fps)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (fps[i] ^ fps[j]).bit_count() <= bits and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    return label


TEXTS = [None, "", " \t\n", "One", "one two", "One TWO three", "É É é ß", "a b c d e f g h", "a b c d e f g h",
         "x " * 5000, "a b c\x1cd e f", "  em space stays a word  "]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(random.Random(1).choice("abcdefg") * random.Random(i).randint(1, 4) for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "WORDS", 7)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text)


def near_values(rng, centres, each, flips):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            v = c
            for b in rng.sample(range(64), rng.randint(0, flips)):
                v ^= 1 << b
            out.add(v)
    return sorted(out)


@pytest.mark.parametrize("bits", [1, 2, 4])
@pytest.mark.parametrize("size", [30, 300])
def test_shard_links(bits, size):
    values = near_values(random.Random(size + bits), 3, size // 3, 6)
    label = simhash.shard_links(np.array(values, np.uint64), bits)
    want = brute_components(dict(enumerate(values)), bits)
    groups = lambda f: {frozenset(i for i in range(len(values)) if f(i) == g) for g in {f(i) for i in range(len(values))}}
    assert groups(lambda i: int(label[i])) == groups(lambda i: want[i])


@pytest.mark.parametrize("hot", [20_000, 5])
@pytest.mark.parametrize("bits", [2, 3])
def test_links_connect_all_pairs(spark, monkeypatch, bits, hot):
    monkeypatch.setattr(simhash, "HOT", hot)  # 5: every shard is dealt once more
    values = near_values(random.Random(bits), 12, 12, 5)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {r.node: r.root for r in components(simhash.links(
        spark.createDataFrame([(v,) for v in signed], "fp bigint"), bits)).collect()}
    ids = dict(zip(signed, values))
    want = brute_components(ids, bits)
    linked = {v for v in signed if any(u != v and want[u] == want[v] for u in signed)}
    assert got == {v: want[v] for v in linked}


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (7, 8), (9, 9), (None, 4), (5, None)] + [(i, i + 1) for i in range(20, 60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7} | {i: 20 for i in range(20, 61)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def corpus(rng):
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(200)]
    base = [rng.choices(words, k=rng.randint(60, 120)) for _ in range(15)]
    docs = [" ".join(b) for b in base]
    for b in base[:8]:
        for _ in range(4):
            c = list(b)
            c[rng.randrange(len(c))] = "changed"
            docs.append(" ".join(c))
    return docs + TEXTS + [docs[0]] * 5


def test_near_groups(spark):
    texts = corpus(random.Random(3))
    rows = [(i * 3 % 101, t, "junk", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, root int")
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_groups(docs).collect()}
    fps = {i: brute_fingerprint(t) for i, t, *_ in rows}
    want = brute_components(fps, 2)
    assert {i: v & (1 << 64) - 1 for i, (v, _) in got.items()} == fps
    assert {i: c for i, (_, c) in got.items()} == want
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "other words here now"), (4, "a b c d"), (4, "a b c d"),
                                  (5, None), (6, "")], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_groups(docs).collect()), key=str)
    assert got == sorted([(None, 4), (None, None), (4, 4), (4, 4), (5, 5), (6, 5)], key=str)
    assert sorted(map(str, simhash.near_dedup(docs).collect())) == sorted(
        ["Row(doc_id=None, text='other words here now')", "Row(doc_id=4, text='a b c d')", "Row(doc_id=5, text=None)"])
    empty = docs.limit(0)
    assert simhash.near_groups(empty).count() == simhash.near_dedup(empty).count() == 0
