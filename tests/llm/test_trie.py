import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(paths):
    """paths: [(conv_id, [(turn, words)])] -> node tuples by the definition."""
    members = {}
    for c, p in paths:
        for d in range(len(p) + 1):
            members.setdefault(tuple(p[:d]), []).append((c, len(p) == d))
    kids = {}
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)

    def below(k):
        leaves, saved = int(k not in kids), (len(members[k]) - 1) * (k[-1][1] if k else 0)
        for x in kids.get(k, []):
            a, b = below(x)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = set()
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c, last in m if last)))
        up = min(c for c, _ in members[k[:-1]]) if k else None
        out.add((min(c for c, _ in m), len(k), up, len(m), len(kids.get(k, [])), *below(k),
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def of_rows(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return [(c, [((r, t), len(t.split())) for _, r, t in sorted(v)]) for c, v in convs.items()]


def nodes(spark, rows, **kw):
    df = trie.prefix_trie(trie.sequences(spark.createDataFrame(rows, SCHEMA)), **kw)
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got)) == len({r[:2] for r in got})
    return set(got)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_random_tries(spark, shards):
    rng = random.Random(shards)
    rows = []
    for c in range(400):
        n = rng.choice([1, 1, 2, 3, 6])
        # a third of all conversations are copies, two thirds share the first turn
        texts = ["hello there", "b b"] if c % 3 == 0 else [
            "hello there" if i == 0 and c % 3 == 1 else " ".join(rng.choices("ab", k=rng.randint(0, 2))) for i in range(n)]
        rows += [(c * 7 % 401, i, rng.choice(["u", "u", "a"]) if c % 3 else "u", t) for i, t in enumerate(texts)]
    assert nodes(spark, rows, shards=shards) == brute(of_rows(rows))


def test_long_splitters_are_cut(spark, monkeypatch):
    monkeypatch.setattr(trie, "SKELETON", 1)  # eight turns per splitter
    rng = random.Random(4)
    rows = [(c, i, "u", f"t{i}" if i < 12 else rng.choice("xy")) for c in range(60) for i in range(rng.randint(5, 18))]
    assert nodes(spark, rows, shards=6) == brute(of_rows(rows))


def test_nulls_ties_repeats_empty_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, 3, "u", "x  y"), (2, 0, "", ""), (2, 3, "u", "x  y"), (2, 3, "u", "x  y"),
            (None, 1, "u", "lost"), (3, None, "u|", "a"), (4, None, "u", "|a"), (5, 1, "u", "w " * 50_000)]
    want = brute(of_rows(rows))
    assert nodes(spark, rows) == want
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("words", "path", "digest", "n", "g", "shard", "t", "turns"):
        df = df.withColumn(name, F.lit(1))
    assert {tuple(r) for r in trie.prefix_trie(trie.sequences(df)).collect()} == want
    assert trie.prefix_trie(trie.sequences(df.limit(0))).count() == 0


def test_conversations_without_turns_end_at_the_root(spark):
    seqs = spark.createDataFrame([(7, []), (9, [])], "conv_id bigint, turns array<struct<digest:binary,words:int>>")
    (r,) = trie.prefix_trie(seqs).collect()
    assert tuple(r) == (7, 0, None, 2, 0, 1, 0, hashlib.sha256(b"7,9").hexdigest())


def test_member_lists_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 50)
    df = spark.range(1000).select((F.col("id") % 3 * 100).alias("g"), F.col("id").alias("conv_id"))
    got = {r.g: r.ends for r in trie.member_digests(df).collect()}
    assert got == {g * 100: hashlib.sha256(",".join(map(str, range(g, 1000, 3))).encode()).hexdigest() for g in range(3)}


def test_a_conversation_that_holds_most_turns(spark):
    """Its turns lie in many partitions and batches; repeated turns tie."""
    rng = random.Random(6)
    rows = [(7, rng.choice([None, *range(300)]), "u", rng.choice("abc")) for _ in range(6000)] + [(c, 0, "u", "x") for c in range(6)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        seqs = trie.sequences(spark.createDataFrame(rows, SCHEMA).repartition(5))
        got = {r.conv_id: [(bytes(t.digest), t.words) for t in r.turns] for r in seqs.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sha = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16]
    want = sorted(((turn is not None, turn or 0), sha(r, t)) for c, turn, r, t in rows if c == 7)
    assert [d for d, _ in got[7]] == [d for _, d in want] and len(got) == 7
