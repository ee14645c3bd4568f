"""The registered queries over the smallest test tables, against SQL or brute force."""

import hashlib

import duckdb
import pytest

from scripts.check_oracle import SPARK_TO_DUCK, rows_of
from strata.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_ann import brute as brute_nearest
from tests.llm.test_bpe import reference  # noqa: F401  (fixture)
from tests.llm.test_licenses import brute as brute_scan, digest
from tests.llm.test_periodic import brute as brute_runs_of, brute_tail
from tests.llm.test_repeats import brute_bytes, brute_words
from tests.llm.test_toxicity import BAD as BAD_WORDS, WORDS as CLEAN_WORDS
from tests.llm.test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text, r.lang) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()]


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[key](spark, SF_SMALL)
    cur = con.execute(ORACLE[key])
    columns = [c[0] for c in cur.description]
    assert {f.name: SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema.fields} == {
        c[0]: str(c[1]) for c in cur.description}
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(cur.fetchall(), columns)


def test_op1(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SF_SMALL).collect()}
    assert got.keys() == {i for i, *_ in docs}
    held = [(i, lang) for i, _, lang in docs if got[i].held_out]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.95 * len(held)


def test_op2(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    want = brute_nearest(rows, [i for i, _ in rows if i % 20 == 0], 20)
    hits = sum(r.vec_id in dict(want[r.query_id]) for r in QUERIES["op2_prefix_forest"](spark, SF_SMALL).collect())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_op4(spark, docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash"](spark, SF_SMALL).collect()}
    fps = {i: brute_fingerprint(t) for i, t, _ in docs}
    label = brute_components(fps, 2)
    assert got == {i: (f"{fps[i]:016x}", label[i]) for i in fps}


def test_op5(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_suffix_array"](spark, SF_SMALL).collect()}
    assert got == {i: b[:4] for (i, *_), b in zip(docs, brute_bytes([t for _, t, _ in docs], 400))}


def test_op6(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_relative_lz"](spark, SF_SMALL).collect()}
    assert got == {i: b[:3] for (i, *_), b in zip(docs, brute_words([(i, t) for i, t, _ in docs], 13))}


def test_op7(spark, docs):
    got = QUERIES["op7_toxicity"](spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == {i for i, *_ in docs}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_op8(spark, docs, reference):  # noqa: F811
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_byte_bpe"](spark, SF_SMALL).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = {i: reference.encode_ordinary(t or "") for i, t, _ in docs}
    assert got == {i: (len(ids[i]), sha(" ".join(map(str, ids[i])).encode()), sha((t or "").encode())) for i, t, _ in docs}


def test_op12(spark, docs):
    got = {r.doc_id: digest(r) for r in QUERIES["op12_license_scan"](spark, SF_SMALL).collect()}
    assert got == {i: brute_scan(t) for i, t, _ in docs}


def test_op13(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, SF_SMALL).collect()}
    assert got == {i: brute_runs_of(brute_tail(i, t)) for i, t, _ in docs}
    assert sum(r[0] > 0 for r in got.values()) > 0


def test_op7_finds_planted_words_in_rows_held_out(spark, tmp_path):
    """Whole query on planted words, plain and hidden: labels are learned from the other folds only."""
    import random
    import zlib
    rng = random.Random(21)
    hide = [lambda w: w, lambda w: w.replace("i", "1").replace("o", "0"), lambda w: " ".join(w),
            lambda w: w[0] + w[1] * 3 + w[2:], lambda w: w.replace("s", "$") + "!"]
    rows, labels = [], []
    for i in range(3000):
        toxic = i % 8 == 0
        words = rng.choices(CLEAN_WORDS, k=rng.randint(5, 60))
        if toxic:
            # hidden words are learned from plain ones: half of all are plain
            word = rng.choice(BAD_WORDS)
            words.insert(rng.randrange(len(words)), word if rng.random() < 0.5 else rng.choice(hide)(word))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(3000, None), (3001, ""), (3002, " ".join(CLEAN_WORDS))]
    at = f"file:{tmp_path}"
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{at}/documents.parquet")
    # wrong labels in the fold held out: learning from them would show
    wrong = [(i, 1 - y) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, y) for i, y in labels]
    spark.createDataFrame(wrong, "doc_id bigint, toxic int").write.parquet(f"{at}/labels.parquet")
    got = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, at).collect()}
    assert got.keys() == {i for i, _ in rows}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(got[i].score, y) for i, y in labels if got[i].held_out]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    assert len(toxic) > 50 and sum(s >= 0.5 for s in toxic) >= 0.95 * len(toxic)
    assert sum(s >= 0.5 for s in clean) <= 0.01 * len(clean)
    assert sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) >= 0.97 * len(toxic) * len(clean)
    assert all(got[i].predicted == 0 for i in (3000, 3001, 3002))


def test_op11_with_ties_nulls_and_missing_bases_matches_sql(spark, tmp_path):
    import random
    rng = random.Random(5)
    rows = [(c, rng.choice([None, 0, 1, 1, 2, 7]), rng.choice([None, "user", "é"]), rng.choice([None, "", "a b", "ü  x", "long " * 50]))
            for c in range(400) if c % 60 for _ in range(rng.choice([1, 1, 2, 3, 9]))]
    rows += rows[:200] + [(None, 1, "user", "lost")]
    at = f"file:{tmp_path}"
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(f"{at}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    cur = con.execute(ORACLE["op11_conversation_trie"])
    want = rows_of(cur.fetchall(), [c[0] for c in cur.description])
    df = QUERIES["op11_conversation_trie"](spark, at)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == want and len(want) > 500
