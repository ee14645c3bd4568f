import hashlib
import random
import uuid
from collections import Counter

import pytest

import corpus_pipeline
from strata.llm import mix
from strata.session import scratch_path
from tests.llm.test_bpe import reference  # noqa: F401  (fixture)
from tests.llm.test_exact import brute as exact_groups
from tests.llm.test_mix import brute_copies
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_toxicity import BAD, sentence

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(12)
    rows = []
    for i in range(900):
        rows.append((i, sentence(rng, rng.choice(BAD) if i % 5 == 0 else None, 60), f"src{rng.randrange(6)}"))
    for i in range(900, 1000):  # exact and near copies, some with other white space
        t = rows[rng.randrange(900)][1]
        kind = i % 3
        rows.append((i, t if kind == 0 else t.replace(" ", "\n ", 3) if kind == 1 else t + " " + rng.choice(["a", "b"]),
                     f"src{rng.randrange(6)}"))
    return rows + [(1300, None, "src1"), (1301, "", "src2"), (1302, "  ", None), (1303, "one", "src0")]


def brute(rows, reference):  # noqa: F811
    rows = [r for r in rows if not any(b in (r[1] or "") for b in BAD)]
    kept = {g[0] for g in exact_groups([(i, t) for i, t, _ in rows]) if g[3]}
    rows = [r for r in rows if r[0] in kept]
    component = brute_components({i: brute_fingerprint(t) for i, t, _ in rows}, 2)
    rows = [r for r in rows if component[r[0]] == r[0]]
    n = Counter(s for *_, s in rows)
    w = {s: corpus_pipeline.MIX_WEIGHTS.get(s, 1.0) for s in n}
    out = Counter()
    for i, t, s in rows:
        copies = brute_copies(i, w[s] / sum(w.values()) * len(rows) / n[s])
        ids = reference.encode_ordinary(t or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        if copies:
            out[(i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))] = copies
    return out


@pytest.fixture(scope="module")
def folder(spark):
    rows = corpus()
    at = scratch_path(spark, f"sf-{uuid.uuid4().hex}")
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], COLUMNS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(any(b in (t or "") for b in BAD))) for i, t, _ in rows],
                          "doc_id bigint, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def test_run_equals_brute_force(spark, folder, reference):  # noqa: F811
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                  for r in corpus_pipeline.run(spark, folder).collect())
    assert got == brute(corpus(), reference)


def test_stages_keep_columns_and_take_empty_tables(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mix_sources", "byte_bpe"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0
        if name != "byte_bpe":
            assert out.columns == docs.columns
    assert corpus_pipeline.ORACLE_SQL is None and mix.PIECE > 0


def test_entry_registers_all(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
