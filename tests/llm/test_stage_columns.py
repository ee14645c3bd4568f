"""The pipeline's stages return the columns of documents, whatever else a table holds."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import bpe, exact, mix, simhash
from tests.conftest import SF_SMALL

CLASHING = ["_key", "_n", "k", "n", "row", "id", "score", "predicted", "copy", "copies", "_copies", "_rate", "_u", "_s",
            "_cdf", "_pieces", "order", "_order", "root", "fp", "tag", "recipe", "keep_id", "text_sha", "_t", "t", "y"]


@pytest.fixture(scope="module")
def docs(spark):
    extra = spark.createDataFrame(
        [(9001, None, "en", "src0", 0), (9002, "", None, None, None), (None, "no id here", "en", "src1", 9),
         (9003, "the same row twice", "en", "src1", 1), (9003, "the same row twice", "en", "src1", 1)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return table.select(*extra.columns).union(extra)


def told(df, names):
    return sorted(tuple(map(str, r)) for r in df.select(*names).collect())


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_clashing_columns_come_back_as_they_were(spark, docs, stage):
    plain = stage(spark, docs, SF_SMALL)
    more = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
                             for c in CLASHING})
    out = stage(spark, more, SF_SMALL)
    assert out.columns == more.columns and out.schema == more.schema
    assert told(out, docs.columns) == told(plain, docs.columns)
    for r in out.collect():
        for c in CLASHING:
            assert r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}"
    assert stage(spark, more.limit(0), SF_SMALL).count() == 0


def test_last_stage_beside_clashing_columns(spark, docs):
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    few = docs.where("doc_id % 10 = 1 or doc_id > 9000 or doc_id is null")
    more = few.withColumns({c: F.lit(1) for c in (*CLASHING, *names[1:], "token_ids")})
    assert told(corpus_pipeline.tokenize(spark, more, SF_SMALL), names) == told(
        corpus_pipeline.tokenize(spark, few, SF_SMALL), names)


def test_mix_numbers_its_copies_only_if_asked(spark, docs):
    more = docs.withColumn("copy", F.lit("own")).withColumn("_rate", F.lit("own"))
    assert mix.mix(more, copy_col=None).columns == more.columns
    assert {r.copy for r in mix.mix(more, copy_col=None).select("copy").distinct().collect()} == {"own"}
    out = mix.mix(more, keep_rate=True)       # the columns added replace those of their names
    assert out.columns == [*docs.columns, "copy", "_rate", "_copies"]
    assert dict(out.dtypes)["copy"] == "bigint" and dict(out.dtypes)["_rate"] == "double"


@pytest.mark.parametrize("dedup", [exact.exact_dedup, simhash.near_dedup])
def test_repeated_rows_are_limited_below_the_join(spark, dedup):
    """A row that a third of the table repeats sends one row per task."""
    text = F.when(F.col("id") % 3 == 0, "hot text of one id").otherwise(F.concat(F.lit("text number "), F.col("id").cast("string")))
    docs = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("doc_id"),
                                             text.alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = dedup(docs)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [x.lstrip(" :+-") for x in buf.getvalue().splitlines()]
    join = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    limits = [i for i, x in enumerate(lines) if x.startswith("WindowGroupLimit")]
    assert len(limits) == 2 and all(i > join for i in limits)
    exchange = next(i for i, x in enumerate(lines) if i > limits[0] and x.startswith("Exchange"))
    assert limits[0] < exchange < limits[1]
    if dedup is exact.exact_dedup:
        assert df.count() == 2001


def test_bpe_needs_no_more_than_id_and_text(spark, docs):
    assert bpe.round_trip(docs.select("doc_id", "text").limit(3), corpus_pipeline.BPE_FILE,
                          corpus_pipeline.public_tokenizers.PATTERN).count() == 3
