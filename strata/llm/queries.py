"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (ann, bpe, exact, langid, licenses, mix, periodic, rlz, simhash, suffix, toxicity, trie,
                        warc)
from strata.llm.common import WS, crc_bucket, table

BPE_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Production mixture: a few sources weighted up or down, every other source at weight 1; no source is left out.
MIX_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5, "src3": 0.25}


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    model = langid.prototypes(docs.where(~held_out))
    return (langid.identify(docs, model)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per copy of a whole document: doc_id, lang, source, n_chars, copy, copies, and the SHA-256 of the
    text that the shuffle brought."""
    out = mix.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, keep_rate=True)
    return out.select(
        "doc_id", "lang", "source", "n_chars", "copy", F.col("_copies").alias("copies"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, bits=2)
    return groups.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffix.repeated_bytes(table(spark, sf_dir, "documents"), length=400)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op6_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (rlz.repeated_words(table(spark, sf_dir, "documents"), length=13)
            .select("doc_id", "n_words", "n_removed", "kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity.training(table(spark, sf_dir, "labels")))
    return (toxicity.score(docs, model)
            .select("doc_id", (crc_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BPE_FILE, public_tokenizers.PATTERN)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op10_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.package_round_trip(table(spark, sf_dir, "pages"))
    return back.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(rebuilt_conversations(trie.sequences(table(spark, sf_dir, "conversations"))))


def rebuilt_conversations(seqs: DataFrame) -> DataFrame:
    """Conversation c as the first h turns of conversation c - c % 20, then its own turns after its first h;
    h is crc32(c) % 4."""
    first = seqs.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 3).alias("_first"))
    own = seqs.withColumn("_base", F.col("conv_id") - F.col("conv_id") % 20).withColumn(
        "_h", crc_bucket(F.col("conv_id"), 4).cast("int"))
    none = F.slice("turns", 1, 0)
    return (own.join(first, "_base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("_first", none), F.lit(1), F.col("_h")),
                                        F.slice("turns", F.col("_h") + 1, F.size("turns"))).alias("turns")))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), keep_detections=False)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(repeated_tails(table(spark, sf_dir, "documents")), keep_runs=False)


def repeated_tails(docs: DataFrame) -> DataFrame:
    """Texts whose h = crc32(doc_id) is divisible by 10 repeat their words from a on with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.col("text"), WS), lambda w: w != "")
    tails = (docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("_w"), g.alias("_g"))
             .withColumn("_n", F.size("_w")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
             .withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))))
    tail = F.transform(F.sequence(F.col("_a"), F.col("_n").cast("bigint") - 1),
                       lambda i: F.get("_w", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))
    return tails.select("doc_id", F.when(F.col("_n") > 0, F.array_join(F.concat(
        F.slice("_w", F.lit(1), F.col("_a").cast("int")), tail), " ")).otherwise(F.col("text")).alias("text"))


_weight = "CASE " + " ".join(f"WHEN source = '{s}' THEN {w}" for s, w in MIX_WEIGHTS.items()) + " ELSE 1.0 END"

OP3_SQL = f"""
WITH counts AS (SELECT source, count(*) AS n_rows, {_weight} AS w FROM documents GROUP BY source),
rates AS (SELECT source, CAST(w AS DOUBLE) / sum(CAST(w AS DOUBLE)) OVER () * sum(n_rows) OVER () / n_rows AS rate FROM counts),
pieces AS (SELECT source, rate, greatest(1, CAST(ceil(rate / {mix.PIECE}) AS BIGINT)) AS m FROM rates),
terms AS (SELECT source, m, k, exp(-rate / m) * pow(rate / m, k) / gamma(k + 1) AS p
          FROM pieces, (SELECT unnest(range(0, {mix.TERMS})) AS k)),
cdf AS (SELECT source, m, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS p FROM terms),
lists AS (SELECT source, m, list(p ORDER BY k) AS ps FROM cdf GROUP BY source, m),
draws AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, sha256(coalesce(d.text, '')) AS text_sha256, s.ps,
                 unnest(range(1, s.m + 1)) AS j
          FROM documents d JOIN lists s ON d.source IS NOT DISTINCT FROM s.source),
numbers AS (SELECT doc_id, lang, source, n_chars, text_sha256, ps,
            CAST(('0x' || substr(md5('42|' || doc_id || '|' || j), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u FROM draws),
copies AS (SELECT doc_id, lang, source, n_chars, text_sha256,
                  CAST(sum(len(list_filter(ps, lambda p: p <= u))) AS BIGINT) AS copies
           FROM numbers GROUP BY ALL)
SELECT doc_id, lang, source, n_chars, text_sha256, unnest(range(1, copies + 1)) AS copy, copies FROM copies
"""

OP9_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


OP10_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > least THEN least END AS refers_to
FROM g
"""

# crc32 of decimal digits, bit by bit; equal turns are equal texts of role length, role and text; rows with the same
# turn are in the order of their digests, as in the operator
OP11_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
                      length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 20 AS base,
               xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                   string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
                 lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                   lambda s, z: xor(s >> 1, CASE WHEN s % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS h
        FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT ids.conv_id, t.i AS place, 0 AS own, t.role, t.text FROM ids JOIN t ON t.conv_id = ids.base AND t.i <= h
      UNION ALL SELECT ids.conv_id, t.i, 1, t.role, t.text FROM ids JOIN t ON t.conv_id = ids.conv_id AND t.i > h),
seqs AS (SELECT ids.conv_id, coalesce(s.seq, []) AS seq FROM ids LEFT JOIN (
           SELECT conv_id, list(length(role) || ':' || role || text ORDER BY own, place) AS seq FROM r GROUP BY conv_id) s
         ON ids.conv_id = s.conv_id),
members AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS depth FROM seqs),
nodes AS (SELECT seq[1:depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '') AS ends
          FROM members GROUP BY ALL),
words AS (SELECT DISTINCT length(role) || ':' || role || text AS turn,
                 len(regexp_extract_all(text, '[^ 	-
]+')) AS n FROM r),
kids AS (SELECT k[1:depth - 1] AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT a.*, coalesce(kids.n, 0) AS n_children, coalesce((a.n_convs - 1) * words.n, 0) AS own
          FROM nodes a LEFT JOIN kids ON a.k = kids.k LEFT JOIN words ON a.depth > 0 AND words.turn = a.k[a.depth]),
below AS (SELECT k[1:d] AS k, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
          FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_nodes) GROUP BY 1)
SELECT a.conv_id, a.depth, up.conv_id AS parent_conv_id, a.n_convs, a.n_children, below.leaves AS n_leaves,
       CAST(below.saved AS BIGINT) AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM full_nodes a JOIN below ON a.k = below.k
LEFT JOIN nodes up ON a.depth > 0 AND up.depth = a.depth - 1 AND up.k = a.k[1:a.depth - 1]
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_prefix_forest": op2_prefix_forest,
    "op3_mix_sources": op3_mix_sources,
    "op4_simhash": op4_simhash,
    "op5_suffix_array": op5_suffix_array,
    "op6_relative_lz": op6_relative_lz,
    "op7_toxicity": op7_toxicity,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_warc_zip": op10_warc_zip,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_license_scan": op12_license_scan,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op3_mix_sources": OP3_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op10_warc_zip": OP10_SQL,
    "op11_conversation_trie": OP11_SQL,
}
