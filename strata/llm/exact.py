"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

A text is cut where its own content says so, each distinct chunk gets an
identifier, and texts are compared by their ordered lists of identifiers. Long
texts are never moved as such: chunk contents are reduced to distinct ones in
the map tasks and cross the network once, to verify the identifiers; after
that only identifier lists move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, one_row_per_key

MIN_CHUNK, MAX_CHUNK = 512, 4096


def _residues(mod: int, rest: int) -> str:
    return "".join(f"\\x{{{c:X}}}" for c in range(0x20, 0x250) if c % mod == rest)


# A cut falls after three characters whose code points have fixed residues
# (about one place in a hundred of running text). Text beyond these blocks is
# cut every MAX_CHUNK characters.
BOUNDARY = f"(?<=[{_residues(5, 0)}][{_residues(5, 1)}{_residues(5, 2)}][{_residues(5, 4)}])"
CHUNK = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:{BOUNDARY}|\\z)|.{{{MAX_CHUNK}}}|.+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as ''. (Single spaces need no replacing.)"""
    return F.regexp_replace(F.coalesce(text, F.lit("")),
                            r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk.cast("binary"), 256))


def unverified(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row, ``n``: identifiers that stand for more than one chunk content.

    The contents themselves are compared: a row per identifier and content,
    made distinct in the map tasks, so that a chunk which a third of all
    documents hold arrives once per task.
    """
    pieces = (docs.select(F.explode(chunks(normalised(F.col(text_col)))).alias("chunk"))
              .select(identifier(F.col("chunk")).alias("chunk_id"), "chunk").distinct())
    return (pieces.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("contents"))
            .where("contents > 1").agg(F.count(F.lit(1)).alias("n")))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, recipe array<binary>, text_sha256; fails if an identifier is not unique to its chunk."""
    checked = unverified(docs, text_col).select(F.col("n")).scalar()
    return (docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
            .select("id", F.transform(chunks(F.col("t")), identifier).alias("recipe"),
                    F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"))
            .where(F.when(checked > 0, F.raise_error(F.lit("two chunks share an identifier")).cast("boolean"))
                   .otherwise(F.lit(True))))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` is
    one space; null counts as empty. The smallest id of a group stays (null
    ids are larger than any other; if all are null keep_id is null and ``kept``
    is true for each of them). Rows that repeat the kept id are all marked
    kept: the operator decides by id. Texts of any length are read whole; a row
    holds 32 bytes per chunk of 512 to 4,096 characters. An empty table gives
    no rows.
    """
    rows = cut(recipes(docs, id_col, text_col))
    groups = rows.groupBy("recipe").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # the second key makes the join deal both sides anew, so adaptive execution can split a hot text
    tag = lambda df: df.withColumn("tag", F.xxhash64("recipe"))
    return (tag(rows).join(tag(groups), ["tag", "recipe"])
            .select(F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text repeats that of a smaller id; ids that repeat are kept once.

    Of rows that share both text and id one stays. Columns are those of ``docs``, whatever their names. Null
    texts count as empty, a null id as larger than any other. Texts of any length are compared whole, by the
    identifiers of their chunks. An empty table stays empty.
    """
    key = lambda i, sha: F.concat_ws("|", sha, F.coalesce(i.cast("string"), F.lit("~")))
    keep = (exact_groups(docs, id_col, text_col).where("kept")
            .select(key(F.col(id_col), F.col("text_sha256")).alias("k")).distinct())
    sha = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    return one_row_per_key(docs, key(F.col(id_col), sha), keep)
