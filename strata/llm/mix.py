"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every document is repeated a Poisson-distributed number of times whose mean is
its source's repetition rate (target share / present share). The Poisson
variable is the inverse distribution function at a uniform number hashed from
the document's id, so a rerun or a retried task gives the same mixture.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import packed

PIECE = 8.0             # a larger mean is the sum of independent pieces of at most this mean
TERMS = 64              # terms of one piece's distribution; the mass beyond is below 2**-52
MAX_BROADCAST = 10_000  # rates of up to this many sources are broadcast


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the md5 of the parts."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def cumulative(mean: Column) -> Column:
    """P(X <= k) for k = 0..TERMS-1 as an array, summed in rising order of k."""
    term = [F.exp(-mean) * F.pow(mean, F.lit(float(k))) / F.lit(float(math.factorial(k))) for k in range(TERMS)]
    return F.array(*term)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, default: float = 1.0,
          size: float = 1.0, source_col: str = "source") -> DataFrame:
    """source, n_rows, rate: the mean number of copies of each row of a source.

    The target share of a source is its weight over the sum of the weights of
    the sources present; the target number of rows is ``size`` times the input.
    """
    if default < 0 or size < 0 or any(w < 0 for w in (weights or {}).values()):
        raise ValueError("weights and size must not be negative")
    weight = F.lit(float(default))
    for name, w in (weights or {}).items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    counts = (docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("w", weight))
    rows_all = counts.select(F.sum("n_rows").cast("double")).scalar()
    w_all = counts.select(F.sum("w")).scalar()
    return counts.select("source", "n_rows",
                         F.when(w_all > 0, F.col("w") / w_all * F.lit(float(size)) * rows_all / F.col("n_rows"))
                         .otherwise(F.lit(0.0)).alias("rate"))


def with_copies(docs: DataFrame, weights: dict[str, float] | None = None, default: float = 1.0,
                size: float = 1.0, seed: int = 42, id_col: str = "doc_id",
                source_col: str = "source") -> DataFrame:
    """``docs`` with ``_rate`` double and ``_copies`` long; every row stays.

    A null source is a source of its own. Rows that repeat an id get the same
    number of copies. A mean above PIECE is drawn as a sum of ceil(mean/PIECE)
    pieces, each with its own hash.
    """
    table = rates(docs, weights, default, size, source_col).select(
        F.col("source").alias("_s"), F.col("rate").alias("_rate"),
        F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PIECE))).cast("long").alias("_pieces"))
    table = table.withColumn("_cdf", _running(cumulative(F.col("_rate") / F.col("_pieces"))))
    sources = docs.select(source_col).distinct().limit(MAX_BROADCAST + 1).count()
    if sources <= MAX_BROADCAST:
        table = F.broadcast(table)  # at most MAX_BROADCAST rows of about 600 bytes
    # beyond: a shuffled join on the source, whose hot keys adaptive execution splits
    joined = docs.join(table, F.col(source_col).eqNullSafe(F.col("_s")), "left").drop("_s")
    one = lambda j: F.size(F.filter(F.col("_cdf"), lambda c: c <= uniform(F.lit(seed), F.col(id_col), j)))
    # one piece is the common case and needs no higher-order sum
    u = uniform(F.lit(seed), F.col(id_col), F.lit(1))
    joined = joined.withColumn("_u", u)
    first = F.size(F.filter(F.col("_cdf"), lambda c: c <= F.col("_u")))
    more = F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.col("_pieces"), F.lit(1))), one),
                       F.lit(0), lambda a, x: a + x)
    return (joined.withColumn("_copies", F.when(F.col("_pieces") == 1, first).otherwise(more).cast("long"))
            .drop("_cdf", "_pieces", "_u"))


def _running(terms: Column) -> Column:
    start = F.struct(F.lit(0.0).alias("s"), F.array().cast("array<double>").alias("a"))
    step = lambda acc, t: F.struct((acc["s"] + t).alias("s"),
                                   F.concat(acc["a"], F.array(acc["s"] + t)).alias("a"))
    return F.aggregate(terms, start, step, lambda acc: acc["a"])


def mix(docs: DataFrame, weights: dict[str, float] | None = None, default: float = 1.0, size: float = 1.0,
        seed: int = 42, partitions: int | None = None, keep_rate: bool = False,
        id_col: str = "doc_id", source_col: str = "source", copy_col: str | None = "copy") -> DataFrame:
    """The mixture: each row once per copy, with its number (from 1) as ``copy_col``, globally shuffled.

    The shuffle deals rows by a hash of seed, id and copy and sorts each
    partition by that hash, which is a random order over the whole output in
    one exchange. ``keep_rate`` adds ``_rate`` and ``_copies``; ``copy_col=None``
    adds no number. Columns of the input keep their names and values, but for
    one that has the name of a column added, which gives way. Null ids hash as
    one fixed text; texts of any length move with their row; an empty table
    stays empty.
    """
    rows = packed(docs, F.col(id_col).alias("id"), F.col(source_col).alias("source"))
    out = (with_copies(rows, weights, default, size, seed, "id", "source")
           .where(F.col("_copies") > 0)
           .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
           .withColumn("order", F.md5(F.concat_ws("|", F.lit(f"order {seed}"),
                                                  F.coalesce(F.col("id").cast("string"), F.lit("~")),
                                                  F.col("copy").cast("string")).cast("binary"))))
    out = out.repartition(partitions, "order") if partitions else out.repartition("order")
    added = {**({copy_col: "copy"} if copy_col else {}), **({"_rate": "_rate", "_copies": "_copies"} if keep_rate else {})}
    return (out.sortWithinPartitions("order")
            .select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added],
                    *[F.col(own).alias(name) for name, own in added.items()]))
