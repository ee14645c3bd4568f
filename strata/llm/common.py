"""Helpers shared by the training-data operators: reading, row keys, lineage cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import shared_dir

WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    Survives lost executors (the files are reliable storage), and Spark's
    context cleaner removes them when the frame is no longer referenced
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    shared_dir(df.sparkSession)  # sets a folder of our own only where none is named
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job wrote, through the file system that Spark uses for it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """``more`` and the whole row as one struct ``row``, so that no name of ours meets one of the input."""
    return df.select(*more, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def one_row_per_key(docs: DataFrame, key: Column, keep: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``key`` that ``keep`` (a column ``k``) holds, with the columns of ``docs``.

    Rows are numbered before the join: the limit runs below the exchange, so a
    key that a third of all rows repeat sends one row per task.
    """
    numbered = packed(docs, key.alias("k")).withColumn(
        "n", F.row_number().over(Window.partitionBy("k").orderBy("k"))).where("n = 1")
    return numbered.join(keep, "k", "left_semi").select("row.*")


def crc_bucket(id_col: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)
