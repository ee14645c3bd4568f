"""Raw CSV scans: headered, every column a string, schema given (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.specs import ENTITIES, Entity


def read_raw_csv(spark: SparkSession, path: str, entity: Entity, spread: int | None = None) -> DataFrame:
    """Scan one raw entity.

    Plain files are splittable, so a large CSV is read by many tasks. Entities
    with free text (reviews) need ``multiLine`` with ``"`` as quote and escape;
    such a file is parsed by one task, so a large drop should be many files.
    ``spread`` deals the rows of such an entity to so many partitions for the
    steps that follow the parse; give it when a drop has few files.
    """
    # enforceSchema=False: every file's header is checked against the schema,
    # so a file with reordered or renamed columns fails instead of being read
    # by position under the wrong names.
    reader = (spark.read.schema(entity.raw_schema)
              .option("header", True)
              .option("enforceSchema", False))
    if not entity.multiline:
        return reader.csv(path)
    df = (reader.option("multiLine", True)
          .option("quote", '"')
          .option("escape", '"')
          .csv(path))
    return df.repartition(spread) if spread else df


def write_raw_csv(df: DataFrame, path: str, entity: Entity) -> None:
    """Write a raw entity as headered CSV (used to stage raw drops).

    Surrounding blanks are kept (the writer strips them by default), so a
    padded or whitespace-only value survives the round trip as the raw file
    would carry it.
    """
    (df.write.mode("overwrite")
     .option("header", True)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .option("quote", '"')
     .option("escape", '"')
     .csv(path))


def read_raw_drop(spark: SparkSession, root: str, spread: int | None = None) -> dict[str, DataFrame]:
    """The nine raw entities of one drop, ``<root>/<entity>/`` each."""
    return {name: read_raw_csv(spark, f"{root}/{name}", e, spread) for name, e in ENTITIES.items()}
