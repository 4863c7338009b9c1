"""Helpers shared by the text operators: reading, staging, size checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.session import remove_path, scratch_path, ship_package

# The six ASCII white-space characters 0x20 and 0x09-0x0D. A word is a longest
# run of anything else; ``bytes.split()`` cuts UTF-8 text at exactly these.
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# A written table is broadcast only up to this many rows (a few ten bytes each).
BROADCAST_ROWS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)  # the operators' tasks import this package
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: cuts the
    lineage (a lost executor does not undo finished work) and gives exact sizes.
    ``made`` gets the folder, for :func:`discard` once nothing reads it."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, made: list[str]) -> None:
    """Removes staged folders that later staged tables have replaced."""
    while made:
        remove_path(spark, made.pop())


def broadcast_if_small(staged_df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a staged table for broadcast when its counted rows are within the
    bound; otherwise leave the join to the planner (sort-merge, skew splitting)."""
    return F.broadcast(staged_df) if staged_df.count() <= rows else staged_df


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in taken:
        k += 1
        name = f"{base}_{k}"
    return name


def text_of(col: str | Column) -> Column:
    """The text, NULL read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")


def row_key(*cols: Column) -> Column:
    """A 64-bit key of a row's own content. Only used together with doc_id, to
    tell apart rows that share one; equal rows share it and fare alike."""
    return F.xxhash64(*cols)
