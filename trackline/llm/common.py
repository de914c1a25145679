"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    A written table cuts the lineage: a lost executor re-runs only tasks of the
    step that is running, and several consumers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_text(name: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def slices_by_bytes(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to ``limit`` at most (one item at least)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
