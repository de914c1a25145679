"""What a load brought in: size, vessels, time span, types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.operators.fleet import distinct_count


def load_profile(positions: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """One row: total_rows, column_count, unique_vessels, first_time, last_time (NULL times and vessels don't count)."""
    return positions.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(positions.columns)).alias("column_count"),
        distinct_count("mmsi", approx_distinct).alias("unique_vessels"),
        F.min("base_datetime").alias("first_time"),
        F.max("base_datetime").alias("last_time"),
    )


def top_vessel_types(positions: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` vessel types with most positions, ties by name."""
    return (positions.where(F.col("vessel_type").isNotNull()).groupBy("vessel_type")
            .agg(F.count(F.lit(1)).alias("positions"))
            .orderBy(F.col("positions").desc(), F.col("vessel_type").asc()).limit(n))


def column_fill(positions: DataFrame) -> DataFrame:
    """column, filled and share of rows that are not NULL, for every column; one pass."""
    rows = F.count(F.lit(1))
    filled = positions.agg(rows.alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(positions.columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("filled")) for i, c in enumerate(positions.columns)])
    return filled.select("_rows", F.explode(cells).alias("c")).select(
        "c.column", "c.filled", F.coalesce(F.try_divide("c.filled", "_rows"), F.lit(0.0)).alias("share"))
