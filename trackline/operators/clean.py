"""Cleaning: type coercion, completeness, ranges, de-duplication, quarantine.

All operators are lazy ``DataFrame -> DataFrame`` functions built from native
expressions; the only shuffle is the de-duplication, which is an aggregation
(map-side partial aggregation collapses a hot group of copies before the
exchange, so one repeated report cannot pile up in one task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.functions.parse import to_double, to_long_id, to_timestamp_ntz
from trackline.schema import (CHECK_ANGLE_RANGE, CHECK_SPEED_RANGE, LAT_RANGE, LON_RANGE,
                              NUMERIC_COLUMNS, SPEED_RANGE)

KEY = ["mmsi", "base_datetime"]
REQUIRED = ["base_datetime", "latitude", "longitude", "mmsi"]


def _is_string(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def coerce_types(df: DataFrame) -> DataFrame:
    """Type the text columns: id, time, coordinates, speeds; bad text -> NULL."""
    out = df
    if "mmsi" in df.columns and _is_string(df, "mmsi"):
        out = out.withColumn("mmsi", to_long_id(F.col("mmsi")))
    if "base_datetime" in df.columns:
        dt = df.schema["base_datetime"].dataType
        if isinstance(dt, T.StringType):
            out = out.withColumn("base_datetime", to_timestamp_ntz(F.col("base_datetime")))
        elif isinstance(dt, T.TimestampType):
            out = out.withColumn("base_datetime", F.col("base_datetime").cast("timestamp_ntz"))
    for c in NUMERIC_COLUMNS:
        if c in df.columns and _is_string(df, c):
            out = out.withColumn(c, to_double(F.col(c)))
    return out


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop reports without time, latitude, longitude or MMSI."""
    return df.dropna(subset=REQUIRED)


def valid_coordinates(df: DataFrame) -> DataFrame:
    """Keep latitude in [-90, 90] and longitude in [-180, 180], bounds included."""
    return df.where(F.col("latitude").between(*LAT_RANGE) & F.col("longitude").between(*LON_RANGE))


def valid_speed(df: DataFrame) -> DataFrame:
    """Keep sog in [0, 50]; a NULL or NaN speed is dropped."""
    return df.where(F.col("sog").between(*SPEED_RANGE))


def dedupe_positions(df: DataFrame, order_col: str = "ingest_seq") -> DataFrame:
    """One report per (mmsi, base_datetime): the first in file order.

    Written as an aggregation (``min_by`` on the file-order column) rather
    than a window, so copies are pre-aggregated on the map side.  One
    ``min_by`` per column (not one struct) lets column pruning drop the
    aggregates a consumer does not read.
    """
    rest = [c for c in df.columns if c not in KEY]
    order = F.col(order_col)
    aggs = [(order if c == order_col else F.min_by(F.col(c), order)).alias(c) for c in rest]
    if order_col in rest:
        aggs[rest.index(order_col)] = F.min(order).alias(order_col)
    return df.groupBy(*KEY).agg(*aggs).select(*df.columns)


def sorted_positions(df: DataFrame) -> DataFrame:
    """Output order (mmsi, time); only for presentation, never needed by operators."""
    return df.orderBy("mmsi", "base_datetime")


def clean(df: DataFrame, order_col: str = "ingest_seq", sort: bool = False) -> DataFrame:
    """The full cleaning chain: coerce, complete, coordinates, speed, de-duplicate."""
    out = dedupe_positions(valid_speed(valid_coordinates(drop_incomplete(coerce_types(df)))), order_col)
    return sorted_positions(out) if sort else out


def cleaning_report(raw: DataFrame) -> DataFrame:
    """One row: rows in, rejects per rule (applied in order), duplicates, rows out."""
    typed = coerce_types(raw)
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED])
    bad_coord = ~(F.col("latitude").between(*LAT_RANGE) & F.col("longitude").between(*LON_RANGE))
    bad_speed = ~F.coalesce(F.col("sog").between(*SPEED_RANGE), F.lit(False))
    flagged = typed.select(
        F.when(incomplete, "incomplete").when(bad_coord, "coordinates").when(bad_speed, "speed").alias("_rule"),
        "mmsi", "base_datetime",
    )
    passed = flagged.where(F.col("_rule").isNull())
    # distinct keys among passing rows: grouped (partial aggregation) then counted
    kept = passed.groupBy("mmsi", "base_datetime").agg(F.lit(1).alias("_one"))
    counts = flagged.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("_rule") == "incomplete").alias("rejected_incomplete"),
        F.count_if(F.col("_rule") == "coordinates").alias("rejected_coordinates"),
        F.count_if(F.col("_rule") == "speed").alias("rejected_speed"),
        F.count_if(F.col("_rule").isNull()).alias("rows_valid"),
    )
    rows_out = kept.agg(F.count(F.lit(1)).alias("rows_out"))
    return counts.select(
        "rows_in", "rejected_incomplete", "rejected_coordinates", "rejected_speed",
        (F.col("rows_valid") - rows_out.scalar()).alias("rejected_duplicates"),
        rows_out.scalar().alias("rows_out"),
    )


def constraint_violations(df: DataFrame, keep: str = "violations") -> DataFrame:
    """Quarantine split by the table constraints.

    Adds ``violations`` = comma-separated names of the broken rules, '' when
    none.  ``keep='violations'`` returns only the breaking rows, ``'valid'``
    only the clean ones, ``'all'`` every row.
    """
    def rng(c: str, lo_hi: tuple[float, float], nullable: bool) -> F.Column:
        ok = F.col(c).between(*lo_hi)
        return (F.col(c).isNull() | ok) if nullable else F.coalesce(ok, F.lit(True))

    rules: list[tuple[str, F.Column]] = []
    for c in ["mmsi", "base_datetime", "latitude", "longitude"]:
        if c in df.columns:
            rules.append((f"nn_{c}", F.col(c).isNotNull()))
    checks = [
        ("chk_latitude", "latitude", LAT_RANGE, False),
        ("chk_longitude", "longitude", LON_RANGE, False),
        ("chk_sog", "sog", CHECK_SPEED_RANGE, True),
        ("chk_cog", "cog", CHECK_ANGLE_RANGE, True),
        ("chk_heading", "heading", CHECK_ANGLE_RANGE, True),
    ]
    rules += [(name, rng(c, lo_hi, nullable)) for name, c, lo_hi, nullable in checks if c in df.columns]
    viol = F.concat_ws(",", *[F.when(~ok, F.lit(name)) for name, ok in rules])
    out = df.withColumn("violations", viol)
    if keep == "violations":
        return out.where(F.col("violations") != "")
    if keep == "valid":
        return out.where(F.col("violations") == "")
    return out


def uniqueness_violations(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    key = key or KEY
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def limit_records(df: DataFrame, n: int, order_col: str = "ingest_seq") -> DataFrame:
    """The first ``n`` rows in order of ``order_col`` (of any type that sorts), in that order.

    Two passes, nothing of which runs before the result is read.  The first deals the keys alone into
    ranges, counts each, and adds the counts up in order of the ranges (one row a range): that tells the
    range in which the n-th row lies.  The second keeps the rows of the ranges before it and, by number,
    those of that one range, and sorts what is left.  No task holds more than a range, whatever ``n`` is.
    Of rows with equal keys at the cut any may stay; rows without a key are left out.
    """
    keys = df.select(F.col(order_col).alias("_k")).where("_k is not null").repartitionByRange("_k").select(
        "_k", F.spark_partition_id().alias("_p"))
    ranges = keys.groupBy("_p").agg(F.count(F.lit(1)).alias("n"), F.max("_k").alias("high"))
    in_order = Window.orderBy("high")
    ranges = ranges.select("high", F.lag("high").over(in_order).alias("low"), (F.sum("n").over(in_order) - F.col("n")).alias("before"))
    # the last range that starts before the n-th row
    cut = ranges.where(F.col("before") < n).agg(F.max_by(F.struct("low", "high", "before"), "before").alias("c")).scalar()
    key = F.col(order_col)
    whole = F.coalesce(key <= cut["low"], F.lit(False))
    # rows of whole ranges are spread over groups of their own, since their numbers don't matter
    group = F.when(whole, F.pmod(F.xxhash64(key), F.lit(1 << 16))).otherwise(F.lit(-1))
    number = F.row_number().over(Window.partitionBy(group).orderBy(key))
    rows = df.where(key <= cut["high"]).withColumn("_whole", whole).withColumn("_number", number)
    return rows.where(F.col("_whole") | (F.col("_number") <= F.lit(n) - cut["before"])).select(*df.columns).orderBy(key)
