"""Traffic views: recent summary, active vessels, daily rollup.

"Now" is a parameter (``as_of``).  When it is not given it is the latest
report time in the data, attached as a scalar subquery, so results are
repeatable.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions.numeric import ntz_literal

from trackline.operators.fleet import distinct_count, pct
from trackline.schema import MOVING_POINT_KNOTS


def _as_of(positions: DataFrame, as_of: dt.datetime | None) -> Column:
    if as_of is not None:
        return ntz_literal(as_of)
    return positions.agg(F.max("base_datetime")).scalar()


def traffic_summary(positions: DataFrame, as_of: dt.datetime | None = None, days: int = 30,
                    approx_distinct: bool = False) -> DataFrame:
    """Reports since midnight ``days`` days before the as-of date: vessels, reports, speeds."""
    now = _as_of(positions, as_of)
    since = F.date_sub(F.to_date(now), days).cast("timestamp_ntz")
    recent = positions.where(F.col("base_datetime") >= since)
    base = recent.agg(
        distinct_count("mmsi", approx_distinct).alias("total_vessels"),
        F.count(F.lit(1)).alias("total_positions"),
        F.min("base_datetime").alias("earliest_position"),
        F.max("base_datetime").alias("latest_position"),
        F.avg("sog").alias("avg_speed_fleet"),
        F.max("sog").alias("max_speed_recorded"),
        F.count_if(F.col("sog") > MOVING_POINT_KNOTS).alias("_moving"),
    )
    return base.select(
        "total_vessels", "total_positions", "earliest_position", "latest_position",
        "avg_speed_fleet", "max_speed_recorded",
        pct(F.col("_moving"), F.col("total_positions")).alias("moving_percentage"),
    )


def active_vessels(positions: DataFrame, metrics: DataFrame, as_of: dt.datetime | None = None,
                   hours: int = 24) -> DataFrame:
    """Vessels seen in the last ``hours``: reports, last seen, mean speed, with their metrics.

    Reports are aggregated per (mmsi, name) before the join; metrics hold one
    row per vessel, so this equals grouping the joined rows.
    """
    now = _as_of(positions, as_of)
    since = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    recent = positions.where(F.col("base_datetime") >= since).groupBy("mmsi", "vessel_name").agg(
        F.count(F.lit(1)).alias("recent_positions"),
        F.max("base_datetime").alias("last_seen"),
        F.avg("sog").alias("avg_speed"),
    )
    m = metrics.select("mmsi", "total_distance_nm", "point_count")
    return (recent.join(m, "mmsi", "left")
            .orderBy(F.col("last_seen").desc(), F.col("mmsi").asc(), F.col("vessel_name").asc_nulls_first()))


def daily_traffic(positions: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Per UTC date: vessels, reports, mean/max speed, moving (> 1 kn) and stationary (<= 1 kn) reports."""
    sog = F.col("sog")
    return (positions.groupBy(F.to_date("base_datetime").alias("traffic_date")).agg(
        distinct_count("mmsi", approx_distinct).alias("unique_vessels"),
        F.count(F.lit(1)).alias("total_positions"),
        F.avg(sog).alias("avg_speed"),
        F.max(sog).alias("max_speed"),
        F.count_if(sog > MOVING_POINT_KNOTS).alias("moving_positions"),
        F.count_if(sog <= MOVING_POINT_KNOTS).alias("stationary_positions"),
    ).orderBy(F.col("traffic_date").desc()))
