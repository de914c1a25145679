"""Track computation: legs between consecutive reports and per-vessel metrics.

A plain ``lag`` window partitioned by vessel puts a whole vessel in one task, and one
busy vessel can hold a large share of all reports.  Tracks are summed up as
*segments* instead: a segment holds its first and last point and the sums over the
legs within, and neighbouring segments merge into one, adding the leg between them.
Merging is associative, so it goes in levels of fixed time slices:

1. ``lag`` inside (mmsi, hour) gives every leg whose ends share an hour (one hash
   exchange; a busy vessel spreads over its hours), and one aggregation on the same
   partitioning makes a segment of every vessel-hour;
2. ``lag`` over a day's segments gives the legs between them, and the day's segments
   become one;
3. likewise a vessel's days.

Slices are cut by the clock and not by counts: no job runs to size them, and results
don't depend on their width.  Reports are one per (vessel, time), so a vessel-hour of
times in whole seconds holds 3,600 at most; finer times can be given finer slices
(``bucket_minutes``).

Times are summed as integer microseconds and turned into hours at the end:
exact, independent of summation order, and docked time is a true zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackline.functions.geo import with_distance
from trackline.schema import MOVING_PAIR_MEAN_KNOTS

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, from its fields.

    Exact and independent of the session time zone (a zone-aware cast would
    shift durations that cross a daylight-saving change).
    """
    ts = F.col(c) if isinstance(c, str) else c
    return (F.unix_date(F.to_date(ts)).cast("long") * F.lit(MICROS_PER_DAY)
            + F.hour(ts).cast("long") * F.lit(3_600_000_000)
            + F.minute(ts).cast("long") * F.lit(60_000_000)
            + (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long"))


def micros_between(a: Column | str, b: Column | str) -> Column:
    return epoch_micros(b) - epoch_micros(a)


def _is_moving(sog_prev: Column, sog: Column) -> Column:
    return ((sog_prev + sog) / 2) >= F.lit(MOVING_PAIR_MEAN_KNOTS)


MINUTE_US = 60_000_000
DAY_MINUTES = 24 * 60


def _slice(minutes: float, time: str = "base_datetime") -> Column:
    return F.floor(epoch_micros(time) / F.lit(int(minutes * MINUTE_US)))


def _sliced_legs(clean: DataFrame, method: str, bucket_minutes: float) -> DataFrame:
    """Every report with the previous report of the same vessel in the same time slice."""
    pts = clean.select("mmsi", "base_datetime", "latitude", "longitude", "sog", "vessel_name", _slice(bucket_minutes).alias("_slice"))
    w = Window.partitionBy("mmsi", "_slice").orderBy("base_datetime")
    legs = pts.select(
        "*",
        F.lag("latitude").over(w).alias("_plat"),
        F.lag("longitude").over(w).alias("_plon"),
        F.lag("sog").over(w).alias("_psog"),
        F.lag("base_datetime").over(w).alias("_pts"),
    )
    return with_distance(legs, "_plat", "_plon", "latitude", "longitude", "_leg_nm", method)


def _segments(legs: DataFrame, with_name: bool = True) -> DataFrame:
    """One segment per (mmsi, slice): sums over its legs, first and last point.

    ``with_name=False`` leaves the name out of the points, so a consumer that also reads the legs themselves
    (``track_legs``) needs the same columns on both sides and Spark reuses one exchange for both.
    """
    has_prev = F.col("_pts").isNotNull()
    dt = micros_between("_pts", "base_datetime")
    point = F.struct("base_datetime", "latitude", "longitude", "sog", *(["vessel_name"] if with_name else []))
    return legs.groupBy("mmsi", "_slice").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("sog").alias("sog_sum"),
        F.max("sog").alias("sog_max"),
        F.min("sog").alias("sog_min"),
        F.coalesce(F.sum("_leg_nm"), F.lit(0.0)).alias("leg_nm"),
        F.count_if(has_prev).alias("legs"),
        F.count_if(has_prev & F.col("_leg_nm").isNull()).alias("failed_legs"),
        F.sum(F.when(has_prev & _is_moving(F.col("_psog"), F.col("sog")), dt).otherwise(F.lit(0))).alias("moving_us"),
        F.min_by(point, F.col("base_datetime")).alias("first"),
        F.max_by(point, F.col("base_datetime")).alias("last"),
    )


def _between(segments: DataFrame, method: str, minutes: float | None) -> DataFrame:
    """Segments with their wider slice (all of time without ``minutes``) and the leg from the one before in it."""
    wider = F.lit(0).cast("long") if minutes is None else _slice(minutes, "first.base_datetime")
    s = segments.drop("_slice").withColumn("_slice", wider)
    own = Window.partitionBy("mmsi", "_slice") if minutes is not None else Window.partitionBy("mmsi")
    s = s.select("*", F.lag("last").over(own.orderBy("first.base_datetime")).alias("_prev"))
    s = s.select(
        "*",
        F.col("_prev.latitude").alias("_lat0"), F.col("_prev.longitude").alias("_lon0"),
        F.col("first.latitude").alias("_lat1"), F.col("first.longitude").alias("_lon1"),
    )
    return with_distance(s, "_lat0", "_lon0", "_lat1", "_lon1", "_between_nm", method)


def _merged(segments: DataFrame, method: str, minutes: float | None) -> DataFrame:
    """Segments merged within wider slices (of a vessel's whole track without ``minutes``)."""
    s = _between(segments, method, minutes)
    has_prev = F.col("_prev").isNotNull()
    dt = micros_between(F.col("_prev.base_datetime"), F.col("first.base_datetime"))
    moving = has_prev & _is_moving(F.col("_prev.sog"), F.col("first.sog"))
    keys = ["mmsi"] if minutes is None else ["mmsi", "_slice"]
    return s.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("sog_sum").alias("sog_sum"),
        F.max("sog_max").alias("sog_max"),
        F.min("sog_min").alias("sog_min"),
        (F.sum("leg_nm") + F.coalesce(F.sum("_between_nm"), F.lit(0.0))).alias("leg_nm"),
        (F.sum("legs") + F.count_if(has_prev)).alias("legs"),
        (F.sum("failed_legs") + F.count_if(has_prev & F.col("_between_nm").isNull())).alias("failed_legs"),
        (F.sum("moving_us") + F.sum(F.when(moving, dt).otherwise(F.lit(0)))).alias("moving_us"),
        F.min_by("first", F.col("first.base_datetime")).alias("first"),
        F.max_by("last", F.col("last.base_datetime")).alias("last"),
    )


def vessel_summary(clean: DataFrame, method: str = "geodesic", bucket_minutes: float = 60) -> DataFrame:
    """All per-vessel track figures (metrics, extents, leg counts), unrounded; nothing runs until it is read."""
    segments = _segments(_sliced_legs(clean, method, bucket_minutes))
    if bucket_minutes < DAY_MINUTES:
        segments = _merged(segments, method, DAY_MINUTES)
    whole = _merged(segments, method, None)
    total_us = micros_between(F.col("first.base_datetime"), F.col("last.base_datetime"))
    hours = F.lit(float(MICROS_PER_HOUR))
    return whole.select(
        "mmsi",
        F.coalesce(F.col("first.vessel_name"), F.lit("Unknown")).alias("vessel_name"),
        F.col("leg_nm").alias("total_distance_nm"),
        (total_us / hours).alias("total_time_hours"),
        (F.col("moving_us") / hours).alias("moving_time_hours"),
        ((total_us - F.col("moving_us")) / hours).alias("at_dock_time_hours"),
        F.col("n").alias("point_count"),
        (F.col("sog_sum") / F.col("n")).alias("avg_speed_knots"),
        F.col("sog_max").alias("max_speed_knots"),
        F.col("sog_min").alias("min_speed_knots"),
        F.col("first.base_datetime").alias("first_position_time"),
        F.col("last.base_datetime").alias("last_position_time"),
        F.col("first.latitude").alias("start_latitude"),
        F.col("first.longitude").alias("start_longitude"),
        F.col("last.latitude").alias("end_latitude"),
        F.col("last.longitude").alias("end_longitude"),
        F.col("legs").alias("leg_count"),
        "failed_legs",
    )


METRIC_COLUMNS = [
    "mmsi", "vessel_name", "total_distance_nm", "total_time_hours", "moving_time_hours",
    "at_dock_time_hours", "point_count", "avg_speed_knots", "max_speed_knots",
]
EXTENT_COLUMNS = [
    "mmsi", "min_speed_knots", "first_position_time", "last_position_time",
    "start_latitude", "start_longitude", "end_latitude", "end_longitude",
]


def vessel_metrics(clean: DataFrame, method: str = "geodesic", bucket_minutes: float = 60, extended: bool = False) -> DataFrame:
    """Per-vessel metrics: distance, total/moving/docked hours, points, speeds.

    ``extended=True`` adds the extent columns (min speed, first/last time and
    position) declared by the stored metrics table.
    """
    s = vessel_summary(clean, method, bucket_minutes)
    cols = METRIC_COLUMNS + (EXTENT_COLUMNS[1:] if extended else [])
    return s.select(*cols)


def vessel_extents(clean: DataFrame, bucket_minutes: float = 60) -> DataFrame:
    """Min speed, first/last time and first/last position per vessel."""
    return vessel_summary(clean, "haversine", bucket_minutes).select(*EXTENT_COLUMNS)


def vessel_distance(clean: DataFrame, method: str = "geodesic", bucket_minutes: float = 60) -> DataFrame:
    """Total distance per vessel plus leg counts (legs without a distance, which only non-numbers make, are skipped)."""
    return vessel_summary(clean, method, bucket_minutes).select(
        "mmsi", "total_distance_nm", "leg_count", "failed_legs")


def vessel_time_split(clean: DataFrame, bucket_minutes: float = 60) -> DataFrame:
    """Total, moving and docked hours per vessel."""
    return vessel_summary(clean, "haversine", bucket_minutes).select(
        "mmsi", "total_time_hours", "moving_time_hours", "at_dock_time_hours", "point_count")


def track_legs(clean: DataFrame, method: str = "geodesic", bucket_minutes: float = 60) -> DataFrame:
    """One row per leg: vessel, start and end time, distance (nm), elapsed micros, moving flag."""
    legs = _sliced_legs(clean, method, bucket_minutes)
    inner = legs.where(F.col("_pts").isNotNull()).select(
        "mmsi",
        F.col("_pts").alias("from_time"),
        F.col("base_datetime").alias("to_time"),
        F.col("_leg_nm").alias("leg_nm"),
        micros_between("_pts", "base_datetime").alias("elapsed_us"),
        _is_moving(F.col("_psog"), F.col("sog")).alias("moving"),
    )
    cross = _between(_segments(legs, with_name=False), method, None).where(F.col("_prev").isNotNull()).select(
        "mmsi",
        F.col("_prev.base_datetime").alias("from_time"),
        F.col("first.base_datetime").alias("to_time"),
        F.col("_between_nm").alias("leg_nm"),
        micros_between(F.col("_prev.base_datetime"), F.col("first.base_datetime")).alias("elapsed_us"),
        _is_moving(F.col("_prev.sog"), F.col("first.sog")).alias("moving"),
    )
    return inner.unionByName(cross)


def recent_positions(positions: DataFrame, n: int = 100, mmsi: int | None = None) -> DataFrame:
    """Latest ``n`` reports per vessel (or of one vessel), newest first.

    For all vessels this is ``row_number() <= n`` in two levels, both planned
    as WindowGroupLimit (every map task keeps only its own top ``n`` per group
    before the exchange): first per (vessel, day), which spreads a busy vessel
    over its days, then per vessel over at most ``n`` x days rows.
    """
    cols = ["mmsi", "base_datetime", "latitude", "longitude", "sog", "cog", "heading", "vessel_name", "status"]
    cols = [c for c in cols if c in positions.columns]
    if mmsi is not None:
        return (positions.where(F.col("mmsi") == F.lit(mmsi)).select(*cols)
                .orderBy(F.col("base_datetime").desc()).limit(n))
    newest = F.col("base_datetime").desc()
    w_day = Window.partitionBy("mmsi", F.to_date("base_datetime")).orderBy(newest)
    per_day = positions.select(*cols, F.row_number().over(w_day).alias("_r")).where(F.col("_r") <= n)
    w = Window.partitionBy("mmsi").orderBy(newest)
    return (per_day.select(*cols, F.row_number().over(w).alias("recency_rank"))
            .where(F.col("recency_rank") <= n))
