"""Fleet-level reports over the metrics and positions tables.

Each report is one global aggregation (partial aggregation in every task, a
single tiny final merge).  Percentages are zero-guarded; an empty input gives
a row of zeros, never an error.  Reports that combine sections attach the
other one-row sections as scalar subqueries (no joins between one-row frames).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackline.functions.numeric import round_half_up
from trackline.schema import LAT_RANGE, LON_RANGE, SPEED_RANGE


def pct(part: Column, whole: Column) -> Column:
    """(part / whole) * 100, 0 when whole is 0 or NULL."""
    return F.coalesce(F.try_divide(part.cast("double"), whole) * F.lit(100.0), F.lit(0.0))


def _z(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _zd(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def time_analysis(metrics: DataFrame) -> DataFrame:
    """Moving vs docked hours over vessels with total time > 0."""
    base = metrics.where(F.col("total_time_hours") > 0).agg(
        F.sum("moving_time_hours").alias("total_moving_time"),
        F.sum("at_dock_time_hours").alias("total_dock_time"),
        F.sum("total_time_hours").alias("total_time"),
        F.avg("moving_time_hours").alias("avg_moving_time_per_vessel"),
        F.avg("at_dock_time_hours").alias("avg_dock_time_per_vessel"),
        F.count(F.lit(1)).alias("vessels_count"),
    )
    return base.select(
        _zd(F.col("total_moving_time")).alias("total_moving_time"),
        _zd(F.col("total_dock_time")).alias("total_dock_time"),
        _zd(F.col("total_time")).alias("total_time"),
        _zd(F.col("avg_moving_time_per_vessel")).alias("avg_moving_time_per_vessel"),
        _zd(F.col("avg_dock_time_per_vessel")).alias("avg_dock_time_per_vessel"),
        "vessels_count",
        pct(F.col("total_moving_time"), F.col("total_time")).alias("moving_time_percentage"),
        pct(F.col("total_dock_time"), F.col("total_time")).alias("dock_time_percentage"),
    )


def distinct_count(c: str, approx: bool = False) -> Column:
    """Exact COUNT(DISTINCT c), or HyperLogLog++ (``approx_count_distinct``) when ``approx``."""
    return F.approx_count_distinct(c) if approx else F.count_distinct(c)


def data_quality(positions: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Share of valid positions, speeds, names and timestamps; overall score."""
    lat, lon, sog = F.col("latitude"), F.col("longitude"), F.col("sog")
    base = positions.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(lat.isNotNull() & lon.isNotNull() & lat.between(*LAT_RANGE) & lon.between(*LON_RANGE))
        .alias("valid_positions"),
        F.count_if(sog.isNotNull() & (sog >= SPEED_RANGE[0]) & (sog <= SPEED_RANGE[1])).alias("valid_speeds"),
        F.count_if(F.col("vessel_name").isNotNull() & (F.col("vessel_name") != "")).alias("valid_names"),
        F.count_if(F.col("base_datetime").isNotNull()).alias("valid_timestamps"),
        distinct_count("mmsi", approx_distinct).alias("unique_vessels"),
    )
    t = F.col("total_records")
    out = base.select(
        "*",
        pct(F.col("valid_positions"), t).alias("valid_positions_percentage"),
        pct(F.col("valid_speeds"), t).alias("valid_speeds_percentage"),
        pct(F.col("valid_names"), t).alias("valid_names_percentage"),
        pct(F.col("valid_timestamps"), t).alias("valid_timestamps_percentage"),
    )
    return out.withColumn(
        "overall_quality_score",
        (F.col("valid_positions_percentage") + F.col("valid_speeds_percentage")
         + F.col("valid_timestamps_percentage")) / F.lit(3.0),
    )


def point_statistics(metrics: DataFrame) -> DataFrame:
    """Points per vessel: count of vessels, mean, min, max, sample stddev (NULL -> 0)."""
    m = metrics.where(F.col("point_count").isNotNull())
    base = m.agg(
        F.count_distinct("mmsi").alias("total_vessels"),
        F.avg("point_count").alias("avg_points_per_vessel"),
        F.min("point_count").alias("min_points_per_vessel"),
        F.max("point_count").alias("max_points_per_vessel"),
        F.stddev_samp("point_count").alias("stddev_points_per_vessel"),
    )
    return base.select(
        "total_vessels",
        _zd(F.col("avg_points_per_vessel")).alias("avg_points_per_vessel"),
        _z(F.col("min_points_per_vessel")).alias("min_points_per_vessel"),
        _z(F.col("max_points_per_vessel")).alias("max_points_per_vessel"),
        _zd(F.col("stddev_points_per_vessel")).alias("stddev_points_per_vessel"),
    )


def fleet_additional(metrics: DataFrame) -> DataFrame:
    """Speed and distance figures over vessels that moved (distance > 0)."""
    m = metrics.where(F.col("total_distance_nm").isNotNull() & (F.col("total_distance_nm") > 0))
    base = m.agg(
        F.avg("avg_speed_knots").alias("fleet_avg_speed"),
        F.max("max_speed_knots").alias("fleet_max_speed"),
        F.avg("total_distance_nm").alias("avg_distance_per_vessel"),
        F.sum("total_distance_nm").alias("total_fleet_distance"),
        F.count_distinct("vessel_name").alias("unique_vessel_names"),
    )
    return base.select(*[_zd(F.col(c)).alias(c) for c in
                         ["fleet_avg_speed", "fleet_max_speed", "avg_distance_per_vessel", "total_fleet_distance"]],
                       "unique_vessel_names")


def fleet_statistics(metrics: DataFrame, positions: DataFrame) -> DataFrame:
    """Global statistics of ``metrics LEFT JOIN positions ON mmsi``.

    The join fans every vessel out to its reports, so averages are weighted by
    report count.  The fan-out is never built: reports are first reduced to
    (mmsi, n, n_valid), joined one-to-one, and averages are weighted sums with
    weight max(n, 1) -- the same answer as the literal join.
    """
    per_vessel = positions.groupBy("mmsi").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).alias("_nv"),
    )
    j = metrics.join(per_vessel, "mmsi", "left")
    w = F.greatest(F.coalesce(F.col("_n"), F.lit(0)), F.lit(1))

    def wavg(c: str) -> Column:
        x = F.col(c)
        return F.try_divide(F.sum(F.when(x.isNotNull(), x * w)), F.sum(F.when(x.isNotNull(), w)))

    return j.agg(
        F.count("mmsi").alias("total_vessels"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_positions"),
        wavg("total_distance_nm").alias("avg_distance"),
        wavg("moving_time_hours").alias("avg_moving_time"),
        wavg("at_dock_time_hours").alias("avg_dock_time"),
        wavg("avg_speed_knots").alias("avg_speed_fleet"),
        F.max("max_speed_knots").alias("max_speed_recorded"),
        F.try_divide(F.sum("_nv").cast("double") * F.lit(100.0), F.sum("_n")).alias("valid_position_percentage"),
    )


def time_share(metrics: DataFrame) -> DataFrame:
    """Moving vs docked share of fleet time, as two (state, hours, percentage) rows."""
    t = time_analysis(metrics)
    return t.selectExpr(
        "stack(2, 'moving', total_moving_time, moving_time_percentage,"
        " 'docked', total_dock_time, dock_time_percentage) AS (state, hours, percentage)"
    )


def quality_long(positions: DataFrame) -> DataFrame:
    """Quality percentages as (metric, count, percentage) rows."""
    q = data_quality(positions)
    return q.selectExpr(
        "stack(4,"
        " 'positions', valid_positions, valid_positions_percentage,"
        " 'speeds', valid_speeds, valid_speeds_percentage,"
        " 'names', valid_names, valid_names_percentage,"
        " 'timestamps', valid_timestamps, valid_timestamps_percentage) AS (metric, valid, percentage)"
    )


def headline(metrics: DataFrame, positions: DataFrame) -> DataFrame:
    """Dashboard headline: vessels, positions, mean distance, position quality (1 decimal)."""
    s = fleet_statistics(metrics, positions)
    return s.select(
        "total_vessels", "total_positions",
        round_half_up(_zd(F.col("avg_distance")), 1).alias("avg_distance_nm"),
        round_half_up(_zd(F.col("valid_position_percentage")), 1).alias("quality_percentage"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram of ``column``: (bin, bin_start, bin_end, count), non-empty bins.

    Bounds are a scalar subquery (one partial min/max per task); each row then
    gets its bin by arithmetic and one grouped count runs -- no sort, no window.
    """
    x = F.col(column)
    vals = df.where(x.isNotNull()).select(x.alias("_x"))
    lo = vals.agg(F.min("_x")).scalar()
    hi = vals.agg(F.max("_x")).scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col("_x") - lo) * F.lit(float(bins)) / (hi - lo)) + 1, F.lit(bins))
    ).cast("int")
    counted = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("bin_start"),
        (lo + F.col("bin") * width).alias("bin_end"),
        "count",
    )


def distance_histogram(metrics: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(metrics, "total_distance_nm", bins).withColumnRenamed("count", "vessels")


def speed_histogram(metrics: DataFrame, bins: int = 20) -> DataFrame:
    return histogram(metrics, "avg_speed_knots", bins).withColumnRenamed("count", "vessels")


def _attach(base: DataFrame, sections: dict[str, DataFrame]) -> DataFrame:
    """Flatten one-row ``sections`` into ``base`` as ``<section>_<column>`` scalar subqueries."""
    cols = [F.col(c) for c in base.columns]
    for name, sec in sections.items():
        packed = sec.select(F.struct(*sec.columns).alias("_s")).scalar()
        cols += [packed.getField(c).alias(f"{name}_{c}") for c in sec.columns]
    return base.select(*cols)


def top_vessels_wide(top: DataFrame, k: int = 5) -> DataFrame:
    """Top-k rows as one row of ``top<r>_mmsi``, ``top<r>_distance_nm`` columns."""
    from pyspark.sql import Window
    ranked = top.select("mmsi", "total_distance_nm", F.row_number().over(
        Window.orderBy(F.col("total_distance_nm").desc(), F.col("mmsi").asc())).alias("_r"))
    aggs = []
    for r in range(1, k + 1):
        aggs.append(F.max(F.when(F.col("_r") == r, F.col("mmsi"))).alias(f"top{r}_mmsi"))
        aggs.append(F.max(F.when(F.col("_r") == r, F.col("total_distance_nm"))).alias(f"top{r}_distance_nm"))
    return ranked.agg(*aggs)


def comprehensive_report(metrics: DataFrame, positions: DataFrame, top: DataFrame) -> DataFrame:
    """Time analysis + top-5 + quality + point statistics + additional figures, one row."""
    return _attach(time_analysis(metrics).select(
        *[F.col(c).alias(f"time_{c}") for c in time_analysis(metrics).columns]), {
        "quality": data_quality(positions),
        "points": point_statistics(metrics),
        "additional": fleet_additional(metrics),
        "top": top_vessels_wide(top),
    })


def metrics_summary(metrics: DataFrame, positions: DataFrame) -> DataFrame:
    """Statistics + time analysis + quality, one row."""
    stats = fleet_statistics(metrics, positions)
    return _attach(stats.select(*[F.col(c).alias(f"stats_{c}") for c in stats.columns]), {
        "time": time_analysis(metrics),
        "quality": data_quality(positions),
    })
