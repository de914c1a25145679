"""Vessel queries: paged list, top-k, filtered search, detail, code decoding.

Sorts always carry ``mmsi`` as the tie-break and spell out the NULL order,
so results are the same on every engine.  Top-k and pages are
``orderBy(...).limit`` (TakeOrderedAndProject: a bounded heap per task, no
global sort).  Dimension tables are fixed (28 and 13 rows), so broadcasting
them is safe; data-sized sides are left to AQE, which only broadcasts after
measuring them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackline.schema import NAV_STATUS_SCHEMA, NAVIGATION_STATUS_CODES, VESSEL_TYPE_CODES, VESSEL_TYPE_SCHEMA

PAGE_COLUMNS = ["mmsi", "vessel_name", "total_distance_nm", "total_time_hours", "moving_time_hours",
                "at_dock_time_hours", "point_count", "avg_speed_knots", "max_speed_knots"]
TOP_COLUMNS = ["mmsi", "vessel_name", "total_distance_nm", "total_time_hours", "moving_time_hours",
               "at_dock_time_hours", "avg_speed_knots", "point_count"]
SEARCH_COLUMNS = ["mmsi", "vessel_name", "total_distance_nm", "point_count", "avg_speed_knots",
                  "max_speed_knots", "moving_time_hours", "at_dock_time_hours"]

MAX_PAGE = 1000
MAX_SEARCH = 500


def vessel_page(metrics: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """Vessels by distance (largest first, NULL first), one page; with the page number."""
    if not (0 < limit <= MAX_PAGE) or offset < 0:
        raise ValueError(f"limit must be in 1..{MAX_PAGE} and offset >= 0")
    cols = [c for c in PAGE_COLUMNS + ["last_updated"] if c in metrics.columns]
    page = (metrics.select(*cols)
            .orderBy(F.col("total_distance_nm").desc_nulls_first(), F.col("mmsi").asc())
            .offset(offset).limit(limit))
    return page.withColumn("page", F.lit(offset // limit + 1))


def top_vessels(metrics: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` vessels with the largest positive distance."""
    return (metrics.where(F.col("total_distance_nm").isNotNull() & (F.col("total_distance_nm") > 0))
            .select(*TOP_COLUMNS)
            .orderBy(F.col("total_distance_nm").desc(), F.col("mmsi").asc())
            .limit(k))


def vessel_search(metrics: DataFrame, name: str | None = None, min_distance: float | None = None,
                  max_distance: float | None = None, limit: int = 50,
                  positions: DataFrame | None = None, vessel_type: str | None = None) -> DataFrame:
    """Search with optional predicates, ANDed; ``None`` means "no predicate".

    ``name`` matches case-insensitively anywhere in the name (``%``/``_`` act
    as wildcards).  ``vessel_type`` keeps vessels that reported that type at
    least once (a semi-join against ``positions``).
    """
    if not (0 < limit <= MAX_SEARCH):
        raise ValueError(f"limit must be in 1..{MAX_SEARCH}")
    preds = []
    if name is not None:
        preds.append(F.col("vessel_name").ilike(f"%{name}%"))
    if min_distance is not None:
        preds.append(F.col("total_distance_nm") >= F.lit(float(min_distance)))
    if max_distance is not None:
        preds.append(F.col("total_distance_nm") <= F.lit(float(max_distance)))
    m = metrics.where(reduce(lambda a, b: a & b, preds)) if preds else metrics
    if vessel_type is not None:
        if positions is None:
            raise ValueError("vessel_type needs the positions table")
        typed = positions.where(F.col("vessel_type") == F.lit(str(vessel_type))).select("mmsi").distinct()
        m = m.join(typed, "mmsi", "left_semi")  # of one row a vessel, however often it has reported
    return (m.select(*SEARCH_COLUMNS)
            .orderBy(F.col("total_distance_nm").desc_nulls_first(), F.col("mmsi").asc())
            .limit(limit))


def vessel_detail(metrics: DataFrame, positions: DataFrame, mmsi: int, n: int = 100) -> DataFrame:
    """One vessel: its metrics row repeated on each of its latest ``n`` reports.

    Also carries ``positions_count`` (reports returned).  No rows when the
    vessel is unknown (the caller's "not found").
    """
    m = metrics.where(F.col("mmsi") == F.lit(mmsi)).select(*PAGE_COLUMNS)
    cols = ["base_datetime", "latitude", "longitude", "sog", "cog", "heading", "vessel_name", "status"]
    cols = [c for c in cols if c in positions.columns]
    recent = (positions.where(F.col("mmsi") == F.lit(mmsi))
              .select("mmsi", *[F.col(c).alias(f"pos_{c}") for c in cols])
              .orderBy(F.col("pos_base_datetime").desc()).limit(n))
    recent = recent.withColumn("positions_count", F.count(F.lit(1)).over(Window.partitionBy("mmsi")))
    return m.join(recent, "mmsi", "left")


def vessel_type_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VESSEL_TYPE_CODES, VESSEL_TYPE_SCHEMA)


def navigation_status_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NAVIGATION_STATUS_CODES, NAV_STATUS_SCHEMA)


def _code(c: str) -> F.Column:
    return F.trim(F.col(c)).try_cast("int")


MAX_CODES = 10_000


def _code_table(codes: DataFrame, **names: str) -> DataFrame:
    """``codes`` for a broadcast; a table of more than ``MAX_CODES`` rows is an error when it runs, not a broadcast."""
    few = codes.select(F.col("code").alias("_code"), *[F.col(c).alias(n) for c, n in names.items()]).limit(MAX_CODES + 1)
    counted = few.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy()))
    too_many = F.lit(f"a code table has over {MAX_CODES} rows")
    return F.broadcast(counted.where(F.assert_true(F.col("_rows") <= MAX_CODES, too_many).isNull()).drop("_rows"))


def decode_types(positions: DataFrame, codes: DataFrame) -> DataFrame:
    """Attach type description and category; unmatched or non-numeric codes -> NULL."""
    d = _code_table(codes, description="type_description", category="type_category")
    return positions.join(d, _code("vessel_type") == F.col("_code"), "left").drop("_code")


def decode_status(positions: DataFrame, codes: DataFrame) -> DataFrame:
    """Attach the navigation-status description; unmatched -> NULL."""
    d = _code_table(codes, description="status_description")
    return positions.join(d, _code("status") == F.col("_code"), "left").drop("_code")
