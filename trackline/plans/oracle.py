"""Oracle SQL: for each registered query, an independent ANSI-SQL formulation.

The texts run on DuckDB over the driver's pre-registered tables.  They are
written the direct way (a plain ``lag`` over each vessel, the literal LEFT
JOIN fan-out, ``row_number`` de-duplication) so they check the Spark plans'
rewrites rather than repeat them.  Doubles are rounded to 6 decimals on both
sides.
"""

from __future__ import annotations

import numpy as np

from trackline.sources.fixture import TURNED, raw_positions_sql

ORACLE: dict[str, str] = {}

R = 6  # rounding digits
HOUR_US = "3600000000.0"

COLS = ["mmsi", "base_datetime", "latitude", "longitude", "sog", "cog", "vessel_name", "vessel_type", "status",
        "ingest_seq"]
DOUBLE_COLS = {"latitude", "longitude", "sog", "cog"}


def rnd(c: str, alias: str | None = None, digits: int = R) -> str:
    return f"{rexpr(c, digits)} AS {alias or c.split('.')[-1]}"


def rexpr(c: str, digits: int = R) -> str:
    """Half-up rounding through DECIMAL(38,12), the same steps as the Spark side."""
    return f"CAST(round(CAST({c} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def sel_raw(prefix: str = "") -> str:
    return ", ".join(rnd(prefix + c, c) if c in DOUBLE_COLS else prefix + c for c in COLS)


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


RAW = raw_positions_sql()
INCOMPLETE = "(base_datetime IS NULL OR latitude IS NULL OR longitude IS NULL OR mmsi IS NULL)"
COORD_OK = "(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)"
SPEED_OK = "(sog BETWEEN 0 AND 50)"
CLEAN = (f"clean AS (SELECT * FROM raw WHERE NOT {INCOMPLETE} AND {COORD_OK} AND {SPEED_OK}"
         f" QUALIFY row_number() OVER (PARTITION BY mmsi, base_datetime ORDER BY ingest_seq) = 1)")


# WGS-84, the sphere's radius in nautical miles, metres of a mile.
FLAT, MAJOR, SPHERE_NM, MILE = "(1 / 298.257223563)", "6378137.0", "3440.065", "1852.0"


def haversine_oracle(src: str, tag: str) -> tuple[list[str], str]:
    h = ("power(sin(radians(latitude - plat) / 2), 2) + cos(radians(plat)) * cos(radians(latitude))"
         " * power(sin(radians(longitude - plon) / 2), 2)")
    return [f"{tag}_h AS (SELECT *, 2 * {SPHERE_NM} * asin(sqrt({h})) AS leg_nm FROM {src})"], f"{tag}_h"


def vincenty_oracle(src: str, tag: str, turns: int = 7) -> tuple[list[str], str]:
    """Vincenty's inverse formula, ``turns`` times round; ``ang`` is the angle between the points."""
    ctes = [f"{tag}_0 AS (SELECT *, radians(longitude - plon) AS dl, dl AS l0, atan((1 - {FLAT}) * tan(radians(plat))) AS ua,"
            f" atan((1 - {FLAT}) * tan(radians(latitude))) AS ub FROM {src})"]
    for i in range(1, turns + 1):
        prev = f"l{i - 1}"
        ctes.append(f"{tag}_{i} AS (SELECT *,"
                    f" sqrt(power(cos(ub) * sin({prev}), 2) + power(cos(ua) * sin(ub) - sin(ua) * cos(ub) * cos({prev}), 2)) AS sx{i},"
                    f" sin(ua) * sin(ub) + cos(ua) * cos(ub) * cos({prev}) AS cx{i}, atan2(sx{i}, cx{i}) AS ang{i},"
                    f" CASE WHEN sx{i} = 0 THEN 0.0 ELSE cos(ua) * cos(ub) * sin({prev}) / sx{i} END AS sy{i}, 1 - sy{i} * sy{i} AS q{i},"
                    f" CASE WHEN q{i} = 0 THEN 0.0 ELSE cx{i} - 2 * sin(ua) * sin(ub) / q{i} END AS m{i},"
                    f" {FLAT} / 16 * q{i} * (4 + {FLAT} * (4 - 3 * q{i})) AS w{i},"
                    f" dl + (1 - w{i}) * {FLAT} * sy{i} * (ang{i} + w{i} * sx{i} * (m{i} + w{i} * cx{i} * (2 * m{i} * m{i} - 1))) AS l{i}"
                    f" FROM {tag}_{i - 1})")
    n = turns
    ctes.append(f"{tag}_v AS (SELECT *, q{n} * (1 / power(1 - {FLAT}, 2) - 1) AS uu,"
                f" 1 + uu / 4 + uu * uu * (-3.0 / 64 + uu * (5.0 / 256 - uu * 175 / 16384)) AS aa,"
                f" uu / 4 + uu * uu * (-1.0 / 8 + uu * (37.0 / 512 - uu * 47 / 1024)) AS bb,"
                f" bb * sx{n} * (m{n} + bb / 4 * (cx{n} * (2 * m{n} * m{n} - 1) - bb / 6 * m{n} * (4 * sx{n} * sx{n} - 3) * (4 * m{n} * m{n} - 3))) AS cut,"
                f" {MAJOR} * (1 - {FLAT}) * aa * (ang{n} - cut) / {MILE} AS leg_nm, ang{n} AS ang FROM {tag}_{n})")
    return ctes, f"{tag}_v"


def bisected_oracle(src: str, tag: str) -> tuple[list[str], str]:
    """Legs of over 160 degrees by halving the bracket of the azimuth; other legs as ``src`` has them."""
    nodes = ", ".join(f"{{'x': {x!r}, 'w': {w!r}}}" for x, w in zip(*(v.tolist() for v in np.polynomial.legendre.leggauss(16))))
    at = (f"sin(az) * cos(b1) AS s0, cos(az) * cos(b1) AS y1, sqrt(greatest(0.0, y1 * y1 + power(cos(b2), 2) - power(cos(b1), 2))) AS y2,"
          f" (1 / power(1 - {FLAT}, 2) - 1) * (1 - s0 * s0) AS kk, atan2(sin(b1), y1) AS ga, atan2(sin(b2), y2) AS gb,"
          f" atan2(s0 * sin(b2), y2) - atan2(s0 * sin(b1), y1) AS om")

    def integral(of: str) -> str:
        root = "sqrt(1 + kk * power(sin((gb + ga) / 2 + (gb - ga) / 2 * p.x), 2))"
        return f"(gb - ga) / 2 * list_sum([p.w * {of.format(r=root)} FOR p IN [{nodes}]])"

    lon = f"om - {FLAT} * s0 * " + integral(f"(2 - {FLAT}) / (1 + (1 - {FLAT}) * {{r}})")
    return [
        f"{tag}_k AS (SELECT *, row_number() OVER (ORDER BY mmsi, base_datetime) AS k_ FROM {src})",
        f"{tag}_c AS (SELECT k_, CASE WHEN abs(ua) >= abs(ub) THEN ua ELSE ub END AS u, CASE WHEN abs(ua) >= abs(ub) THEN ub ELSE ua END AS v,"
        f" least(-abs(u), -1e-12) AS b1, CASE WHEN u > 0 THEN -v ELSE v END AS b2,"
        f" radians(abs(longitude - plon) - 360 * floor((abs(longitude - plon) + 180) / 360)) AS d, abs(d) AS lm FROM {tag}_k WHERE ang > 2.8)",
        f"{tag}_b AS (SELECT k_, b1, b2, lm, 0.0::DOUBLE AS lo, pi() AS hi, 0 AS i FROM {tag}_c UNION ALL"
        f" SELECT k_, b1, b2, lm, CASE WHEN far THEN lo ELSE az END, CASE WHEN far THEN az ELSE hi END, i + 1"
        f" FROM (SELECT *, (lo + hi) / 2 AS az, {at}, {lon} > lm AS far FROM {tag}_b WHERE i < 55))",
        f"{tag}_d AS (SELECT k_, (lo + hi) / 2 AS az, {at}, {MAJOR} * (1 - {FLAT}) * " + integral("{r}") + f" / {MILE} AS far_nm FROM {tag}_b WHERE i = 55)",
        f"{tag}_f AS (SELECT k.* REPLACE (coalesce(d.far_nm, k.leg_nm) AS leg_nm) FROM {tag}_k k LEFT JOIN {tag}_d d USING (k_))",
    ], f"{tag}_f"


def legs_ctes(method: str = "geodesic", src: str = "clean", tag: str = "", far: bool = False) -> tuple[list[str], str]:
    """CTEs adding previous-point columns and ``leg_nm`` per report (NULL for a vessel's first)."""
    legs = (f"legs{tag} AS (SELECT mmsi, base_datetime, latitude, longitude, sog, vessel_name,"
            f" lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon, lag(sog) OVER w AS psog,"
            f" lag(base_datetime) OVER w AS pts FROM {src} WINDOW w AS (PARTITION BY mmsi ORDER BY base_datetime))")
    dist, last = (haversine_oracle if method == "haversine" else vincenty_oracle)(f"legs{tag}", f"g{tag}")
    if far:
        more, last = bisected_oracle(last, f"f{tag}")
        dist += more
    return [legs] + dist, last


def metrics_ctes(method: str = "geodesic", src: str = "clean", tag: str = "", far: bool = False) -> list[str]:
    """CTEs ending in ``metrics<tag>`` (unrounded, one row per vessel, with extents and leg counts)."""
    lc, last = legs_ctes(method, src, tag, far)
    lagg = (f"lagg{tag} AS (SELECT mmsi, sum(leg_nm) AS dist, count(pts) AS leg_count,"
            f" count(CASE WHEN pts IS NOT NULL AND leg_nm IS NULL THEN 1 END) AS failed_legs,"
            f" sum(CASE WHEN pts IS NOT NULL AND (psog + sog) / 2 >= 1.0"
            f" THEN datediff('microsecond', pts, base_datetime) ELSE 0 END) AS moving_us"
            f" FROM {last} GROUP BY mmsi)")
    pagg = (f"pagg{tag} AS (SELECT mmsi, count(*) AS point_count, avg(sog) AS avg_speed_knots,"
            f" max(sog) AS max_speed_knots, min(sog) AS min_speed_knots,"
            f" min(base_datetime) AS t0, max(base_datetime) AS t1,"
            f" arg_min_null(vessel_name, base_datetime) AS first_name,"
            f" arg_min(latitude, base_datetime) AS start_latitude, arg_min(longitude, base_datetime) AS start_longitude,"
            f" arg_max(latitude, base_datetime) AS end_latitude, arg_max(longitude, base_datetime) AS end_longitude"
            f" FROM {src} GROUP BY mmsi)")
    m = (f"metrics{tag} AS (SELECT p.mmsi, coalesce(p.first_name, 'Unknown') AS vessel_name,"
         " coalesce(l.dist, 0) AS total_distance_nm,"
         f" CAST(datediff('microsecond', p.t0, p.t1) AS DOUBLE) / {HOUR_US} AS total_time_hours,"
         f" CAST(coalesce(l.moving_us, 0) AS DOUBLE) / {HOUR_US} AS moving_time_hours,"
         f" CAST(datediff('microsecond', p.t0, p.t1) - coalesce(l.moving_us, 0) AS DOUBLE) / {HOUR_US}"
         " AS at_dock_time_hours,"
         " p.point_count, p.avg_speed_knots, p.max_speed_knots, p.min_speed_knots,"
         " p.t0 AS first_position_time, p.t1 AS last_position_time,"
         " p.start_latitude, p.start_longitude, p.end_latitude, p.end_longitude,"
         " coalesce(l.leg_count, 0) AS leg_count, coalesce(l.failed_legs, 0) AS failed_legs"
         f" FROM pagg{tag} p LEFT JOIN lagg{tag} l ON p.mmsi = l.mmsi)")
    return lc + [lagg, pagg, m]


METRIC_SELECT = ", ".join([
    "mmsi", "vessel_name", rnd("total_distance_nm"), rnd("total_time_hours"), rnd("moving_time_hours"),
    rnd("at_dock_time_hours"), "point_count", rnd("avg_speed_knots"), rnd("max_speed_knots"),
])


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


# --- cleaning -------------------------------------------------------------

oracle("coerce_types", with_([RAW], f"SELECT {sel_raw()} FROM raw"))
oracle("drop_incomplete", with_([RAW], f"SELECT {sel_raw()} FROM raw WHERE NOT {INCOMPLETE}"))
oracle("valid_coordinates", with_([RAW], f"SELECT {sel_raw()} FROM raw WHERE NOT {INCOMPLETE} AND {COORD_OK}"))
oracle("valid_speed", with_([RAW], f"SELECT {sel_raw()} FROM raw WHERE NOT {INCOMPLETE} AND {COORD_OK} AND {SPEED_OK}"))
oracle("dedupe_positions", with_([RAW], f"SELECT {sel_raw()} FROM raw"
                                        " QUALIFY row_number() OVER (PARTITION BY mmsi, base_datetime"
                                        " ORDER BY ingest_seq) = 1"))
oracle("sorted_positions", with_([RAW, CLEAN], f"SELECT {sel_raw()} FROM clean ORDER BY mmsi, base_datetime"))
oracle("clean", with_([RAW, CLEAN], f"SELECT {sel_raw()} FROM clean"))
oracle("cleaning_report", with_([RAW, CLEAN], f"""
SELECT CAST(count(*) AS BIGINT) AS rows_in,
  CAST(count(*) FILTER (WHERE {INCOMPLETE}) AS BIGINT) AS rejected_incomplete,
  CAST(count(*) FILTER (WHERE NOT {INCOMPLETE} AND NOT {COORD_OK}) AS BIGINT) AS rejected_coordinates,
  CAST(count(*) FILTER (WHERE NOT {INCOMPLETE} AND {COORD_OK} AND NOT coalesce({SPEED_OK}, false)) AS BIGINT)
    AS rejected_speed,
  CAST(count(*) FILTER (WHERE NOT {INCOMPLETE} AND {COORD_OK} AND {SPEED_OK}) - (SELECT count(*) FROM clean) AS BIGINT)
    AS rejected_duplicates,
  (SELECT CAST(count(*) AS BIGINT) FROM clean) AS rows_out
FROM raw"""))
oracle("constraint_violations", with_([RAW], """
SELECT mmsi, base_datetime, ingest_seq, violations FROM (
  SELECT mmsi, base_datetime, ingest_seq, concat_ws(',',
    CASE WHEN mmsi IS NULL THEN 'nn_mmsi' END,
    CASE WHEN base_datetime IS NULL THEN 'nn_base_datetime' END,
    CASE WHEN latitude IS NULL THEN 'nn_latitude' END,
    CASE WHEN longitude IS NULL THEN 'nn_longitude' END,
    CASE WHEN NOT coalesce(latitude BETWEEN -90 AND 90, true) THEN 'chk_latitude' END,
    CASE WHEN NOT coalesce(longitude BETWEEN -180 AND 180, true) THEN 'chk_longitude' END,
    CASE WHEN NOT (sog IS NULL OR sog BETWEEN 0 AND 100) THEN 'chk_sog' END,
    CASE WHEN NOT (cog IS NULL OR cog BETWEEN 0 AND 360) THEN 'chk_cog' END) AS violations
  FROM raw) WHERE violations <> ''"""))
oracle("uniqueness_violations", with_([RAW], "SELECT mmsi, base_datetime, count(*) AS copies FROM raw"
                                             " GROUP BY mmsi, base_datetime HAVING count(*) > 1"))
oracle("limit_records", with_([RAW], f"SELECT {sel_raw()} FROM raw ORDER BY ingest_seq LIMIT 1000"))
oracle("profile", with_([RAW], "SELECT count(*) AS total_rows, CAST(10 AS INTEGER) AS column_count,"
                               " count(DISTINCT mmsi) AS unique_vessels, min(base_datetime) AS first_time,"
                               " max(base_datetime) AS last_time FROM raw"))
oracle("top_vessel_types", with_([RAW], "SELECT vessel_type, count(*) AS positions FROM raw"
                                        " WHERE vessel_type IS NOT NULL GROUP BY vessel_type"
                                        " ORDER BY positions DESC, vessel_type ASC LIMIT 5"))

_FILLED = {c: f"count({c})" for c in COLS}
oracle("column_fill", with_([RAW], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {n} AS filled, {rnd(f'CAST({n} AS DOUBLE) / count(*)', 'share')} FROM raw" for c, n in _FILLED.items())))
oracle("distinct_vessel_sketches", with_([RAW, CLEAN, "d AS (SELECT *, CAST(base_datetime AS DATE) AS day FROM clean)"], " UNION ALL ".join(
    f"SELECT '{span}' AS span, count(*) AS positions, count(DISTINCT mmsi) AS vessels FROM d {where}" for span, where in [
        ("7 days", "WHERE day > (SELECT max(day) FROM d) - 7"), ("30 days", "WHERE day > (SELECT max(day) FROM d) - 30"), ("all", "")])))

# --- tracks ----------------------------------------------------------------


def _legs_query(method: str) -> str:
    lc, last = legs_ctes(method)
    return with_([RAW, CLEAN] + lc, f"""
SELECT mmsi, pts AS from_time, base_datetime AS to_time, {rnd('leg_nm')},
  datediff('microsecond', pts, base_datetime) AS elapsed_us, ((psog + sog) / 2 >= 1.0) AS moving
FROM {last} WHERE pts IS NOT NULL""")


oracle("track_legs", _legs_query("geodesic"))
oracle("haversine_legs", _legs_query("haversine"))
oracle("vessel_distance", with_([RAW, CLEAN] + metrics_ctes(),
                                f"SELECT mmsi, {rnd('total_distance_nm')}, leg_count, failed_legs FROM metrics"))
oracle("vessel_distance_long_legs", with_([RAW, "turned AS (SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in TURNED.items()) + ") FROM raw)",
                                          CLEAN.replace("FROM raw", "FROM turned")] + metrics_ctes(far=True),
                                         f"SELECT mmsi, {rnd('total_distance_nm', digits=4)}, leg_count, failed_legs FROM metrics").replace(
                                             "WITH ", "WITH RECURSIVE ", 1))
oracle("vessel_time_split", with_([RAW, CLEAN] + metrics_ctes("haversine"),
                                  f"SELECT mmsi, {rnd('total_time_hours')}, {rnd('moving_time_hours')},"
                                  f" {rnd('at_dock_time_hours')}, point_count FROM metrics"))
oracle("vessel_metrics", with_([RAW, CLEAN] + metrics_ctes(), f"SELECT {METRIC_SELECT} FROM metrics"))
oracle("vessel_extents", with_([RAW, CLEAN] + metrics_ctes("haversine"), f"""
SELECT mmsi, {rnd('min_speed_knots')}, first_position_time, last_position_time, {rnd('start_latitude')},
  {rnd('start_longitude')}, {rnd('end_latitude')}, {rnd('end_longitude')} FROM metrics"""))
oracle("top_vessels", with_([RAW, CLEAN] + metrics_ctes(), f"""
SELECT mmsi, vessel_name, {rnd('total_distance_nm')}, {rnd('total_time_hours')}, {rnd('moving_time_hours')},
  {rnd('at_dock_time_hours')}, {rnd('avg_speed_knots')}, point_count
FROM metrics WHERE total_distance_nm IS NOT NULL AND total_distance_nm > 0
ORDER BY metrics.total_distance_nm DESC, mmsi ASC LIMIT 5"""))


# --- fleet reports -----------------------------------------------------------

def pct_sql(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / NULLIF({whole}, 0) * 100.0, 0.0)"


TIME_CTE = ("ta AS (SELECT coalesce(sum(moving_time_hours), 0.0) AS total_moving_time,"
            " coalesce(sum(at_dock_time_hours), 0.0) AS total_dock_time,"
            " coalesce(sum(total_time_hours), 0.0) AS total_time,"
            " coalesce(avg(moving_time_hours), 0.0) AS avg_moving_time_per_vessel,"
            " coalesce(avg(at_dock_time_hours), 0.0) AS avg_dock_time_per_vessel,"
            " count(*) AS vessels_count,"
            f" {pct_sql('sum(moving_time_hours)', 'sum(total_time_hours)')} AS moving_time_percentage,"
            f" {pct_sql('sum(at_dock_time_hours)', 'sum(total_time_hours)')} AS dock_time_percentage"
            " FROM metrics WHERE total_time_hours > 0)")
TIME_COLS = ["total_moving_time", "total_dock_time", "total_time", "avg_moving_time_per_vessel",
             "avg_dock_time_per_vessel", "vessels_count", "moving_time_percentage", "dock_time_percentage"]
TIME_INT = {"vessels_count"}


def quality_cte(src: str, name: str = "dq") -> str:
    base = (f"SELECT count(*) AS total_records,"
            " count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL"
            " AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) AS valid_positions,"
            " count(*) FILTER (WHERE sog IS NOT NULL AND sog >= 0 AND sog <= 50) AS valid_speeds,"
            " count(*) FILTER (WHERE vessel_name IS NOT NULL AND vessel_name <> '') AS valid_names,"
            " count(*) FILTER (WHERE base_datetime IS NOT NULL) AS valid_timestamps,"
            f" count(DISTINCT mmsi) AS unique_vessels FROM {src}")
    return (f"{name} AS (SELECT *, (valid_positions_percentage + valid_speeds_percentage"
            f" + valid_timestamps_percentage) / 3.0 AS overall_quality_score FROM (SELECT *,"
            f" {pct_sql('valid_positions', 'total_records')} AS valid_positions_percentage,"
            f" {pct_sql('valid_speeds', 'total_records')} AS valid_speeds_percentage,"
            f" {pct_sql('valid_names', 'total_records')} AS valid_names_percentage,"
            f" {pct_sql('valid_timestamps', 'total_records')} AS valid_timestamps_percentage"
            f" FROM ({base})))")


QUALITY_COLS = ["total_records", "valid_positions", "valid_speeds", "valid_names", "valid_timestamps",
                "unique_vessels", "valid_positions_percentage", "valid_speeds_percentage", "valid_names_percentage",
                "valid_timestamps_percentage", "overall_quality_score"]
QUALITY_INT = set(QUALITY_COLS[:6])

POINTS_CTE = ("ps AS (SELECT count(DISTINCT mmsi) AS total_vessels,"
              " coalesce(avg(point_count), 0.0) AS avg_points_per_vessel,"
              " coalesce(min(point_count), 0) AS min_points_per_vessel,"
              " coalesce(max(point_count), 0) AS max_points_per_vessel,"
              " coalesce(stddev_samp(point_count), 0.0) AS stddev_points_per_vessel"
              " FROM metrics WHERE point_count IS NOT NULL)")
POINTS_COLS = ["total_vessels", "avg_points_per_vessel", "min_points_per_vessel", "max_points_per_vessel",
               "stddev_points_per_vessel"]
POINTS_INT = {"total_vessels", "min_points_per_vessel", "max_points_per_vessel"}

ADDITIONAL_CTE = ("fa AS (SELECT coalesce(avg(avg_speed_knots), 0.0) AS fleet_avg_speed,"
                  " coalesce(max(max_speed_knots), 0.0) AS fleet_max_speed,"
                  " coalesce(avg(total_distance_nm), 0.0) AS avg_distance_per_vessel,"
                  " coalesce(sum(total_distance_nm), 0.0) AS total_fleet_distance,"
                  " count(DISTINCT vessel_name) AS unique_vessel_names"
                  " FROM metrics WHERE total_distance_nm IS NOT NULL AND total_distance_nm > 0)")
ADDITIONAL_COLS = ["fleet_avg_speed", "fleet_max_speed", "avg_distance_per_vessel", "total_fleet_distance",
                   "unique_vessel_names"]
ADDITIONAL_INT = {"unique_vessel_names"}

STATS_CTE = ("fs AS (SELECT count(DISTINCT vm.mmsi) AS total_vessels, count(ad.mmsi) AS total_positions,"
             " avg(vm.total_distance_nm) AS avg_distance, avg(vm.moving_time_hours) AS avg_moving_time,"
             " avg(vm.at_dock_time_hours) AS avg_dock_time, avg(vm.avg_speed_knots) AS avg_speed_fleet,"
             " max(vm.max_speed_knots) AS max_speed_recorded,"
             " CAST(count(CASE WHEN ad.latitude IS NOT NULL AND ad.longitude IS NOT NULL THEN 1 END) AS DOUBLE)"
             " * 100.0 / NULLIF(count(ad.mmsi), 0) AS valid_position_percentage"
             " FROM metrics vm LEFT JOIN clean ad ON vm.mmsi = ad.mmsi)")
STATS_COLS = ["total_vessels", "total_positions", "avg_distance", "avg_moving_time", "avg_dock_time",
              "avg_speed_fleet", "max_speed_recorded", "valid_position_percentage"]
STATS_INT = {"total_vessels", "total_positions"}


def sel(cols: list[str], ints: set[str], src: str = "", prefix: str = "") -> str:
    q = f"{src}." if src else ""
    return ", ".join(f"{q}{c} AS {prefix}{c}" if c in ints else rnd(f"{q}{c}", f"{prefix}{c}") for c in cols)


MET = [RAW, CLEAN] + metrics_ctes()
oracle("time_analysis", with_(MET + [TIME_CTE], f"SELECT {sel(TIME_COLS, TIME_INT)} FROM ta"))
oracle("data_quality", with_([RAW, CLEAN, quality_cte("clean")], f"SELECT {sel(QUALITY_COLS, QUALITY_INT)} FROM dq"))
oracle("data_quality_raw", with_([RAW, quality_cte("raw")], f"SELECT {sel(QUALITY_COLS, QUALITY_INT)} FROM dq"))
oracle("point_statistics", with_(MET + [POINTS_CTE], f"SELECT {sel(POINTS_COLS, POINTS_INT)} FROM ps"))
oracle("fleet_additional", with_(MET + [ADDITIONAL_CTE], f"SELECT {sel(ADDITIONAL_COLS, ADDITIONAL_INT)} FROM fa"))
oracle("fleet_statistics", with_(MET + [STATS_CTE], f"SELECT {sel(STATS_COLS, STATS_INT)} FROM fs"))
oracle("time_share", with_(MET + [TIME_CTE], f"""
SELECT 'moving' AS state, {rnd('total_moving_time', 'hours')}, {rnd('moving_time_percentage', 'percentage')} FROM ta
UNION ALL
SELECT 'docked' AS state, {rnd('total_dock_time', 'hours')}, {rnd('dock_time_percentage', 'percentage')} FROM ta"""))
oracle("quality_long", with_([RAW, CLEAN, quality_cte("clean")], " UNION ALL ".join(
    f"SELECT '{m}' AS metric, valid_{m} AS valid, {rnd(f'valid_{m}_percentage', 'percentage')} FROM dq"
    for m in ["positions", "speeds", "names", "timestamps"])))
oracle("headline", with_(MET + [STATS_CTE], f"""
SELECT total_vessels, total_positions, {rnd('coalesce(avg_distance, 0.0)', 'avg_distance_nm', 1)},
  {rnd('coalesce(valid_position_percentage, 0.0)', 'quality_percentage', 1)} FROM fs"""))


def _hist(col: str) -> str:
    return with_(MET + [
        f"bounds AS (SELECT min({col}) AS lo, max({col}) AS hi FROM metrics WHERE {col} IS NOT NULL)",
        f"hb AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor(({col} - lo) * 20.0 / (hi - lo)) + 1, 20) END"
        f" AS INTEGER) AS bin, lo, hi FROM metrics, bounds WHERE {col} IS NOT NULL)",
    ], f"SELECT bin, {rnd('lo + (bin - 1) * ((hi - lo) / 20.0)', 'bin_start')},"
       f" {rnd('lo + bin * ((hi - lo) / 20.0)', 'bin_end')}, count(*) AS vessels FROM hb GROUP BY bin, lo, hi")


oracle("distance_histogram", _hist("total_distance_nm"))
oracle("speed_histogram", _hist("avg_speed_knots"))

TOP_CTE = ("top5 AS (SELECT mmsi, total_distance_nm, row_number() OVER (ORDER BY total_distance_nm DESC, mmsi) AS r"
           " FROM (SELECT * FROM metrics WHERE total_distance_nm IS NOT NULL AND total_distance_nm > 0"
           " ORDER BY total_distance_nm DESC, mmsi LIMIT 5))")
TOPW_CTE = "topw AS (SELECT " + ", ".join(
    f"max(CASE WHEN r = {r} THEN mmsi END) AS top{r}_mmsi, max(CASE WHEN r = {r} THEN total_distance_nm END)"
    f" AS top{r}_distance_nm" for r in range(1, 6)) + " FROM top5)"
TOPW_COLS = [f"top{r}_{k}" for r in range(1, 6) for k in ("mmsi", "distance_nm")]
TOPW_INT = {f"top{r}_mmsi" for r in range(1, 6)}

oracle("comprehensive_report", with_(MET + [TIME_CTE, quality_cte("clean"), POINTS_CTE, ADDITIONAL_CTE, TOP_CTE,
                                            TOPW_CTE], f"""
SELECT {sel(TIME_COLS, TIME_INT, 'ta', 'time_')}, {sel(QUALITY_COLS, QUALITY_INT, 'dq', 'quality_')},
  {sel(POINTS_COLS, POINTS_INT, 'ps', 'points_')}, {sel(ADDITIONAL_COLS, ADDITIONAL_INT, 'fa', 'additional_')},
  {sel(TOPW_COLS, TOPW_INT, 'topw', 'top_')}
FROM ta CROSS JOIN dq CROSS JOIN ps CROSS JOIN fa CROSS JOIN topw"""))
oracle("metrics_summary", with_(MET + [STATS_CTE, TIME_CTE, quality_cte("clean")], f"""
SELECT {sel(STATS_COLS, STATS_INT, 'fs', 'stats_')}, {sel(TIME_COLS, TIME_INT, 'ta', 'time_')},
  {sel(QUALITY_COLS, QUALITY_INT, 'dq', 'quality_')}
FROM fs CROSS JOIN ta CROSS JOIN dq"""))

# --- vessels -----------------------------------------------------------------

PAGE_COLS = ["mmsi", "vessel_name", "total_distance_nm", "total_time_hours", "moving_time_hours",
             "at_dock_time_hours", "point_count", "avg_speed_knots", "max_speed_knots"]
PAGE_INT = {"mmsi", "vessel_name", "point_count"}
SEARCH_COLS = ["mmsi", "vessel_name", "total_distance_nm", "point_count", "avg_speed_knots", "max_speed_knots",
               "moving_time_hours", "at_dock_time_hours"]

oracle("vessel_page", with_(MET, f"""
SELECT {sel(PAGE_COLS, PAGE_INT, 'metrics')}, CAST(1 AS INTEGER) AS page FROM metrics
ORDER BY metrics.total_distance_nm DESC NULLS FIRST, metrics.mmsi LIMIT 100 OFFSET 50"""))
oracle("vessel_search", with_(MET, f"""
SELECT {sel(SEARCH_COLS, PAGE_INT, 'metrics')} FROM metrics
WHERE metrics.vessel_name ILIKE '%vessel 1%' AND metrics.total_distance_nm >= 100.0
ORDER BY metrics.total_distance_nm DESC NULLS FIRST, metrics.mmsi LIMIT 50"""))
oracle("vessel_search_type", with_(MET, f"""
SELECT {sel(SEARCH_COLS, PAGE_INT, 'metrics')} FROM metrics
WHERE metrics.total_distance_nm <= 2000.0 AND metrics.mmsi IN (SELECT mmsi FROM clean WHERE vessel_type = '80')
ORDER BY metrics.total_distance_nm DESC NULLS FIRST, metrics.mmsi LIMIT 500"""))
POS_COLS = ["base_datetime", "latitude", "longitude", "sog", "cog", "vessel_name", "status"]
oracle("vessel_detail", with_(MET + [
    "rp AS (SELECT mmsi, " + ", ".join(f"{c} AS pos_{c}" for c in POS_COLS)
    + " FROM clean WHERE mmsi = 7 ORDER BY base_datetime DESC LIMIT 100)"], f"""
SELECT {sel(PAGE_COLS, PAGE_INT, 'm')}, rp.pos_base_datetime, {rnd('rp.pos_latitude')}, {rnd('rp.pos_longitude')},
  {rnd('rp.pos_sog')}, {rnd('rp.pos_cog')}, rp.pos_vessel_name, rp.pos_status,
  count(rp.mmsi) OVER () AS positions_count
FROM metrics m LEFT JOIN rp ON m.mmsi = rp.mmsi WHERE m.mmsi = 7"""))
oracle("recent_positions", with_([RAW, CLEAN], f"""
SELECT mmsi, base_datetime, {rnd('latitude')}, {rnd('longitude')}, {rnd('sog')}, {rnd('cog')}, vessel_name, status,
  CAST(row_number() OVER (PARTITION BY mmsi ORDER BY base_datetime DESC) AS INTEGER) AS recency_rank
FROM clean QUALIFY recency_rank <= 100"""))


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _dims() -> list[str]:
    from trackline.schema import NAVIGATION_STATUS_CODES, VESSEL_TYPE_CODES
    return [f"vt(code, description, category) AS (VALUES {_values(VESSEL_TYPE_CODES)})",
            f"ns(code, description) AS (VALUES {_values(NAVIGATION_STATUS_CODES)})"]


oracle("decode_types", with_([RAW, CLEAN] + _dims(), """
SELECT c.mmsi, c.base_datetime, c.vessel_type, vt.description AS type_description, vt.category AS type_category
FROM clean c LEFT JOIN vt ON TRY_CAST(trim(c.vessel_type) AS INTEGER) = vt.code"""))
oracle("decode_status", with_([RAW, CLEAN] + _dims(), """
SELECT c.mmsi, c.base_datetime, c.status, ns.description AS status_description
FROM clean c LEFT JOIN ns ON TRY_CAST(trim(c.status) AS INTEGER) = ns.code"""))

# --- traffic -----------------------------------------------------------------

oracle("traffic_summary", with_([RAW, CLEAN], f"""
SELECT count(DISTINCT mmsi) AS total_vessels, count(*) AS total_positions, min(base_datetime) AS earliest_position,
  max(base_datetime) AS latest_position, {rnd('avg(sog)', 'avg_speed_fleet')}, {rnd('max(sog)', 'max_speed_recorded')},
  {rexpr(pct_sql("count(*) FILTER (WHERE sog > 1)", "count(*)"))} AS moving_percentage
FROM clean
WHERE base_datetime >= CAST(CAST((SELECT max(base_datetime) FROM clean) AS DATE) - INTERVAL 30 DAY AS TIMESTAMP)"""))
oracle("active_vessels", with_(MET, f"""
SELECT ad.mmsi, ad.vessel_name, count(*) AS recent_positions, max(ad.base_datetime) AS last_seen,
  {rnd('avg(ad.sog)', 'avg_speed')}, {rnd('vm.total_distance_nm')}, vm.point_count
FROM clean ad LEFT JOIN metrics vm ON ad.mmsi = vm.mmsi
WHERE ad.base_datetime >= (SELECT max(base_datetime) FROM clean) - INTERVAL 24 HOUR
GROUP BY ad.mmsi, ad.vessel_name, vm.total_distance_nm, vm.point_count
ORDER BY last_seen DESC"""))
oracle("daily_traffic", with_([RAW, CLEAN], f"""
SELECT CAST(base_datetime AS DATE) AS traffic_date, count(DISTINCT mmsi) AS unique_vessels,
  count(*) AS total_positions, {rnd('avg(sog)', 'avg_speed')}, {rnd('max(sog)', 'max_speed')},
  count(*) FILTER (WHERE sog > 1) AS moving_positions, count(*) FILTER (WHERE sog <= 1) AS stationary_positions
FROM clean GROUP BY CAST(base_datetime AS DATE) ORDER BY traffic_date DESC"""))

# --- table maintenance ---------------------------------------------------------

SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"
SNAP = ([RAW, CLEAN, f"clean_a AS (SELECT * FROM clean WHERE base_datetime < {SPLIT})",
         f"clean_b AS (SELECT * FROM clean WHERE base_datetime >= {SPLIT})"]
        + metrics_ctes(src="clean_a", tag="_a") + metrics_ctes(src="clean_b", tag="_b"))

oracle("insert_if_absent", with_([RAW, CLEAN] + _dims(), """
SELECT code, description, category FROM vt
UNION ALL
SELECT code, 'Type ' || CAST(code AS VARCHAR) AS description, 'Unclassified' AS category
FROM (SELECT DISTINCT TRY_CAST(trim(vessel_type) AS INTEGER) AS code FROM clean)
WHERE code IS NOT NULL AND code NOT IN (SELECT code FROM vt)"""))
oracle("upsert_stamped", with_(SNAP, f"""
SELECT coalesce(n.mmsi, o.mmsi) AS mmsi,
  {", ".join(
      f"CASE WHEN n.mmsi IS NULL THEN o.{c} ELSE n.{c} END AS {c}" if c in ("vessel_name", "point_count")
      else rnd(f"CASE WHEN n.mmsi IS NULL THEN o.{c} ELSE n.{c} END", c) for c in PAGE_COLS[1:])},
  CASE WHEN o.mmsi IS NULL THEN (SELECT max(base_datetime) FROM clean) ELSE {SPLIT} END AS created_at,
  CASE WHEN n.mmsi IS NULL THEN {SPLIT}
       WHEN o.mmsi IS NULL OR {" OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in PAGE_COLS[1:])}
       THEN (SELECT max(base_datetime) FROM clean) ELSE {SPLIT} END AS updated_at
FROM metrics_a o FULL OUTER JOIN metrics_b n ON o.mmsi = n.mmsi"""))
oracle("table_changes", with_(SNAP, f"""
SELECT CASE WHEN o.mmsi IS NULL THEN 'INSERT' WHEN n.mmsi IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
  'vessel_metrics' AS table_name, coalesce(n.mmsi, o.mmsi) AS record_id,
  {rnd('o.total_distance_nm', 'old_total_distance_nm')}, {rnd('n.total_distance_nm', 'new_total_distance_nm')},
  o.point_count AS old_point_count, n.point_count AS new_point_count,
  o.vessel_name AS old_vessel_name, n.vessel_name AS new_vessel_name
FROM metrics_a o FULL OUTER JOIN metrics_b n ON o.mmsi = n.mmsi
WHERE o.mmsi IS NULL OR n.mmsi IS NULL OR {" OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in PAGE_COLS[1:])}"""))


# --- sources / sinks / streaming / pipeline (same rows after a write and read) ----

NAME_NA = "CASE WHEN vessel_name = '' THEN NULL ELSE vessel_name END AS vessel_name"
READ_BACK_SEL = (f"mmsi, base_datetime, {rnd('latitude')}, {rnd('longitude')}, {rnd('sog')}, {rnd('cog')},"
                 f" {NAME_NA}, vessel_type, status")
for _key in ["read_positions", "read_positions_reordered", "read_positions_extra_column", "read_positions_headerless",
             "read_positions_standard", "read_zip_positions"]:
    oracle(_key, with_([RAW], f"SELECT {READ_BACK_SEL} FROM raw"))
_HEADED = ("MMSI,BaseDateTime,LAT,LON,SOG,COG,Heading,VesselName,IMO,CallSign,VesselType,Status,Length,Width,Draft,Cargo,"
           "TransceiverClass")
oracle("detect_format", f"SELECT * FROM (VALUES ('noaa', 'noaa', '{_HEADED}'), ('headerless', 'noaa_no_header', NULL),"
                        " ('standard', 'standard', 'MMSI,Timestamp,Lat,Lon,Speed,Course,Name,ShipType,NavStatus'))"
                        " AS t (folder, format, header) WHERE (SELECT count(*) FROM events) > 0")
oracle("file_inventory", with_([RAW], "SELECT count(*) AS rows, true AS sizes_match FROM raw"))
oracle("combine_files", with_([RAW], f"""
SELECT mmsi, base_datetime, {rnd('latitude')}, {rnd('longitude')}, {rnd('sog')}, {rnd('cog')}, {NAME_NA},
  CASE WHEN base_datetime < {SPLIT} THEN vessel_type END AS vessel_type,
  CASE WHEN base_datetime < {SPLIT} THEN status END AS status
FROM raw"""))
oracle("sink_positions", with_([RAW, CLEAN], f"""
SELECT mmsi, base_datetime, {rnd('latitude')}, {rnd('longitude')}, {rnd('sog')}, {rnd('cog')}, vessel_name,
  vessel_type, status, ingest_seq, CAST(base_datetime AS DATE) AS traffic_date,
  (SELECT max(base_datetime) FROM clean) AS created_at
FROM clean"""))
oracle("sink_metrics", with_(MET, f"SELECT {METRIC_SELECT}, (SELECT max(base_datetime) FROM clean) AS last_updated"
                                  " FROM metrics"))
oracle("staging_roundtrip", ORACLE["vessel_metrics"])
oracle("bucketed_metrics", ORACLE["vessel_metrics"])
oracle("report_json", ORACLE["comprehensive_report"])
oracle("pipeline_end_to_end", ORACLE["comprehensive_report"])
oracle("incremental_ingest", with_([RAW, CLEAN], f"SELECT {READ_BACK_SEL} FROM clean"))
oracle("refresh_daily", ORACLE["daily_traffic"])

# --- archive catalog ------------------------------------------------------------------

from trackline.sources.fixture import listing_pages_sql  # noqa: E402


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


LISTING = listing_pages_sql()
# Patterns of the oracle's own: a link from its tag to its size, its address, its size.
_TAG = r"""(?is)<a\s(?:[^>"']|"[^"]*"|'[^']*')*>"""
_LINK = _TAG + r"""(?:[^<]|</?b>)*</a>(?:\s|</?t[dh][^>]*>)*(?:[0-9]+(?:[.][0-9]+)? *[KMGT])?"""
_HREF = r"""(?i)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_SIZE = r"""(?i)([0-9]+(?:[.][0-9]+)?) *([KMGT])$"""
_HREF_OF = f"trim(regexp_extract(frag, {q(_HREF)}, 1), {q(chr(34) + chr(39))})"
_DIRECTORY = "CASE WHEN regexp_matches(url, '://[^/]*$') THEN url || '/' ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') END"
LINKS = [LISTING,
         f"frags AS (SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, {q(_LINK)}, 0)) AS frag FROM listing)",
         f"lk AS (SELECT page_id, page_url, {_HREF_OF} AS href, regexp_extract(frag, '</a>(.*)$', 1, 'is') AS tail,"
         f" regexp_extract(tail, {q(_SIZE)}, 1) AS v, upper(regexp_extract(tail, {q(_SIZE)}, 2)) AS u FROM frags)",
         "links AS (SELECT page_id, page_url, href, CASE WHEN v <> '' THEN concat(v, u) END AS size_text,"
         " CASE WHEN v <> '' THEN CAST(floor(CAST(v AS DOUBLE) * CAST(CASE u WHEN 'K' THEN 1024"
         " WHEN 'M' THEN 1048576 WHEN 'G' THEN 1073741824 WHEN 'T' THEN 1099511627776 END AS DOUBLE))"
         " AS BIGINT) END AS size_bytes FROM lk)"]
_DAILY, _ZONE = "^AIS_([0-9]{4})_([0-9][0-9])_([0-9][0-9])[.]zip$", "^AIS_([0-9]{4})_Zone([0-9][0-9])_([0-9][0-9])[.]zip$"
_REGIONAL = "^AIS_([0-9]{4})_([0-9A-Z_a-z]+)[.]zip$"


def _classified(src: str, col: str, extra: str = "") -> str:
    d, z, r = q(_DAILY), q(_ZONE), q(_REGIONAL)
    isd, isz, isr = f"regexp_matches({col}, {d})", f"regexp_matches({col}, {z})", f"regexp_matches({col}, {r})"
    return (f"SELECT *{extra} FROM (SELECT {src}.*,"
            f" CASE WHEN {isd} THEN 'daily' WHEN {isz} THEN 'zone' WHEN {isr} THEN 'regional' END AS type,"
            f" CASE WHEN {isd} THEN regexp_extract({col}, {d}, 1) WHEN {isz} THEN regexp_extract({col}, {z}, 1)"
            f" WHEN {isr} THEN regexp_extract({col}, {r}, 1) END AS year,"
            f" CASE WHEN {isd} THEN CAST(regexp_extract({col}, {d}, 2) AS INTEGER) END AS month,"
            f" CASE WHEN {isd} THEN CAST(regexp_extract({col}, {d}, 3) AS INTEGER) END AS day,"
            f" CASE WHEN {isz} THEN regexp_extract({col}, {z}, 2) END AS zone,"
            f" CASE WHEN {isz} THEN regexp_extract({col}, {z}, 3) END AS sequence,"
            f" CASE WHEN {isr} AND NOT {isd} AND NOT {isz} THEN regexp_extract({col}, {r}, 2) END AS region"
            f" FROM {src}) WHERE type IS NOT NULL")


BASE_URL = q('https://archive.example/ais/')
FILES = LINKS + [
    f"zl AS (SELECT page_id, href AS filename, size_text, size_bytes, (SELECT {_DIRECTORY} FROM (SELECT page_url AS url)) || href AS url FROM links"
    " WHERE suffix(href, '.zip') AND contains(href, 'AIS'))",
    f"files AS ({_classified('zl', 'filename')})",
]
FILE_COLS = ("page_id, filename, type, year, month, day, zone, sequence, region, size_text, size_bytes, url")
YEARS = [LISTING,
         f"hrefs AS (SELECT page_id, unnest(regexp_extract_all(html, {q(_TAG)}, 0)) AS frag, {_HREF_OF} AS href FROM listing)",
         "years AS (SELECT regexp_extract(href, '([0-9]{4})/?$', 1) AS year, count(DISTINCT page_id) AS pages"
         " FROM hrefs WHERE regexp_matches(href, '(^|/)[0-9]{4}/?$') GROUP BY 1)"]
ORDER_FILES = "ORDER BY coalesce(month, 0), coalesce(day, 0), filename, page_id"


def _fmt1(x: str, unit: str) -> str:
    return (f"CAST(CAST(round(CAST({x} AS DECIMAL(38,12)), 1) AS DECIMAL(38,1)) AS VARCHAR) || ' {unit}'")


PRETTY = ("CASE WHEN size_bytes IS NULL OR size_bytes = 0 THEN 'unknown'"
          f" WHEN CAST(size_bytes AS DOUBLE) > 1073741824.0 THEN {_fmt1('CAST(size_bytes AS DOUBLE) / 1073741824.0', 'GB')}"
          f" WHEN CAST(size_bytes AS DOUBLE) > 1048576.0 THEN {_fmt1('CAST(size_bytes AS DOUBLE) / 1048576.0', 'MB')}"
          f" ELSE {_fmt1('CAST(size_bytes AS DOUBLE) / 1024.0', 'KB')} END")
DETAILS = ("CASE type WHEN 'daily' THEN 'Date: ' || year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '-'"
           " || lpad(CAST(day AS VARCHAR), 2, '0') WHEN 'zone' THEN 'Zone: ' || zone || ', Sequence: ' || sequence"
           " WHEN 'regional' THEN 'Region: ' || region END")

oracle("index_years", with_(YEARS, "SELECT year, pages FROM years ORDER BY year DESC"))
oracle("index_files", with_(FILES, f"SELECT {FILE_COLS} FROM files"))
oracle("archive_names", with_(LINKS + ["nm AS (SELECT page_id, href AS filename FROM links)"],
                              _classified("nm", "filename")))
oracle("size_to_bytes", with_(LINKS, "SELECT page_id, href, size_text, size_bytes FROM links"
                                     " WHERE size_text IS NOT NULL"))
oracle("archive_listing", with_(FILES + [f"shown AS (SELECT * FROM files {ORDER_FILES} LIMIT 5)"], f"""
SELECT page_id, filename, type, {PRETTY} AS size_display, {DETAILS} AS details, size_bytes,
  CAST(greatest((SELECT count(*) FROM files) - 5, 0) AS BIGINT) AS more_files,
  CAST(coalesce((SELECT sum(CASE WHEN size_bytes > 0 THEN size_bytes END) FROM shown), 0) AS BIGINT) AS listed_known_bytes,
  (SELECT CASE WHEN t > 0 THEN (CASE WHEN CAST(t AS DOUBLE) > 1073741824.0
      THEN {_fmt1('CAST(t AS DOUBLE) / 1073741824.0', 'GB')} ELSE {_fmt1('CAST(t AS DOUBLE) / 1048576.0', 'MB')} END) END
   FROM (SELECT sum(CASE WHEN size_bytes > 0 THEN size_bytes END) AS t FROM shown)) AS listed_total_display
FROM shown"""))
oracle("archive_select", with_(FILES, f"""
(SELECT {FILE_COLS}, 'position 3' AS selected_by FROM files {ORDER_FILES} LIMIT 1 OFFSET 2)
UNION ALL
(SELECT {FILE_COLS}, 'pattern Zone0' AS selected_by FROM files WHERE contains(filename, 'Zone0'))"""))
oracle("archive_urls", with_(FILES + YEARS[1:], f"""
SELECT year, zone, {BASE_URL} || year || '/AIS_' || year || '_' || coalesce(zone, '01_01') || '.zip' AS url FROM (
  SELECT year, CASE type WHEN 'zone' THEN 'Zone' || zone || '_' || sequence
    WHEN 'daily' THEN lpad(CAST(month AS VARCHAR), 2, '0') || '_' || lpad(CAST(day AS VARCHAR), 2, '0')
    ELSE region END AS zone FROM files
  UNION ALL SELECT year, NULL AS zone FROM years)"""))
