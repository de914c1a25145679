"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the driver's tables (through the ``events`` adapter, or
``pages`` for the archive catalog) and runs over the whole of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline import sinks
from trackline.operators import clean as C
from trackline.operators import fleet, profile, sketches, tracks, traffic, vessels
from trackline.plans.context import cleaned, legs, materialized_metrics, metrics, raw, rounded
from trackline.schema import CANONICAL_COLUMNS, SOURCE_COLUMNS
from trackline.session import scratch_path
from trackline.sources import archives, catalog, positions
from trackline.sources.fixture import RAW_COLUMNS, TURNED, listing_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- cleaning -------------------------------------------------------------

@query("coerce_types")
def q_coerce_types(spark, sf):
    r = raw(spark, sf)
    as_text = r.select(*[F.col(c).cast("string").alias(c) if c != "ingest_seq" else F.col(c) for c in r.columns])
    return rounded(C.coerce_types(as_text).select(*RAW_COLUMNS))


@query("drop_incomplete")
def q_drop_incomplete(spark, sf):
    return rounded(C.drop_incomplete(raw(spark, sf)))


@query("valid_coordinates")
def q_valid_coordinates(spark, sf):
    return rounded(C.valid_coordinates(C.drop_incomplete(raw(spark, sf))))


@query("valid_speed")
def q_valid_speed(spark, sf):
    return rounded(C.valid_speed(C.valid_coordinates(C.drop_incomplete(raw(spark, sf)))))


@query("dedupe_positions")
def q_dedupe_positions(spark, sf):
    return rounded(C.dedupe_positions(raw(spark, sf)))


@query("sorted_positions")
def q_sorted_positions(spark, sf):
    return rounded(C.sorted_positions(cleaned(spark, sf)))


@query("clean")
def q_clean(spark, sf):
    return rounded(cleaned(spark, sf))


@query("cleaning_report")
def q_cleaning_report(spark, sf):
    return C.cleaning_report(raw(spark, sf))


@query("constraint_violations")
def q_constraint_violations(spark, sf):
    return C.constraint_violations(raw(spark, sf)).select("mmsi", "base_datetime", "ingest_seq", "violations")


@query("uniqueness_violations")
def q_uniqueness_violations(spark, sf):
    return C.uniqueness_violations(raw(spark, sf))


@query("limit_records")
def q_limit_records(spark, sf):
    return rounded(C.limit_records(raw(spark, sf), 1000))


@query("profile")
def q_profile(spark, sf):
    return profile.load_profile(raw(spark, sf))


@query("top_vessel_types")
def q_top_vessel_types(spark, sf):
    return profile.top_vessel_types(raw(spark, sf))


@query("column_fill")
def q_column_fill(spark, sf):
    return rounded(profile.column_fill(raw(spark, sf)))


@query("distinct_vessel_sketches")
def q_distinct_vessel_sketches(spark, sf):
    """Vessels of the last 7 and 30 days and of all, from the day sketches of two loads that are written and read again."""
    path = scratch_path(spark, "sketches")
    c = cleaned(spark, sf)
    for half in (F.col("base_datetime") < _split(), F.col("base_datetime") >= _split()):
        sketches.daily_sketches(c.where(half)).write.mode("append").parquet(path)
    daily = sketches.merged(spark.read.parquet(path), "traffic_date")
    spans = [("7 days", 7), ("30 days", 30), ("all", None)]
    parts = [sketches.distinct_vessels(daily, d).select(F.lit(name).alias("span"), "positions", "vessels") for name, d in spans]
    return parts[0].union(parts[1]).union(parts[2])


# --- tracks ----------------------------------------------------------------

@query("track_legs")
def q_track_legs(spark, sf):
    return rounded(legs(spark, sf, "geodesic"))


@query("haversine_legs")
def q_haversine_legs(spark, sf):
    return rounded(legs(spark, sf, "haversine"))


@query("vessel_distance")
def q_vessel_distance(spark, sf):
    return rounded(tracks.vessel_distance(cleaned(spark, sf)))


@query("vessel_distance_long_legs")
def q_vessel_distance_long_legs(spark, sf):
    """Tracks that cross to nearly antipodal points and back: no leg is without a distance."""
    turned = raw(spark, sf).withColumns({c: F.expr(e) for c, e in TURNED.items()})
    return rounded(tracks.vessel_distance(C.clean(turned)), 4)


@query("vessel_time_split")
def q_vessel_time_split(spark, sf):
    return rounded(tracks.vessel_time_split(cleaned(spark, sf)))


@query("vessel_metrics")
def q_vessel_metrics(spark, sf):
    return rounded(metrics(spark, sf))


@query("vessel_extents")
def q_vessel_extents(spark, sf):
    return rounded(tracks.vessel_extents(cleaned(spark, sf)))


@query("top_vessels")
def q_top_vessels(spark, sf):
    return rounded(vessels.top_vessels(metrics(spark, sf)))


# --- fleet reports -----------------------------------------------------------

@query("time_analysis")
def q_time_analysis(spark, sf):
    return rounded(fleet.time_analysis(metrics(spark, sf)))


@query("data_quality")
def q_data_quality(spark, sf):
    return rounded(fleet.data_quality(cleaned(spark, sf)))


@query("data_quality_raw")
def q_data_quality_raw(spark, sf):
    return rounded(fleet.data_quality(raw(spark, sf)))


@query("point_statistics")
def q_point_statistics(spark, sf):
    return rounded(fleet.point_statistics(metrics(spark, sf)))


@query("fleet_additional")
def q_fleet_additional(spark, sf):
    return rounded(fleet.fleet_additional(metrics(spark, sf)))


@query("fleet_statistics")
def q_fleet_statistics(spark, sf):
    return rounded(fleet.fleet_statistics(metrics(spark, sf), cleaned(spark, sf)))


@query("time_share")
def q_time_share(spark, sf):
    return rounded(fleet.time_share(metrics(spark, sf)))


@query("quality_long")
def q_quality_long(spark, sf):
    return rounded(fleet.quality_long(cleaned(spark, sf)))


@query("headline")
def q_headline(spark, sf):
    return fleet.headline(metrics(spark, sf), cleaned(spark, sf))


@query("distance_histogram")
def q_distance_histogram(spark, sf):
    return rounded(fleet.distance_histogram(materialized_metrics(spark, sf)))


@query("speed_histogram")
def q_speed_histogram(spark, sf):
    return rounded(fleet.speed_histogram(materialized_metrics(spark, sf)))


@query("comprehensive_report")
def q_comprehensive_report(spark, sf):
    m = materialized_metrics(spark, sf)
    return rounded(fleet.comprehensive_report(m, cleaned(spark, sf), vessels.top_vessels(m)))


@query("metrics_summary")
def q_metrics_summary(spark, sf):
    return rounded(fleet.metrics_summary(materialized_metrics(spark, sf), cleaned(spark, sf)))


# --- vessels -----------------------------------------------------------------

@query("vessel_page")
def q_vessel_page(spark, sf):
    return rounded(vessels.vessel_page(metrics(spark, sf), limit=100, offset=50))


@query("vessel_search")
def q_vessel_search(spark, sf):
    return rounded(vessels.vessel_search(metrics(spark, sf), name="vessel 1", min_distance=100.0, limit=50))


@query("vessel_search_type")
def q_vessel_search_type(spark, sf):
    return rounded(vessels.vessel_search(metrics(spark, sf), max_distance=2000.0, limit=500,
                                         positions=cleaned(spark, sf), vessel_type="80"))


@query("vessel_detail")
def q_vessel_detail(spark, sf):
    return rounded(vessels.vessel_detail(metrics(spark, sf), cleaned(spark, sf), mmsi=7))


@query("recent_positions")
def q_recent_positions(spark, sf):
    return rounded(tracks.recent_positions(cleaned(spark, sf), n=100))


@query("decode_types")
def q_decode_types(spark, sf):
    d = vessels.decode_types(cleaned(spark, sf), vessels.vessel_type_codes(spark))
    return d.select("mmsi", "base_datetime", "vessel_type", "type_description", "type_category")


@query("decode_status")
def q_decode_status(spark, sf):
    d = vessels.decode_status(cleaned(spark, sf), vessels.navigation_status_codes(spark))
    return d.select("mmsi", "base_datetime", "status", "status_description")


# --- traffic -----------------------------------------------------------------

@query("traffic_summary")
def q_traffic_summary(spark, sf):
    return rounded(traffic.traffic_summary(cleaned(spark, sf)))


@query("active_vessels")
def q_active_vessels(spark, sf):
    return rounded(traffic.active_vessels(cleaned(spark, sf), metrics(spark, sf)))


@query("daily_traffic")
def q_daily_traffic(spark, sf):
    return rounded(traffic.daily_traffic(cleaned(spark, sf)))


# --- table maintenance ---------------------------------------------------------

SNAPSHOT_SPLIT = "2024-01-16 00:00:00"


def _snapshots(spark, sf):
    """Metrics as of the split time (old) and over the reports after it (new)."""
    c = cleaned(spark, sf)
    split = F.lit(SNAPSHOT_SPLIT).cast("timestamp_ntz")
    old = tracks.vessel_metrics(c.where(F.col("base_datetime") < split))
    new = tracks.vessel_metrics(c.where(F.col("base_datetime") >= split))
    return c, old, new


@query("insert_if_absent")
def q_insert_if_absent(spark, sf):
    from trackline.operators.changes import insert_if_absent
    codes = vessels.vessel_type_codes(spark)
    seen = (cleaned(spark, sf).select(F.trim("vessel_type").try_cast("int").alias("code"))
            .where(F.col("code").isNotNull()).distinct())
    new = seen.select("code", F.concat(F.lit("Type "), F.col("code").cast("string")).alias("description"),
                      F.lit("Unclassified").alias("category"))
    return insert_if_absent(codes, new, "code")


@query("upsert_stamped")
def q_upsert_stamped(spark, sf):
    from trackline.operators.changes import upsert_stamped
    c, old, new = _snapshots(spark, sf)
    t_old = F.lit(SNAPSHOT_SPLIT).cast("timestamp_ntz")
    current = old.withColumn("created_at", t_old).withColumn("updated_at", t_old)
    as_of = c.agg(F.max("base_datetime")).scalar()
    return rounded(upsert_stamped(current, new, "mmsi", as_of))


@query("table_changes")
def q_table_changes(spark, sf):
    from trackline.operators.changes import table_changes
    _, old, new = _snapshots(spark, sf)
    ch = table_changes(old, new, "mmsi", "vessel_metrics")

    def field(side, name, typ):
        return F.get_json_object(F.col(f"{side}_values"), f"$.{name}").try_cast(typ).alias(f"{side}_{name}")

    return rounded(ch.select(
        "operation", "table_name", "record_id",
        field("old", "total_distance_nm", "double"), field("new", "total_distance_nm", "double"),
        field("old", "point_count", "long"), field("new", "point_count", "long"),
        field("old", "vessel_name", "string"), field("new", "vessel_name", "string"),
    ))


# --- sources (write the adapter rows as files, read them back) -----------------


def _split():
    return F.lit(SNAPSHOT_SPLIT).cast("timestamp_ntz")


READ_BACK = ["mmsi", "base_datetime", "latitude", "longitude", "sog", "cog", "vessel_name", "vessel_type", "status"]
STANDARD_HEADER = {"mmsi": "MMSI", "base_datetime": "Timestamp", "latitude": "Lat", "longitude": "Lon",
                   "sog": "Speed", "cog": "Course", "vessel_name": "Name", "vessel_type": "ShipType",
                   "status": "NavStatus"}


def _as_source_text(df: DataFrame) -> DataFrame:
    """Adapter rows as the 17 text columns of a source file (absent columns empty)."""
    return df.select(*[(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(src)
                       for src, c in zip(SOURCE_COLUMNS, CANONICAL_COLUMNS)])


def _write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """One CSV file per partition of ``df`` (the file count grows with the data)."""
    df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)
    return path


def _typed(df: DataFrame) -> DataFrame:
    return rounded(C.coerce_types(df).select(*READ_BACK))


@query("read_positions")
def q_read_positions(spark, sf):
    path = _write_csv(_as_source_text(raw(spark, sf)), scratch_path(spark, "noaa"))
    return _typed(positions.read_positions(spark, path))


@query("read_positions_reordered")
def q_read_positions_reordered(spark, sf):
    """Headed files whose columns stand in reverse order."""
    text = _as_source_text(raw(spark, sf))
    path = _write_csv(text.select(*reversed(text.columns)), scratch_path(spark, "reordered"))
    return _typed(positions.read_positions(spark, path))


@query("read_positions_extra_column")
def q_read_positions_extra_column(spark, sf):
    """Headed files with a column that the table does not have."""
    path = _write_csv(_as_source_text(raw(spark, sf)).withColumn("Port", F.lit("x")), scratch_path(spark, "extra"))
    return _typed(positions.read_positions(spark, path))


@query("read_positions_headerless")
def q_read_positions_headerless(spark, sf):
    path = _write_csv(_as_source_text(raw(spark, sf)), scratch_path(spark, "headerless"), header=False)
    return _typed(positions.read_positions_headerless(spark, path))


@query("read_positions_standard")
def q_read_positions_standard(spark, sf):
    r = raw(spark, sf)
    text = r.select(*[F.col(c).cast("string").alias(h) for c, h in STANDARD_HEADER.items()])
    path = _write_csv(text, scratch_path(spark, "standard"))
    return _typed(positions.read_positions_standard(spark, path))


@query("combine_files")
def q_combine_files(spark, sf):
    r = raw(spark, sf)
    a = _write_csv(_as_source_text(r.where(F.col("base_datetime") < _split())), scratch_path(spark, "part_a"))
    later = r.where(F.col("base_datetime") >= _split())
    b = _write_csv(later.select(*[F.col(c).cast("string").alias(h) for c, h in STANDARD_HEADER.items()
                                  if c not in ("vessel_type", "status")]), scratch_path(spark, "part_b"))
    combined = positions.combine_files([positions.read_positions(spark, a),
                                        positions.read_positions_standard(spark, b, fill_missing=False)])
    return _typed(combined)


@query("read_zip_positions")
def q_read_zip_positions(spark, sf):
    text = _as_source_text(raw(spark, sf))
    lines = text.select(F.to_csv(F.struct(*text.columns), {"escape": '"'}).alias("line"))
    folder = scratch_path(spark, "archives")
    archives.write_archives(lines, folder)  # one archive per input partition
    return _typed(archives.read_zip_positions(spark, folder))


@query("detect_format")
def q_detect_format(spark, sf):
    r = raw(spark, sf)
    base = scratch_path(spark, "formats")
    _write_csv(_as_source_text(r), f"{base}/noaa")
    _write_csv(_as_source_text(r), f"{base}/headerless", header=False)
    _write_csv(r.select(*[F.col(c).cast("string").alias(h) for c, h in STANDARD_HEADER.items()]),
               f"{base}/standard")
    found = positions.detect_format(spark, [f"{base}/noaa", f"{base}/headerless", f"{base}/standard"])
    folder = F.element_at(F.split("file_path", "/"), -2).alias("folder")
    return found.select(folder, "format", F.when(F.col("format") != "noaa_no_header", F.col("first_line")).alias("header")).distinct()


@query("file_inventory")
def q_file_inventory(spark, sf):
    path = _write_csv(_as_source_text(raw(spark, sf)), scratch_path(spark, "inventory"))
    listed = positions.file_inventory(spark, path, glob="*.csv")
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("name"), "value").groupBy("name").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value") + 1).alias("octets"))
    both = listed.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(lines, "name", "full_outer")
    # every file is listed with its size: its lines, without the header, add up to the rows written
    return both.agg((F.sum("lines") - F.count("path")).alias("rows"), F.bool_and(F.col("length").eqNullSafe(F.col("octets"))).alias("sizes_match"))


# --- sinks ---------------------------------------------------------------------

def _as_of(df: DataFrame):
    return df.agg(F.max("base_datetime")).scalar()


@query("sink_positions")
def q_sink_positions(spark, sf):
    c = cleaned(spark, sf)
    path = scratch_path(spark, "positions")
    sinks.sink_positions(c, path, as_of=_as_of(c), max_records_per_file=1_000_000)
    back = spark.read.parquet(path)
    return rounded(back.select(*READ_BACK, "ingest_seq", "traffic_date", "created_at"))


@query("bucketed_metrics")
def q_bucketed_metrics(spark, sf):
    """Vessel metrics from a table in buckets by vessel: no exchange between the files and the result."""
    table = f"positions_{uuid.uuid4().hex[:12]}"
    sinks.sink_bucketed(cleaned(spark, sf), table, scratch_path(spark, table), buckets=16)
    return rounded(tracks.vessel_metrics(spark.table(table)))


@query("sink_metrics")
def q_sink_metrics(spark, sf):
    c = cleaned(spark, sf)
    path = scratch_path(spark, "metrics")
    sinks.sink_metrics(tracks.vessel_metrics(c, extended=True), path, as_of=_as_of(c))
    return rounded(spark.read.parquet(path).select(*tracks.METRIC_COLUMNS, "last_updated"))


@query("staging_roundtrip")
def q_staging_roundtrip(spark, sf):
    c = cleaned(spark, sf)
    base = scratch_path(spark, "staging")
    sinks.stage(c, base, "2024-01-31", "cleaned")
    staged = sinks.read_stage(spark, base, "2024-01-31", "cleaned")
    sinks.stage(tracks.vessel_metrics(staged), base, "2024-01-31", "metrics")
    return rounded(sinks.read_stage(spark, base, "2024-01-31", "metrics"))


@query("report_json")
def q_report_json(spark, sf):
    m = materialized_metrics(spark, sf)
    report = fleet.comprehensive_report(m, cleaned(spark, sf), vessels.top_vessels(m))
    path = scratch_path(spark, "report")
    sinks.report_json(report, path)
    return rounded(sinks.read_report_json(spark, path, report))


# --- streaming -------------------------------------------------------------------

def _stream_run(spark, sf, rollup: bool):
    from trackline.streaming.ingest import incremental_ingest
    r = raw(spark, sf)
    base = scratch_path(spark, "stream")
    src = f"{base}/incoming"
    rollup_dir = f"{base}/daily" if rollup else None
    _write_csv(_as_source_text(r.where(F.col("base_datetime") < _split())), f"{src}/day_a")
    incremental_ingest(spark, f"{src}/*", f"{base}/table", f"{base}/checkpoint", rollup_dir)
    _write_csv(_as_source_text(r.where(F.col("base_datetime") >= _split())), f"{src}/day_b")
    incremental_ingest(spark, f"{src}/*", f"{base}/table", f"{base}/checkpoint", rollup_dir)
    return base


@query("incremental_ingest")
def q_incremental_ingest(spark, sf):
    from trackline.streaming.ingest import read_positions_table
    base = _stream_run(spark, sf, rollup=False)
    return rounded(read_positions_table(spark, f"{base}/table").select(*READ_BACK))


@query("refresh_daily")
def q_refresh_daily(spark, sf):
    from trackline.streaming.ingest import DAILY_COLUMNS
    base = _stream_run(spark, sf, rollup=True)
    return rounded(spark.read.parquet(f"{base}/daily").select(*DAILY_COLUMNS))


# --- pipeline ----------------------------------------------------------------------

@query("pipeline_end_to_end")
def q_pipeline_end_to_end(spark, sf):
    import datetime as dt

    from trackline.plans.pipeline import run_pipeline
    result = run_pipeline(spark, scratch_path(spark, "store"), raw=raw(spark, sf), as_of=dt.datetime(2024, 1, 31))
    return rounded(result.report)


# --- archive catalog ------------------------------------------------------------------

def _files(spark, sf):
    return catalog.index_files(listing_pages(spark, sf))


@query("index_years")
def q_index_years(spark, sf):
    return catalog.index_years(listing_pages(spark, sf))


@query("index_files")
def q_index_files(spark, sf):
    return _files(spark, sf)


@query("archive_names")
def q_archive_names(spark, sf):
    names = catalog.links(listing_pages(spark, sf)).select("page_id", "filename")
    return catalog.archive_names(names)


@query("size_to_bytes")
def q_size_to_bytes(spark, sf):
    return catalog.size_to_bytes(listing_pages(spark, sf))


@query("archive_listing")
def q_archive_listing(spark, sf):
    return catalog.archive_listing(_files(spark, sf), max_files=5)


@query("archive_select")
def q_archive_select(spark, sf):
    return catalog.archive_select(_files(spark, sf), position=3, pattern="Zone0")


@query("archive_urls")
def q_archive_urls(spark, sf):
    pages = listing_pages(spark, sf)
    files = catalog.index_files(pages)
    zone = (F.when(F.col("type") == "zone", F.concat(F.lit("Zone"), F.col("zone"), F.lit("_"), F.col("sequence")))
            .when(F.col("type") == "daily", F.concat(F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("_"),
                                                     F.lpad(F.col("day").cast("string"), 2, "0")))
            .otherwise(F.col("region")))
    requests = files.select("year", zone.alias("zone")).unionByName(
        catalog.index_years(pages).select("year", F.lit(None).cast("string").alias("zone")))
    return catalog.archive_urls(requests)
