"""The batch pipeline: load -> (cap) -> clean -> store -> metrics -> store -> report.

Stored tables are the hand-off between stages: positions are written once
(date-partitioned) and metrics are computed from the stored table, so the
cleaned rows are not recomputed for their two consumers and a lost executor
only re-runs the stage it was in.  Input files are entered in a ledger when
their rows are stored, so a run over files that are stored already adds nothing;
rows of one list of files go to one folder, which a repeated run overwrites, and
reports that the store holds are left out.  Metrics come from the whole stored
positions table by default; ``batch_only=True`` computes them from the
current batch alone.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.operators.clean import clean, coerce_types, dedupe_positions, limit_records
from trackline.operators.fleet import comprehensive_report
from trackline.operators.tracks import vessel_metrics
from trackline.operators.vessels import top_vessels
from trackline.sinks import sink_metrics, sink_positions
from trackline.sources.positions import ORDER, file_inventory, ingest_order, read_any


@dataclass
class PipelineResult:
    positions_path: str
    metrics_path: str
    report: DataFrame | None


POSITION_COLUMNS = ["mmsi", "base_datetime", "latitude", "longitude", "sog", "cog", "heading", "vessel_name",
                    "imo", "call_sign", "vessel_type", "status", "length", "width", "draft", "cargo",
                    "transceiver_class"]


def stored_positions(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(os.path.join(store, "positions"))


def stored_metrics(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(os.path.join(store, "vessel_metrics"))


LEDGER = "path string, length long, modified timestamp, processed boolean"


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """Files whose rows are stored: path, length, time of change, and whether they were cleaned."""
    path = os.path.join(store, "ledger")
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException:  # no run yet
        return spark.createDataFrame([], LEDGER)


def new_files(spark: SparkSession, store: str, paths: list[str], processed: bool) -> DataFrame:
    """Ledger entries of the given files that are not in it."""
    found = file_inventory(spark, paths).select("path", "length", F.col("modificationTime").alias("modified"),
                                                F.lit(processed).alias("processed"))
    return found.join(ledger(spark, store), ["path", "length", "modified", "processed"], "left_anti")


def _unstored(spark: SparkSession, store: str, batch: DataFrame, run: str) -> DataFrame:
    """Rows of ``batch`` whose (mmsi, time) the store does not hold, other than from this very run."""
    try:
        stored = stored_positions(spark, store)
    except AnalysisException:  # nothing stored yet
        return batch
    seen = stored.where(F.col("run") != run).select("mmsi", "base_datetime", "traffic_date")
    dated = batch.withColumn("traffic_date", F.to_date("base_datetime"))  # joined on, so that other dates are not read
    return dated.join(seen, ["mmsi", "base_datetime", "traffic_date"], "left_anti").select(*batch.columns)


def report_from_store(spark: SparkSession, store: str) -> DataFrame:
    """Comprehensive report over the stored tables (the stats-only run)."""
    positions, metrics = stored_positions(spark, store), stored_metrics(spark, store)
    return comprehensive_report(metrics, positions, top_vessels(metrics))


def _store_metrics(spark: SparkSession, store: str, method: str, as_of) -> None:
    """Metrics of all stored reports: one per (mmsi, time), the first stored."""
    stored = stored_positions(spark, store).drop("traffic_date").where(
        "mmsi is not null and base_datetime is not null and latitude is not null and longitude is not null and sog is not null")
    source = dedupe_positions(stored.withColumn("_stored", F.struct("created_at", "run")), order_col="_stored")
    metrics = vessel_metrics(source.drop("_stored", "created_at", "updated_at", "run"), method=method, extended=True)
    sink_metrics(metrics, os.path.join(store, "vessel_metrics"), as_of=as_of)


def run_pipeline(spark: SparkSession, store: str, raw: DataFrame | None = None, paths: list[str] | None = None,
                 max_records: int | None = None, skip_processing: bool = False, skip_stats: bool = False,
                 stats_only: bool = False, batch_only: bool = False,
                 as_of: dt.datetime | Column | None = None, method: str = "geodesic") -> PipelineResult:
    """Run the whole pipeline into ``store`` (a folder on the shared file system)."""
    pos_path, met_path = os.path.join(store, "positions"), os.path.join(store, "vessel_metrics")
    if stats_only:
        return PipelineResult(pos_path, met_path, report_from_store(spark, store))
    run, entered = f"r{uuid.uuid4().hex}", None
    if raw is None:
        if not paths:
            raise ValueError("give raw rows or input paths")
        entered = new_files(spark, store, paths, not skip_processing)
        files = sorted(tuple(r) for r in entered.collect())  # the list of files, which any reader plans with
        run = "r" + hashlib.sha256(repr((files, max_records)).encode()).hexdigest()[:32]
        raw = ingest_order(read_any(spark, [f[0] for f in files])) if files else None
        entered = spark.createDataFrame(files, LEDGER) if files else None
        order = ORDER
    else:
        order = "ingest_seq"
    if raw is None:  # all files are stored: figures from the store
        if not (skip_processing or batch_only):
            _store_metrics(spark, store, method, as_of)
        return PipelineResult(pos_path, met_path, None if skip_stats or skip_processing else report_from_store(spark, store))
    if max_records is not None:
        raw = limit_records(raw, max_records, order)
    if skip_processing:
        batch = coerce_types(raw)  # typed like every other run's rows; a bad time becomes NULL
    else:
        batch = clean(raw, order_col=order)
    keep = [c for c in POSITION_COLUMNS if c in batch.columns]
    batch = batch.select(*keep)
    rows = batch if skip_processing else _unstored(spark, store, batch, run)
    sink_positions(rows, os.path.join(pos_path, f"run={run}"), mode="overwrite", as_of=as_of)
    if entered is not None:
        entered.coalesce(1).write.mode("append").parquet(os.path.join(store, "ledger"))
    if not skip_processing:
        if batch_only:
            sink_metrics(vessel_metrics(batch, method=method, extended=True), met_path, as_of=as_of)
        else:
            _store_metrics(spark, store, method, as_of)
    report = None if (skip_stats or skip_processing) else report_from_store(spark, store)
    return PipelineResult(pos_path, met_path, report)
