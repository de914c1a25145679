"""Incremental ingest of newly arrived position files, and refresh of the daily rollup.

``incremental_ingest`` is a Structured Streaming query over the files of a
folder.  Every micro-batch is a bounded list of new files, and ``foreachBatch``

1. reads them with the batch readers, checks ranges and de-duplicates (first
   report per (mmsi, time) in file order),
2. drops reports already in the table -- an anti-join against the stored
   reports of the dates the batch touches only (partition pruning), so the
   table itself is the de-duplication state: no report is loaded twice and
   none is dropped for arriving late, whatever the file order,
3. writes the rest under ``positions/traffic_date=<date>/batch=<id>`` with
   overwrite and commits these folders to the table's manifest (``manifest``).
   A replay of the same batch after a failure ignores its own folders in step 2
   and rewrites them, so the sink is idempotent.  A date's folders are merged
   when they become many, so that nothing grows with the number of batches,
4. (optionally) recomputes the daily traffic rollup for the touched dates
   only, with dynamic partition overwrite.

``Trigger.AvailableNow`` processes what is there and stops, so the same code
serves a scheduled daily run and a continuous one.  A backlog is taken in
micro-batches of at most ``max_files_per_trigger`` files.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackline.operators.clean import (coerce_types, dedupe_positions, drop_incomplete, valid_coordinates,
                                       valid_speed)
from trackline.operators.traffic import daily_traffic
from trackline.schema import CANONICAL_COLUMNS
from trackline.sources.positions import ORDER, PROVENANCE, ingest_order, read_any, read_positions
from trackline.streaming.manifest import MAX_FOLDERS, Manifest, write_dated


LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def _new_files(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the paths of new files; their content is not read here."""
    reader = spark.readStream.format("binaryFile").schema(LISTING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(source_dir).where("length > 0").select("path")


def incremental_ingest(spark: SparkSession, source_dir: str, table_dir: str, checkpoint: str,
                       rollup_dir: str | None = None, header: bool = True,
                       max_files_per_trigger: int | None = 1000, max_folders: int = MAX_FOLDERS) -> dict:
    """Run one AvailableNow pass over ``source_dir``; return the rows read and the number of batches.

    Files may be headed (columns go by name), header-less, "standard" or ZIP
    archives; with ``header=False`` all are CSV without a header line.
    """
    positions_dir = os.path.join(table_dir, "positions")
    stream = _new_files(spark, source_dir, max_files_per_trigger)
    owner: list[str] = []
    counts: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # batch ids start anew with every checkpoint, so a folder is named by query and batch:
        # a replay overwrites its own folder, and never one that another query has written
        if not owner:
            owner.append(spark.read.json(os.path.join(checkpoint, "metadata")).first()["id"])
        name = f"{owner[0]}-{batch_id}"
        paths = [r["path"] for r in batch.collect()]  # max_files_per_trigger at most
        if not paths:
            return
        read = Observation()
        raw = read_any(spark, paths) if header else read_positions(spark, paths, header=False)
        raw = ingest_order(raw).observe(read, F.count(F.lit(1)).alias("rows"))
        valid = valid_speed(valid_coordinates(drop_incomplete(coerce_types(raw))))
        # the de-duplicated batch feeds two jobs (its dates, then the write): keep it
        # (memory and disk; a lost executor recomputes its part from the source files)
        fresh = (dedupe_positions(valid, order_col=ORDER).drop(ORDER, *PROVENANCE)
                 .withColumn("traffic_date", F.to_date("base_datetime"))
                 .persist(StorageLevel.MEMORY_AND_DISK))
        try:
            # the dates of one batch: a short list, used to prune the stored partitions
            dates = [str(r["traffic_date"]) for r in fresh.select("traffic_date").distinct().collect()]
            counts.append(read.get["rows"])
            if not dates:
                return
            new = fresh
            manifest = Manifest(spark, positions_dir)
            stored = manifest.read(dates, but=name)
            if stored is not None:
                new = fresh.join(stored.select("mmsi", "base_datetime"), ["mmsi", "base_datetime"], "left_anti")
            write_dated(new.withColumn("batch", F.lit(name)), positions_dir)
        finally:
            fresh.unpersist()
        manifest.add(name, [d for d in dates if manifest.holds(d, name)])
        if rollup_dir is not None:
            refresh_daily(spark, table_dir, rollup_dir, dates)
        manifest.compact(max_folders)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return {"input_rows": sum(counts), "batches": len(counts)}


def read_positions_table(spark: SparkSession, table_dir: str) -> DataFrame:
    """All ingested positions (the live folders of the table's manifest)."""
    rows = Manifest(spark, os.path.join(table_dir, "positions")).read()
    if rows is None:
        raise ValueError(f"nothing is stored in {table_dir}")
    return rows


def refresh_daily(spark: SparkSession, table_dir: str, rollup_dir: str, dates: list[str]) -> None:
    """Recompute the daily rollup for the touched ``dates`` only (dynamic partition overwrite).

    Only the live folders of those dates are opened, and nothing else is listed.
    """
    affected = Manifest(spark, os.path.join(table_dir, "positions")).read(dates)
    if affected is None:
        return
    rollup = daily_traffic(affected.drop("traffic_date", "batch")).select(*DAILY_COLUMNS)
    (rollup.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("traffic_date").parquet(rollup_dir))


DAILY_COLUMNS = ["unique_vessels", "total_positions", "avg_speed", "max_speed", "moving_positions",
                 "stationary_positions", "traffic_date"]

__all__ = ["incremental_ingest", "read_positions_table", "refresh_daily", "CANONICAL_COLUMNS"]
