"""Writers: positions (date-partitioned append), metrics (stamped overwrite), staging, JSON, JDBC.

Paths should live on the cluster's shared file system (see
``session.scratch_path`` for hand-offs).  A written table is also how long
jobs cut lineage: downstream stages read it back instead of recomputing.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.functions.numeric import ntz_literal

from trackline.schema import SOURCE_TO_CANONICAL


def to_canonical_names(df: DataFrame) -> DataFrame:
    """Rename source headers to stored names; lower-case every other column."""
    renamed = df.withColumnsRenamed({k: v for k, v in SOURCE_TO_CANONICAL.items() if k in df.columns})
    return renamed.toDF(*[c.lower() for c in renamed.columns])


def _stamp(as_of: dt.datetime | Column | None) -> Column:
    if as_of is None:
        return F.localtimestamp()
    return as_of if isinstance(as_of, Column) else ntz_literal(as_of)


def sink_positions(df: DataFrame, path: str, mode: str = "append", as_of: dt.datetime | Column | None = None,
                   max_records_per_file: int | None = None) -> None:
    """Write positions partitioned by UTC date, stamping ``created_at``/``updated_at``.

    Rows are clustered by date before the write so each task writes few
    files.  The clustering is a REBALANCE (not a plain repartition by date):
    AQE splits an oversized date over several tasks, so a date holding a large
    share of the data is not written by one task.  ``max_records_per_file``
    caps file size (the batch-size knob).
    """
    stamp = _stamp(as_of)
    out = (to_canonical_names(df)
           .withColumn("traffic_date", F.to_date("base_datetime"))
           .withColumn("created_at", stamp).withColumn("updated_at", stamp)
           .hint("rebalance", "traffic_date"))
    w = out.write.mode(mode).partitionBy("traffic_date")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)


def sink_bucketed(df: DataFrame, table: str, path: str, buckets: int, mode: str = "overwrite") -> None:
    """Write positions as a table in ``buckets`` by vessel, sorted by vessel and time.

    Whatever groups or joins by vessel (metrics, latest reports, joins of two tables with as many buckets)
    reads it without an exchange.  A vessel lies in one bucket, so this suits stores whose busiest vessel is
    small beside a bucket; ``sink_positions`` has no such limit.
    """
    (to_canonical_names(df).repartition(buckets, "mmsi").write.mode(mode).format("parquet").option("path", path)
     .bucketBy(buckets, "mmsi").sortBy("mmsi", "base_datetime").saveAsTable(table))


def sink_metrics(metrics: DataFrame, path: str, as_of: dt.datetime | Column | None = None) -> None:
    """Replace the metrics table, stamping ``last_updated``."""
    metrics.withColumn("last_updated", _stamp(as_of)).write.mode("overwrite").parquet(path)


def stage(df: DataFrame, base: str, ds: str, name: str) -> str:
    """Write a date-stamped staging copy ``{base}/{ds}/{name}`` (overwrite) and return its path."""
    path = os.path.join(base, ds, name)
    df.write.mode("overwrite").parquet(path)
    return path


def read_stage(spark: SparkSession, base: str, ds: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, ds, name))


def report_json(report: DataFrame, path: str) -> None:
    """Write a report as JSON lines; timestamps in ISO form, NULL fields kept."""
    (report.coalesce(1).write.mode("overwrite")
     .option("ignoreNullFields", "false").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .json(path))


def read_report_json(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return (spark.read.schema(like.schema).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .json(path))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append",
               batch_size: int = 1000) -> None:
    """Load into a relational database through JDBC."""
    df.write.option("batchsize", batch_size).jdbc(url, table, mode=mode, properties=properties)


def create_tables(spark: SparkSession, base: str, database: str | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` for the stored tables, as Parquet tables under ``base``.

    Positions are partitioned by date.  Existing tables are left alone.
    """
    from trackline.schema import METRICS_SCHEMA, POSITIONS_SCHEMA

    def ddl(schema) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    prefix = f"{database}." if database else ""
    pos_cols = ddl(POSITIONS_SCHEMA) + ", `created_at` timestamp_ntz, `updated_at` timestamp_ntz, `traffic_date` date"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}positions ({pos_cols}) USING parquet "
              f"PARTITIONED BY (traffic_date) LOCATION '{os.path.join(base, 'positions')}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}vessel_metrics ({ddl(METRICS_SCHEMA)}) USING parquet "
              f"LOCATION '{os.path.join(base, 'vessel_metrics')}'")
    return [f"{prefix}positions", f"{prefix}vessel_metrics"]
