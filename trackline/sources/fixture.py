"""Test-data adapter: the driver's ``events`` table seen as raw position reports.

The test data has no position table, so ``events`` stands in (user = vessel,
value = speed x 5).  Nulls, out-of-range values and duplicate reports are
planted by pure arithmetic on the ids, so every engine derives the same rows;
every event is kept (planting changes values, never drops rows), and a
fraction of the reports is repeated as later copies to exercise de-duplication.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The adapter's column expressions, shared with the SQL oracle.
# ``ts`` is already TIMESTAMP_NTZ in Spark; the oracle casts to TIMESTAMP.
ADAPTER_COLUMNS = [
    ("mmsi", "user_id"),
    ("base_datetime", "{ts}"),
    ("latitude", "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN CAST(95.0 AS DOUBLE)"
                 " ELSE CAST((user_id * 37) % 120 - 60 AS DOUBLE) + CAST(event_id % 1000 AS DOUBLE) / 1000.0 END"),
    ("longitude", "CASE WHEN event_id % 83 = 0 THEN CAST(-190.0 AS DOUBLE)"
                  " ELSE CAST((user_id * 73) % 340 - 170 AS DOUBLE) + CAST((event_id * 7) % 1000 AS DOUBLE) / 1000.0 END"),
    ("sog", "CASE WHEN event_id % 101 = 0 THEN NULL ELSE value / 5.0 END"),
    ("cog", "CAST((event_id * 13) % 360 AS DOUBLE)"),
    ("vessel_name", "CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 13 = 0 THEN ''"
                    " ELSE concat('VESSEL ', CAST(user_id AS STRING)) END"),
    ("vessel_type", "CASE event_type WHEN 'view' THEN '70' WHEN 'click' THEN '80' WHEN 'purchase' THEN '52'"
                    " WHEN 'signup' THEN '60' ELSE '99' END"),
    ("status", "CASE event_type WHEN 'error' THEN '5' ELSE '0' END"),
    ("ingest_seq", "event_id"),
]
COPY_SEQ_OFFSET = 1_000_000_000
COPY_EVERY = 50

# Every third report moved to the far side of the globe, so that legs run between nearly antipodal points.
TURNED = {
    "latitude": "CASE WHEN ingest_seq % 3 = 0 THEN -latitude ELSE latitude END",
    "longitude": "CASE WHEN ingest_seq % 3 <> 0 THEN longitude WHEN longitude > 0 THEN longitude - 180 ELSE longitude + 180 END",
}

RAW_COLUMNS = [name for name, _ in ADAPTER_COLUMNS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, typed position reports derived from ``events`` (with planted defects)."""
    events = table(spark, sf_dir, "events")
    base = events.select(*[F.expr(sql.format(ts="ts")).alias(name) for name, sql in ADAPTER_COLUMNS])
    copies = (base.where(F.col("ingest_seq") % COPY_EVERY == 0)
              .withColumn("ingest_seq", F.col("ingest_seq") + F.lit(COPY_SEQ_OFFSET)))
    return base.unionByName(copies)


def raw_positions_sql() -> str:
    """The same adapter as a SQL CTE named ``raw`` (for the DuckDB oracle)."""
    cols = ",\n    ".join(f"{sql.format(ts='CAST(ts AS TIMESTAMP)')} AS {name}" for name, sql in ADAPTER_COLUMNS)
    names = ", ".join(RAW_COLUMNS[:-1])
    return (
        f"b AS (SELECT\n    {cols}\n  FROM events),\n"
        f"raw AS (SELECT * FROM b UNION ALL SELECT {names}, ingest_seq + {COPY_SEQ_OFFSET} AS ingest_seq"
        f" FROM b WHERE ingest_seq % {COPY_EVERY} = 0)"
    )


# The archive-index fragment appended to each page of ``pages``
# (the test pages have links but no archive names).  Plain SQL text that both
# Spark and DuckDB evaluate identically.  Per page: one link chosen by
# page_id % 7 (year folder, daily / zone / regional archive, a non-archive file,
# a second daily archive, an archive-like name without "AIS"), then an
# optional size ("<value><unit>", unit by (page_id / 7) % 4: none, K, M, G).
_N7 = "CAST(floor(page_id / 7) AS BIGINT)"
_YEAR = f"CAST(2015 + {_N7} % 10 AS STRING)"
_MM = f"lpad(CAST({_N7} % 12 + 1 AS STRING), 2, '0')"
_DD = "lpad(CAST(CAST(floor(page_id / 84) AS BIGINT) % 28 + 1 AS STRING), 2, '0')"
_NN = f"lpad(CAST({_N7} % 20 + 1 AS STRING), 2, '0')"
_REGION = f"CASE {_N7} % 4 WHEN 0 THEN 'GulfCoast' WHEN 1 THEN 'Atlantic' WHEN 2 THEN 'Pacific' ELSE 'GreatLakes' END"
LISTING_NAME_SQL = (
    f"CASE page_id % 7"
    f" WHEN 0 THEN concat({_YEAR}, '/')"
    f" WHEN 1 THEN concat('AIS_', {_YEAR}, '_', {_MM}, '_', {_DD}, '.zip')"
    f" WHEN 2 THEN concat('AIS_', {_YEAR}, '_Zone', {_NN}, '_', {_MM}, '.zip')"
    f" WHEN 3 THEN concat('AIS_', {_YEAR}, '_', {_REGION}, '.zip')"
    f" WHEN 4 THEN 'readme.txt'"
    f" WHEN 5 THEN concat('AIS_', {_YEAR}, '_', {_DD}, '_', {_MM}, '.zip')"
    f" ELSE concat('data_', {_YEAR}, '.zip') END"
)
_UNIT = f"CASE {_N7} % 4 WHEN 1 THEN 'K' WHEN 2 THEN 'M' WHEN 3 THEN 'G' ELSE '' END"
_VALUE = "CAST(CAST((page_id * 37) % 9000 + 100 AS DOUBLE) / 10.0 AS STRING)"
_SIZE = f"CASE WHEN {_UNIT} = '' THEN '' ELSE concat('   ', {_VALUE}, {_UNIT}) END"
# Three ways in which index pages write a link and its size, by page_id.
LISTING_FRAGMENT_SQL = (
    f"CASE CAST(floor(page_id / 28) AS BIGINT) % 3"
    f" WHEN 0 THEN concat('<pre><a href=\"', {LISTING_NAME_SQL}, '\">', {LISTING_NAME_SQL}, '</a>', {_SIZE}, '</pre>')"
    f" WHEN 1 THEN concat('<table><tr><td><a class=x href=', chr(39), {LISTING_NAME_SQL}, chr(39), '>', {LISTING_NAME_SQL},"
    f" '</a></td><td align=\"right\">', {_SIZE}, '</td></tr></table>')"
    f" ELSE concat('<li><A title=\"a > b\" HREF=', {LISTING_NAME_SQL}, '><b>', {LISTING_NAME_SQL}, '</b></A>', {_SIZE}, '</li>') END"
)


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` with an archive-index fragment appended to the whole html."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.concat(F.col("html"), F.expr(LISTING_FRAGMENT_SQL)).alias("html"))


def listing_pages_sql() -> str:
    """The same as a SQL CTE named ``listing``."""
    return f"listing AS (SELECT page_id, url, concat(html, {LISTING_FRAGMENT_SQL}) AS html FROM pages)"
