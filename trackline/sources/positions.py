"""Position-file readers: headed / header-less / "standard" CSV, detection, union.

Every reader returns raw string columns under canonical names plus
provenance (``source_file``, ``source_offset``, ``ingest_seq``) so cleaning
can keep the first report in file order.  All go through the ``positions``
data source (``sources.datasource``): one scan, each file under its own header.
Typing happens once in ``operators.clean.coerce_types``.

Where Python cannot reach the file system of the paths (one that only Spark's
readers open), lines come from Spark's text source and are parsed by the same
code in ``mapInArrow``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackline.functions.parse import na_to_null
from trackline.schema import CANONICAL_COLUMNS, SOURCE_COLUMNS
from trackline.sources.datasource import (FIRST_LINE_CHUNK, PROVENANCE, ROW_DDL, first_line, header_mapping, header_names, is_header,
                                          parse_lines, read_files, readable)

ORDER = "ingest_order"


def ingest_order(df: DataFrame) -> DataFrame:
    """Add ``ingest_order`` = struct(file, offset, seq): sorts rows in file order."""
    return df.withColumn(ORDER, F.struct(*[F.col(c) for c in PROVENANCE]))


def _rows(spark: SparkSession, paths: str | list[str], header: str, archives: str, spread: int | None = None) -> DataFrame:
    listed = [paths] if isinstance(paths, str) else list(paths)
    df = read_files(spark, listed, header, archives) if all(map(readable, listed)) else _read_by_text_scan(spark, listed, header)
    if spread:
        df = df.repartition(int(spread))
    return df.select(*[na_to_null(F.col(c)).alias(c) for c in CANONICAL_COLUMNS], *PROVENANCE)


def read_positions(spark: SparkSession, paths: str | list[str], header: bool = True,
                   spread: int | None = None) -> DataFrame:
    """Read position CSV files (headed or not) as canonical string columns.

    Columns of a headed file go by the names in its header, in any order;
    columns with other names are left out, absent ones are NULL.  Rows with
    more fields than the header (without one: than the 17 columns) are
    skipped; short rows are kept with NULLs; an empty file yields no rows.
    Plain files are split into many tasks; a compressed (``.gz``) file is
    not, so ``spread=n`` redistributes its rows over ``n`` partitions after
    reading.
    """
    return _rows(spark, paths, "true" if header else "false", "skip", spread)


def read_positions_headerless(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Header-less files under the fixed 17-column list."""
    return read_positions(spark, paths, header=False)


def read_positions_standard(spark: SparkSession, paths: str | list[str], fill_missing: bool = True) -> DataFrame:
    """Files with their own header (``mmsi`` plus a time column), names mapped to canonical.

    Columns with unknown headers are dropped; canonical columns absent from
    all files come back as NULL strings (or are left out with
    ``fill_missing=False``, for a later union by name).
    """
    df = read_positions(spark, paths)
    if fill_missing:
        return df
    # the names in any header: a set with 17 members at most
    heads = _first_line_of_each(spark, paths).mapInPandas(_named, "name string").distinct()
    named = {r["name"] for r in heads.collect()}
    return df.select(*[c for c in CANONICAL_COLUMNS if c in named], *PROVENANCE)


def _named(batches):
    import pandas as pd
    for pdf in batches:
        found = {c for line in pdf["first_line"] for c in header_mapping(header_names(line)).values()}
        yield pd.DataFrame({"name": sorted(found)}, dtype="object")


def _read_by_text_scan(spark: SparkSession, paths: list[str], header: str) -> DataFrame:
    """The same rows from Spark's text source; archives are left out, since only Python opens them."""
    plain = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_offset"),
        F.monotonically_increasing_id().alias("ingest_seq"), "value").where(~F.lower("source_file").endswith(".zip"))
    first = _first_lines_by_text_scan(spark, paths).withColumnRenamed("file_path", "source_file")
    lines = plain.join(first, "source_file")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("source_file", "source_offset", "first_line", "ingest_seq", "value"))))
            for (file, offset, top), run in groupby(rows, lambda r: r[:3]):
                headed = is_header(top, header)
                run = [r[3:] for r in run if not (headed and r[4] == top)]  # a line that repeats the header is none either
                yield from parse_lines([v.lstrip("\ufeff").encode() for _, v in run], [n for n, _ in run],
                                       header_names(top) if headed else SOURCE_COLUMNS, file, offset)

    return lines.select(*PROVENANCE, "value", "first_line").mapInArrow(parse, ROW_DDL)


def _first_lines(batches):
    import pandas as pd
    for pdf in batches:
        lines = [first_line(p) for p in pdf["path"]]
        yield pd.DataFrame({"file_path": pdf["path"], "first_line": lines})


def _classify(first: DataFrame) -> DataFrame:
    low = F.lower(F.col("first_line"))
    has = lambda s: low.contains(s)
    fmt = (F.when(has("mmsi") & has("basedatetime"), "noaa")
           .when(has("mmsi") & (has("timestamp") | has("time")), "standard")
           .otherwise("noaa_no_header"))
    return first.select("file_path", fmt.alias("format"), "first_line")


def _first_lines_by_text_scan(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """First lines through Spark's text source: works on any file system, but reads every split."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    ).where(F.col("_start") == 0)
    return lines.groupBy("file_path").agg(F.min_by("value", "_id").alias("first_line"))


def _first_line_of_each(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file_path and first_line of every file that has one; ZIP archives are left out."""
    files = (spark.read.format("binaryFile").load(paths).select("path", "length")
             .where((F.col("length") > 0) & ~F.lower("path").endswith(".zip")))
    if not all(map(readable, [paths] if isinstance(paths, str) else paths)):
        return _first_lines_by_text_scan(spark, paths)
    return files.select("path").mapInPandas(_first_lines, "file_path string, first_line string").where(
        F.col("first_line").isNotNull())


def detect_format(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Classify each file by its first line: ``noaa``, ``standard`` or ``noaa_no_header``.

    Files are listed with the binary-file source (content pruned, so nothing
    is read by the listing); each task then reads only the head of its files
    up to the first line break -- never the rest of the data.  No shuffle, no
    per-file driver loop.  If Python cannot reach the file system of the
    paths, Spark's text source is used instead, which reads every split.
    """
    return _classify(_first_line_of_each(spark, paths))


def read_any(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of files of any format, each read by its own first line, and of the CSV members of ZIP archives.

    One scan reads all of them; nothing about single files comes to the driver but the listing that every
    file source makes.
    """
    return _rows(spark, paths, "auto", "also")


def combine_files(frames: list[DataFrame]) -> DataFrame:
    """Row union by column name; a column missing from a frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_inventory(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """Pre-flight listing: path, size, modification time of non-empty files.

    Uses the binary-file source's metadata columns only (``content`` is
    pruned, so no file is read).
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(paths).select("path", "length", "modificationTime")
    return df.where(F.col("length") > 0)
