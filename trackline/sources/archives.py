"""ZIP archives of position CSV files.

Reading goes through the ``positions`` data source: an archive's members are found
in its central directory when the read is planned, each member is a partition of its
own, and its bytes are inflated as they stream, so neither an archive nor a member
has to fit anywhere.  Writing streams one partition's lines into one archive.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.schema import SOURCE_COLUMNS
from trackline.sources.datasource import file_system
from trackline.sources.positions import _rows


def read_zip_positions(spark: SparkSession, paths: str | list[str], spread: int | None = None) -> DataFrame:
    """Every ``*.csv`` member of the ``.zip`` archives among the given files or folders, as position rows.

    A member's first line is its header when it names ``mmsi``; without one it has the 17 columns.  An
    archive that cannot be opened contributes no rows, a damaged member those before the damage.  Members
    are read in parallel; a deflated member cannot be split, so ``spread=n`` redistributes rows over ``n``
    partitions where one member holds a large share of the data.
    """
    return _rows(spark, paths, "auto", "only", spread)


def write_archives(lines: DataFrame, folder: str, archives: int | None = None) -> int:
    """Write CSV lines (column ``line``, 17 fields) to ``folder`` as one archive per partition; return their number.

    ``archives`` repartitions first.  An archive is written under a name of its attempt and moved when it is
    whole, so a task that is tried again replaces its own archive.
    """
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        fs, inner = file_system(folder)
        name = f"positions_{task.partitionId():05d}"
        attempt = f"{inner}/_{name}.{task.taskAttemptId()}"
        archive = member = None
        for batch in batches:
            if archive is None and len(batch):
                fs.create_dir(inner)
                out = fs.open_output_stream(attempt)
                archive = zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED)
                member = archive.open(f"{name}.csv", "w", force_zip64=True)
                member.write((",".join(SOURCE_COLUMNS) + "\n").encode())
            if len(batch):
                member.write(("\n".join(batch["line"]) + "\n").encode())
        if archive is not None:
            member.close(), archive.close(), out.close()
            fs.move(attempt, f"{inner}/{name}.zip")
            yield pd.DataFrame({"name": [name]})

    parts = lines.select("line").repartition(archives) if archives else lines.select("line")
    return parts.mapInPandas(pack, "name string").agg(F.count("name")).first()[0]
