"""Which folders of a date-partitioned table are live.

Rows lie under ``traffic_date=<date>/batch=<name>``.  The manifest is a small JSON file
with the batch folders of every date, written anew by each commit under the next
number (a rename that fails where another writer was first); the last few are kept.
Readers open the folders it names and list nothing else, so neither listing nor
planning grows with the number of batches ever written: a date's folders are merged
into one when they pass ``MAX_FOLDERS``, and the old ones are removed once a later
manifest has been committed without them.

Files are written, listed and renamed through Hadoop's file system interface, so the
table may lie anywhere Spark can write.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_FOLDERS = 8  # of one date, before they are merged
KEPT = 5  # manifests


class Manifest:
    """``folders``: date -> names of its live batch folders; ``retired``: folders to remove after the next commit."""

    def __init__(self, spark: SparkSession, positions_dir: str) -> None:
        self.spark, self.root = spark, positions_dir
        self.dir = os.path.join(positions_dir, "_manifest")  # hidden from readers of the table
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.dir).getFileSystem(spark._jsc.hadoopConfiguration())
        self.version, self.folders, self.retired = self._read()

    def _versions(self) -> list[int]:
        at = self._path(self.dir)
        if not self._fs.exists(at):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(at)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "_")

    def _read(self) -> tuple[int, dict[str, list[str]], list[str]]:
        found = self._versions()
        if not found:
            return 0, {}, []
        stream = self._fs.open(self._path(f"{self.dir}/{found[-1]:012d}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        state = json.loads(text)
        return found[-1], state["folders"], state["retired"]

    def _write(self, folders: dict[str, list[str]], retired: list[str]) -> None:
        made = self._path(f"{self.dir}/_{uuid.uuid4().hex}")
        out = self._fs.create(made)
        out.write(bytearray(json.dumps({"folders": folders, "retired": retired}).encode()))
        out.close()
        if not self._fs.rename(made, self._path(f"{self.dir}/{self.version + 1:012d}.json")):
            self._fs.delete(made, False)
            raise RuntimeError(f"another writer has committed to {self.root} meanwhile")
        for folder in self.retired:  # of the commit before: its readers have had a batch's time
            self._fs.delete(self._path(os.path.join(self.root, folder)), True)
        self.version, self.folders, self.retired = self.version + 1, folders, retired
        for v in self._versions()[:-KEPT]:
            self._fs.delete(self._path(f"{self.dir}/{v:012d}.json"), False)

    def add(self, batch: str, dates: list[str]) -> None:
        """Commit the batch's folders; a replayed batch takes the place of its first try."""
        folders = {d: [b for b in names if b != batch] for d, names in self.folders.items()}
        for d in dates:
            folders[d] = [*folders.get(d, []), batch]
        self._write({d: names for d, names in folders.items() if names}, [])

    def holds(self, date: str, batch: str) -> bool:
        """Whether the batch has written a folder of this date (none if all its reports were stored already)."""
        return self._fs.exists(self._path(os.path.join(self.root, f"traffic_date={date}", f"batch={batch}")))

    def paths(self, dates: list[str] | None = None, but: str | None = None) -> list[str]:
        """Live folders of the given dates (of all without), in order; those of batch ``but`` left out."""
        chosen = self.folders if dates is None else {d: self.folders.get(d, []) for d in dates}
        return [os.path.join(self.root, f"traffic_date={d}", f"batch={b}") for d, names in sorted(chosen.items()) for b in names if b != but]

    def read(self, dates: list[str] | None = None, but: str | None = None) -> DataFrame | None:
        """Rows of the live folders; None if there are none."""
        paths = self.paths(dates, but)
        return self.spark.read.option("basePath", self.root).parquet(*paths) if paths else None

    def compact(self, max_folders: int = MAX_FOLDERS) -> list[str]:
        """Merge the folders of each date that has more than ``max_folders``; return those dates."""
        full = [d for d, names in self.folders.items() if len(names) > max_folders]
        if not full:
            return []
        name = f"merged-{uuid.uuid4().hex[:12]}"
        rows = self.read(full).drop("batch").withColumn("batch", F.lit(name))
        write_dated(rows, self.root)
        old = [f"traffic_date={d}/batch={b}" for d in full for b in self.folders[d]]
        self._write({**self.folders, **{d: [name] for d in full}}, old)
        return full


def write_dated(rows: DataFrame, root: str) -> None:
    """Write rows by ``traffic_date`` and ``batch``; folders of these dates and this batch are replaced."""
    (rows.hint("rebalance", "traffic_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("traffic_date", "batch").parquet(root))
