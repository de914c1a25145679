"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "trackline") -> SparkSession:
    """Session for tests and the benchmark (local mode, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # generated code for the unrolled geodesic can pass HotSpot's 8000-byte
        # JIT limit; let the JIT compile such methods (set the same on executors)
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be a shared file
    system.  Only when it is unset on a local master (tests) is a folder of
    the session's warehouse taken; an unset folder on a cluster is an error,
    since a machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- remote sessions have no SparkContext
        sc = None
    found = sc.getCheckpointDir() if sc is not None else None
    if not found:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and sc is not None:
            found = sc.getConf().get("spark.checkpoint.dir", None)
        if not found:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
            if not str(master).startswith("local"):
                raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder on a shared file "
                                   "system (written hand-offs and checkpoints go there)")
            found = os.path.join(spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse"), f"checkpoints-{uuid.uuid4().hex[:12]}")
        if sc is not None:
            sc.setCheckpointDir(found)
            found = sc.getCheckpointDir() or found
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for written hand-offs."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "trackline", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Write ``df`` to the shared checkpoint folder and return a frame reading it back.

    For small derived tables (per-vessel metrics) that feed several
    consumers: one computation instead of one per consumer, and a lineage cut
    that survives the loss of an executor (a reliable checkpoint, not a
    local one).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings for a large run: shuffle partitions sized so each holds ~``target_partition_bytes``.

    AQE coalesces small partitions at run time, so erring high is cheap;
    too few partitions spill instead.
    """
    parts = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 512 * 1024 ** 2)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.executor.extraJavaOptions": JIT_OPTIONS,
    }
