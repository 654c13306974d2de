"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(cores: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "ledgerlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.

    On a cluster the session comes from the launcher; this helper only fills in
    what a local run needs (UI off, AQE on, UTC, Arrow).
    """
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings meant for a large cluster (applied by the launcher, not by this
# library): AQE sizes shuffle partitions from run-time statistics, splits
# skewed join partitions, and converts joins to broadcasts only after
# measuring the small side.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    Uses ``spark.checkpoint.dir`` when the cluster sets it. Only a local-mode
    session without the setting (tests, the bench) gets a scratch folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("LEDGERLENS_SCRATCH"))
    atexit.register(shutil.rmtree, d, ignore_errors=True)      # our own folder, and a local session's only
    sc.setCheckpointDir(d)
    try:   # informational only; some versions reject setting core confs at run time
        spark.conf.set("spark.checkpoint.dir", d)
    except Exception:  # noqa: BLE001
        pass
    return d


def written(df, name: str):
    """``df`` as Parquet files in the shared folder, read back; columns of few values take little room."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
