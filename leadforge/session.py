"""Session helpers for tests, the bench and local runs.

Library code never creates a session; it uses the one it is given.  Settings
chosen here only apply when this module builds the session.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, app: str = "leadforge") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEADFORGE_DRIVER_MEMORY", "16g"))
        # Pages are large rows: keep Arrow batches to the parse small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
        # HTML stages are CPU-bound per byte: aim for small shuffle partitions
        # so a few MB of pages still spread over every core.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.  Only a local session without
    one (tests) gets a scratch folder of its own; on a cluster that would be a
    different folder on every machine, so there it is an error."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="leadforge-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Materialise ``df`` in the checkpoint folder (reliable checkpoint: it
    survives the loss of the executors that computed it)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
