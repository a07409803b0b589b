"""Where iterative operators end their lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only where it is unset, a new one: in the
    warehouse on a cluster, a temporary one where everything runs in this process."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        alone = context.master.split("[")[0] == "local"
        found = "file://" + tempfile.mkdtemp(prefix="voxstrata-") if alone else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(found)
    return found.rstrip("/") if "://" in found or found.startswith("file:") else "file://" + found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder, so lost executors recompute nothing above it."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
