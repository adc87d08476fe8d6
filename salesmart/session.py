"""Session construction and shared working locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session time, adaptive execution
# (coalesces small shuffles, splits skewed join partitions, turns joins into
# broadcasts when a side proves small at runtime) and dynamic partition
# overwrite for the range-replace sink.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "salesmart") -> SparkSession:
    """Return a session with the engine defaults applied.

    On a cluster the master and resources come from spark-submit; only the
    SQL settings above are forced.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for key, value in _DEFAULTS.items():
        spark.conf.set(key, value)
    # Python workers import this package from where the driver does; a cluster
    # without a shared installation ships it with --py-files instead
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_base(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be read by nobody else, so a missing
    setting is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="salesmart-")
    base = base.removeprefix("file:") if base.startswith("file:/") and not base.startswith("file://") else base
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh directory under the shared folder, for staged writes and lineage cuts."""
    return f"{shared_base(spark)}/salesmart/{name or 'work'}-{uuid.uuid4().hex[:12]}"
