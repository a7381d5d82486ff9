"""Session settings and the shared folder for landed intermediates."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Everything else (broadcast threshold, executor sizing) stays with the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A customer or state holding a third of all rows is split over several tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def shuffle_settings(shuffle_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings under which the largest shuffle of a load splits into tasks that fit in memory.

    Adaptive execution merges partitions that turn out small but cannot add any, so the number
    it starts from has to suit the largest shuffle. Joining on order keys, for instance, moves
    the two key columns and the measures of all line items.
    """
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def build_session(
    app_name: str = "hazardmart", master: str | None = None, **settings: str
) -> SparkSession:
    """Session with the settings above; ``settings`` (``a__b`` for ``a.b``) override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session, whose executors share one machine by definition, may fall back
    to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="hazardmart-"))
    return context.getCheckpointDir()
