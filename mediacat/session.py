"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that results depend on: UTC times and ANSI errors instead of silent nulls.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings for speed: runtime re-planning with splitting of skewed join partitions, stream state outside the heap.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "mediacat", master: str | None = None, **extra: object) -> SparkSession:
    """Session with the settings above; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_CONF, **SPEED_CONF}.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def apply_result_settings(spark: SparkSession) -> SparkSession:
    """Set what results depend on in a session somebody else built."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    return spark


def shuffle_conf(input_bytes: int, partition_bytes: int = 128 << 20, ceiling: int = 200_000) -> dict[str, str]:
    """Starting shuffle width for an input size; AQE merges what turns out too small."""
    width = max(1, min(ceiling, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local master may go without it: there one machine runs everything, so a temporary folder will do,
    which goes when the program ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context.getCheckpointDir()
    if not named and not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="mediacat-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if named and not current:
        context.setCheckpointDir(named)
    return (named or current).rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A new folder for one run below the shared folder; never reused, so reruns cannot clash."""
    return f"{shared_dir(spark)}/mediacat/{label}-{uuid.uuid4().hex}"
