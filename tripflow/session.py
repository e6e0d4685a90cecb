"""Session settings this library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME_SETTINGS = {
    # Trip times are naive wall-clock values: a UTC session never shifts them.
    "spark.sql.session.timeZone": "UTC",
    # Rewrite only the days a run produced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Microsecond timestamps carry min/max statistics; the INT96 default does not.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "snappy",
    # Runtime re-planning: partition counts, join sides by measured size, splitting of hot partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The validation stages are wide. The JVM compiles no method above 8,000 bytes, so a larger fused
    # method would run interpreted; below this limit Spark splits it instead (ten times faster here).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Window state lives off-heap and on disk, so it is not bounded by the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def adopt(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return adopt(builder.getOrCreate())


def ship_package(spark: SparkSession) -> None:
    """Python workers import this package: they get the path the driver has it from."""
    environment, home = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` as the cluster names it.

    Only where that is unset (tests, a laptop) a temporary folder is made, and only on a local master:
    a machine-local folder is not visible to other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tripflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, never reused."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def settled(frame: DataFrame, name: str) -> DataFrame:
    """The frame's rows from a table in the shared folder: whatever reads them twice computes them once."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
