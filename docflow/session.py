"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only semantics and adaptive behaviour are set here; sizes (shuffle partitions,
# memory, broadcast threshold) belong to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Work files and tables hold ids and hashes as text, which only an entropy coder makes smaller.
    # Sizes of rows are guessed from files, so what is broadcast is held down to match.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.fileCompressionFactor": "2.0",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The JVM never compiles a method above 8000 bytes; a wide stage then runs
    # faster operator by operator than as one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run, on the storage every executor shares.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a local
    session (as in tests) uses a temporary folder; on a cluster executors would each
    write to their own disk, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="docflow-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
