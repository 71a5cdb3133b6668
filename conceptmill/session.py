"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "conceptmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are designed for.

    AQE joins small sides by broadcast from their measured size, splits skewed
    join partitions and coalesces small shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Prompts and texts are long; a batch of the default 10,000 rows would not fit.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for checkpoints and intermediate tables.

    It is the session's ``spark.checkpoint.dir``. Only a local session without
    that setting gets a fresh folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    path = tempfile.mkdtemp(prefix="conceptmill-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/conceptmill/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` work when the session names no folder itself."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
