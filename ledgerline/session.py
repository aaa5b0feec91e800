"""Session set-up and the two session-dependent settings: the shared folder and the broadcast budget."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

BROADCAST_BUDGET_CONF = "spark.ledgerline.broadcastBytes"
BROADCAST_BUDGET_DEFAULT = 64 * 1024 * 1024


def build_session(app: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans assume; on a cluster the submit command supplies master and sizes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go when no frame needs them any more
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a cluster a machine-local folder would
    lose data with its machine, so there the setting is required.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerline-", dir="/tmp")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """Write an intermediate frame to the shared folder once, so that reuse neither recomputes nor depends on executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_budget(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BUDGET_CONF, str(BROADCAST_BUDGET_DEFAULT)))
