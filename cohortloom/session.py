"""Session helpers: building a session, loading tables, the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "cohortloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect: UTC, adaptive execution, Arrow transfer."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # files of tables that nobody holds any more
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at the shared folder in ``spark.checkpoint.dir``.

    Only a session that names no folder and runs in one process (``local[...]``) gets a temporary one;
    a cluster without the setting is an error, since its executors share no local folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cohortloom-checkpoint-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the reliable checkpoint folder and read back from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fan_out(df: DataFrame) -> DataFrame:
    """``df`` over all slots if its partitions would leave half of them idle, else as it is.

    For work that is heavy per row. Only inputs smaller than a split for each slot are moved; a large
    table already has more partitions than that and is not shuffled.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() * 2 <= slots else df
