"""Session settings and the shared folder for intermediate tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs the aggregate above another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings that only a new session can take. Call sites of column expressions are recorded with
# a stack walk each, which makes large expressions slow to build on the driver.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build(app: str = "ferrocar", settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings this package relies on."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    That is the checkpoint folder, else a subfolder of the warehouse; a machine-local folder
    would lose the data with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints").rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage, computes ``df`` once however often it is used, survives the loss
    of executors, and gives the optimizer true file sizes. A join against a staged table is
    broadcast only when it is smaller than ``spark.sql.autoBroadcastJoinThreshold``, and is
    a sort-merge join with skew splitting otherwise.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
