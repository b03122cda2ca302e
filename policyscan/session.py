"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on: adaptive plans split skewed join partitions and
# size shuffles from what was really written; times are UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

STAGING_SETTING = "spark.checkpoint.dir"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the library's settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def staging_dir(spark: SparkSession) -> str:
    """Folder for staged tables: the one the cluster names in its settings.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would not be seen by the other executors.
    """
    folder = spark.conf.get(STAGING_SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {STAGING_SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="policyscan-")
        spark.conf.set(STAGING_SETTING, folder)
    return folder.rstrip("/")


def stage(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the staging folder and read it back.

    Used where several aggregates need the same extracted rows: the texts are
    then read and matched once, and a lost executor costs a re-read of a file
    rather than of the corpus.
    """
    spark = df.sparkSession
    target = f"{staging_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)
