"""Session builder and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "marketloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators are written for.

    The time zone is UTC because facts carry timestamps without zone. Adaptive
    execution coalesces small shuffle partitions and splits skewed join sides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # files of a checkpoint go when nothing refers to it any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    return b.config(map=settings).getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder; a cluster must
    name a folder that all executors see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = os.path.join(tempfile.gettempdir(), f"marketloom-{uuid.uuid4().hex}")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder; survives the loss of any executor."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """cut_lineage() for what took large shuffles: their files go with the driver's garbage, so it is collected at once."""
    spark, out = df.sparkSession, cut_lineage(df)
    del df
    spark.sparkContext._jvm.System.gc()
    return out
