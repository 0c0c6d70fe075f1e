"""Session settings and the shared folder for stage tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# The JVM never compiles methods of more than 8000 bytes of bytecode and runs
# them in its interpreter. Wide feature rows easily make Spark generate one; at
# this limit Spark falls back to smaller methods, which is several times faster.
METHOD_LIMIT_KEY = "spark.sql.codegen.hugeMethodLimit"
METHOD_LIMIT = "8000"


def build_session(app: str = "aerolag", cores: int | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    n = cores or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("AEROLAG_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Set what jobs over wide rows need, unless the session already did."""
    if spark.conf.get(METHOD_LIMIT_KEY, "65535") == "65535":
        spark.conf.set(METHOD_LIMIT_KEY, METHOD_LIMIT)
    return spark


def stage_root(spark: SparkSession) -> str:
    """Folder for stage tables and checkpoints, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    where driver and executors are one process, falls back to a temporary one.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured
    sc = spark.sparkContext
    already = sc.getCheckpointDir()
    if already:
        return already
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="aerolag-stage-"))
    return sc.getCheckpointDir()
