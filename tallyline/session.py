"""A ready-made local session. On a cluster the submitter's session is used, with one setting."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


# HotSpot never compiles a method of more than 8,000 bytes of bytecode, and the fused code of a
# wide projection is longer. Beyond the limit Spark then uses separate, compiled projections.
HUGE_METHOD_LIMIT = 8000


def compile_wide_projections(spark: SparkSession) -> None:
    """Have the submitter's session keep to the limit, unless it was given one of its own. Text to
    staging rows took 2.4 times the CPU seconds without it."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.sparkContext.getConf().get(key) is None:
        spark.conf.set(key, str(HUGE_METHOD_LIMIT))


def local_session(cpus: int | str = 8, app: str = "tallyline", memory: str = "12g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.codegen.hugeMethodLimit", str(HUGE_METHOD_LIMIT))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyline-"))
        .getOrCreate()
    )
