"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs are written for; pass them to any builder or spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pledgeflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary folder, because
    driver and executors are one process there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    known = context.getCheckpointDir()
    if known is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pledgeflow-"))
        known = context.getCheckpointDir()
    return known.rstrip("/")


def working_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of a job that must write intermediate tables."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for what runs in this block."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffles_freed(spark: SparkSession):
    """What is written in this block frees its shuffle files as it ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of all steps of a job lie side by side.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def put_by(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` stored in ``folder``, in the place of what was there; the shuffles that made them are freed."""
    with shuffles_freed(rows.sparkSession):
        rows.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
