"""Parquet tables by name, and delimited text."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pledgeflow.functions.expressions import first_reason, reason_if
from pledgeflow.schema import TABLES


def read_tables(spark: SparkSession, root: str, names: Iterable[str] = tuple(TABLES)) -> dict[str, DataFrame]:
    """The model's tables stored as Parquet folders ``root/<table>``.

    The declared schema is given to the reader, so no file is opened to infer it.
    """
    return {
        name: spark.read.schema(TABLES[name].raw_schema).parquet(f"{root}/{name}") for name in names
    }


def write_table(df: DataFrame, root: str, name: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    """Write one table version; columns are put in the declared order and type."""
    spec = TABLES[name]
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])
    typed.write.mode(mode).partitionBy(*partition_by).parquet(f"{root}/{name}")


#: Partition column of a stored layout: the first day of the month of a date.
MONTH = "month"


def save_layout(
    df: DataFrame, name: str, path: str, by: tuple[str, ...] = ("id",), buckets: int = 64, day: str | None = None,
    mode: str = "errorifexists",
) -> DataFrame:
    """A table laid out for joins and sums on ``by`` without a shuffle, and for scans of a span of ``day`` without the rest.

    Rows are bucketed and sorted by ``by``, and partitioned by the month of ``day`` if one is named. The buckets are known by the catalog's
    table ``name``, its files lie under ``path``. Rows are first brought together by bucket, so a month has one file per bucket.
    A bucket is read by one task: take as many as a viral key leaves small.
    """
    spark = df.sparkSession
    if day:
        df = df.withColumn(MONTH, F.trunc(day, "month"))
    placed = df.repartition(buckets, *by)
    writer = placed.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, *by).sortBy(*by)
    (writer.partitionBy(MONTH) if day else writer).saveAsTable(name)
    return spark.table(name)


def in_window(laid_out: DataFrame, day: str, first: date | str, last: date | str) -> DataFrame:
    """Rows of ``day`` from ``first`` to ``last``; only the months of the window are scanned."""
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    months = (F.col(MONTH) >= F.trunc(start, "month")) & (F.col(MONTH) <= end)
    return laid_out.filter(months & F.col(day).between(start, end)).drop(MONTH)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line_number, value)``: the lines of text files, numbered from 1 within each.

    A large file is read by many tasks. A line's place is its file, its split and its row in the split; how many lines the splits
    before hold comes from one count per split. Both passes read the same splits in the same way, as these follow from
    the files and the session's settings alone.
    """
    place = ["file", "split"]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("__row"),
        "value",
    )
    splits = lines.groupBy(*place).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__lines"))
    upto = F.sum("__lines").over(Window.partitionBy("file").orderBy("split"))
    begins = splits.select(*place, "__first", (upto - F.col("__lines")).alias("__before"))
    # One row per split of 128 MB or so: broadcast, and the lines stay where they were read.
    return lines.join(F.broadcast(begins), place).select(
        "file", (F.col("__before") + F.col("__row") - F.col("__first") + 1).alias("line_number"), "value"
    )


def load_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", end_marker: str = "\\."
) -> DataFrame:
    """Delimited text files with the columns of ``schema`` plus ``line``, ``reason`` (see ``parse_delimited``), ``file`` and ``line_number``.

    The data of a file end at the first line that is the end marker; what stands behind it is not loaded.
    """
    lines = read_lines(spark, path)
    ends = lines.filter(F.trim("value") == end_marker).groupBy("file").agg(F.min("line_number").alias("__end"))
    data = lines.join(F.broadcast(ends), "file", "left").filter(F.coalesce(F.col("line_number") < F.col("__end"), F.lit(True)))
    return parse_delimited(data.drop("__end"), schema, sep, end_marker)


def parse_delimited(
    rows: DataFrame, schema: T.StructType, sep: str = ",", end_marker: str = "\\.", null: str = "\\N"
) -> DataFrame:
    """Lines in a column ``value`` with the columns of ``schema`` plus ``reason``.

    Other columns of ``rows`` are kept. The line that only marks the end of the data is dropped; it has to be the last, as lines have no order here.
    ``null`` stands for NULL. A line that does not parse, or leaves a required
    column empty, keeps its text in ``line`` and gets a reason.
    """
    wanted = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        + [T.StructField("__bad", T.StringType(), True)]
    )
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad", "nullValue": null}
    lines = rows.filter(F.trim("value") != end_marker)
    others = [c for c in rows.columns if c != "value"]
    parsed = lines.select(
        *others,
        F.col("value").alias("line"),
        F.from_csv("value", wanted.simpleString()[len("struct<"):-1].replace(":", " "), options).alias("r"),
    )
    missing = [
        reason_if(F.col(f"r.{f.name}").isNull(), f"null value in column {f.name}")
        for f in schema.fields
        if not f.nullable
    ]
    malformed = reason_if(F.col("r.__bad").isNotNull(), "malformed line")
    return parsed.select(
        *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields],
        "line",
        first_reason(malformed, *missing).alias("reason"),
        *others,
    )
