"""Appends, defaults, bulk updates, bulk deletes and id assignment.

Tables are Parquet versions: a change returns the new version as a DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.session import shared_folder

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def append_positional(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows by column position; names of ``rows`` do not matter."""
    return table.union(rows)


def append_named(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows by column name; columns they lack become NULL."""
    return table.unionByName(rows, allowMissingColumns=True)


def fill_default(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Add ``column`` with a default when the rows come without it.

    A NULL that was given stays NULL: that is a constraint matter, not a default.
    """
    return df if column in df.columns else df.withColumn(column, value)


def apply_request_updates(backs: DataFrame, changes: DataFrame) -> DataFrame:
    """Pledges with their refund request set from ``(email, id, new_request)``.

    A change without a pledge changes nothing, and NULL is a value like any
    other. A pledge with several changes keeps its request, as none is the last.
    """
    keys = ["email", "id"]
    single = (
        changes.groupBy(*keys)
        .agg(F.first("new_request").alias("new_request"), F.count(F.lit(1)).alias("__changes"))
        .filter("__changes = 1")
    )
    request = F.when(F.col("__changes").isNotNull(), F.col("new_request")).otherwise(F.col("request"))
    return backs.join(single, keys, "left").withColumn("request", request).select(*backs.columns)


def delete_users(tables: Mapping[str, DataFrame], emails: DataFrame) -> dict[str, DataFrame]:
    """Backers, creators and users without the listed emails."""
    gone = emails.select("email").distinct()
    return {
        name: tables[name].join(gone, "email", "left_anti")
        for name in ("backers", "creators", "users")
    }


def _placed(df: DataFrame, order: Sequence[str | Column] | None) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Rows with their place, from a checkpoint, and the number of rows of each partition."""
    shared_folder(df.sparkSession)
    if order is not None:
        # other columns decide between rows that are equal in the order, so that a second run numbers them alike
        full = [*order, *df.columns]
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(parts, *full).sortWithinPartitions(*full)
    placed = df.checkpoint().withColumn("__place", F.monotonically_increasing_id())
    counts = placed.groupBy(F.shiftright("__place", _ROW_BITS).alias("part")).count().collect()
    return placed, sorted((c["part"], c["count"]) for c in counts)


def _numbered(placed: DataFrame, counts: list[tuple[int, int]], column: str, start: int) -> DataFrame:
    firsts = accumulate((n for _, n in counts), initial=start)
    offsets = placed.sparkSession.createDataFrame(
        [(part, first) for (part, _), first in zip(counts, firsts)], "__part bigint, __first bigint"
    )
    row = F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One offset row per partition, so its size follows the partition count only.
    return (
        placed.withColumn("__part", F.shiftright("__place", _ROW_BITS))
        .join(F.broadcast(offsets), "__part")
        .withColumn(column, F.col("__first") + row)
        .select(column, *[c for c in placed.columns if c not in (column, "__place")])
    )


def assign_ids(
    df: DataFrame, column: str = "id", start: int = 1, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Give every row a number from ``start`` up, without gaps, in the stated order; without one, in none that is promised.

    The input is written to the checkpoint folder first: rows then keep their
    place even if an executor is lost between counting and numbering. An order is that of ranges of rows,
    each sorted by a task of its own. The driver sees one count per partition.
    """
    return _numbered(*_placed(df, order), column, start)


_MARKS = "tag STRING, first BIGINT, next BIGINT"


def assign_next_ids(
    df: DataFrame, marks: str, tag: str, column: str = "id", order: Sequence[str | Column] | None = None, start: int = 1
) -> DataFrame:
    """``assign_ids`` that goes on behind the ids given out before, as a serial column does.

    ``marks`` is the folder that remembers what has been given out, one small file per batch. A batch that is sent again under its
    ``tag`` gets its ids once more; they are the same ids for the same rows, if an order is stated. One writer at a time.
    """
    spark = df.sparkSession
    try:
        known = spark.read.schema(_MARKS).parquet(marks)
        again = known.filter(F.col("tag") == tag).select("first").first()
        first = again[0] if again else known.agg(F.coalesce(F.max("next"), F.lit(start))).first()[0]
    except AnalysisException:  # nothing has been given out yet
        again, first = None, start
    placed, counts = _placed(df, order)
    if again is None:
        mark = (tag, first, first + sum(n for _, n in counts))
        spark.createDataFrame([mark], _MARKS).coalesce(1).write.mode("append").parquet(marks)
    return _numbered(placed, counts, column, first)
