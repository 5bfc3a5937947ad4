"""Funding per project and day that is kept up to date by changes, not added up anew.

The state has one row per project and day: the sum and the number of its pledges. A batch of added and removed pledges becomes
signed sums per project and day, and these are added to the rows of the buckets they fall in; no stored pledge is read. Sums are
decimals, so what is taken away again leaves no trace, and a day without pledges goes. A changed pledge is removed as it was
and added as it is now.

The state has the columns ``id``, ``backing`` and ``amount`` and stands in for the pledges in ``successful_projects``,
``daily_funding``, ``funding_curve``, ``days_to_funding`` and the top lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.session import working_folder
from pledgeflow.sources.versions import Change, Store

NAME, BUCKETS, BUCKET_ROWS = "daily", 64, 250_000
_KEY = ["id", "backing"]


def _signed(pledges: DataFrame, sign: int) -> DataFrame:
    return pledges.groupBy(*_KEY).agg((F.lit(sign) * F.sum("amount")).alias("amount"), (F.lit(sign) * F.count(F.lit(1))).alias("pledges"))


def _held(df: DataFrame, name: str) -> DataFrame:
    folder = working_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def create(store: Store, backs: DataFrame, name: str = NAME, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> None:
    """The state of all pledges there are; no project has more rows in its bucket than days.

    There are ``buckets`` of them, or as many more as keep them at ``bucket_rows`` rows on average: a task writes whole buckets.
    The state is stored to be counted.
    """
    state = _held(_signed(backs, 1).withColumn("amount", F.col("amount").cast("decimal(38,4)")), "funding-state")
    store.create({name: state}, {name: (["id"], max(buckets, -(-state.count() // bucket_rows)))})


def update(
    store: Store, added: DataFrame | None = None, removed: DataFrame | None = None, tag: str | None = None, name: str = NAME
) -> dict[str, list[str]]:
    """The state after pledges have come and gone. A batch that is sent again under its ``tag`` counts once."""
    parts = [_signed(df, sign) for df, sign in ((added, 1), (removed, -1)) if df is not None]
    if not parts:
        return {}
    changed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    delta = changed.groupBy(*_KEY).agg(F.sum("amount").cast("decimal(38,4)").alias("amount"), F.sum("pledges").alias("pledges"))
    held = _held(delta, "funding-changes")

    def rewrite(rows: DataFrame) -> DataFrame:
        sums = rows.unionByName(held).groupBy(*_KEY).agg(
            F.sum("amount").cast("decimal(38,4)").alias("amount"), F.sum("pledges").alias("pledges")
        )
        return sums.filter("pledges <> 0 OR amount <> 0")

    return store.apply({name: Change([held.select("id")], rewrite, whole_buckets=True)}, tag)


def daily(store: Store, name: str = NAME) -> DataFrame:
    return store.read(name).select("id", "backing", "amount")
