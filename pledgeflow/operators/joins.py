"""Joins of a large table with a small, a batch-sized or a skewed side.

A viral project or a very active backer would send a large share of all
pledges to one task of a shuffled join. ``spread_join`` cuts such keys into
slices and repeats the matching lookup rows once per slice, so the result is
that of the plain join. Without hot keys it *is* the plain join, with the large
table on the left where adaptive execution may split it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with one of so many parts of all rows; that bounds the list of hot keys too.
HOT_PARTS = 4096

_SLICE, _SLICES = "__slice", "__slices"


def hot_keys(rows: DataFrame, key: Sequence[str], parts: int = HOT_PARTS) -> DataFrame:
    """The keys that hold at least one ``parts``-th of all rows, so ``parts`` keys at most.

    Comes with the number of slices each key is to be cut into. Counts the rows when called.
    """
    min_rows = max(1, -(-rows.count() // parts))
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
    return (
        counted.filter(F.col("__rows") >= min_rows)
        .dropna(subset=list(key))
        .select(*key, F.ceil(F.col("__rows") / min_rows).cast("int").alias(_SLICES))
    )


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Join ``facts`` to ``lookup``; the keys in ``hot`` are spread over their slices.

    ``hot`` comes from ``hot_keys`` on one or more of the ``on`` columns, so its
    size is bounded by its ``parts`` and it is safe to broadcast. ``spread_by`` names columns of
    ``facts`` that tell the rows of one key apart.
    """
    on = list(on)
    if hot is None:
        return facts.join(lookup, on, how)
    marked, key = F.broadcast(hot), [c for c in hot.columns if c != _SLICES]
    slices = F.coalesce(F.col(_SLICES), F.lit(1))
    cut = F.pmod(F.xxhash64(*(spread_by or facts.columns)), slices).cast("int")
    left = facts.join(marked, key, "left").withColumn(_SLICE, cut).drop(_SLICES)
    right = (
        lookup.join(marked, key, "left")
        .withColumn(_SLICE, F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop(_SLICES)
    )
    return left.join(right, [*on, _SLICE], how).drop(_SLICE)


def matching(table: DataFrame, batch: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of a large table whose key occurs in a batch.

    The table is on the streamed side: while the batch is small enough to
    broadcast, the table is scanned but not shuffled.
    """
    return table.join(batch.select(*on).distinct(), list(on), "left_semi")
