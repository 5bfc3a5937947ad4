"""Key changes and deletes that reach into other tables.

The reference catalog in ``schema`` says which references carry a change on to
the child rows and which refuse it while child rows exist.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pledgeflow.operators.joins import matching
from pledgeflow.schema import TABLES, references_to
from pledgeflow.session import working_folder

Tables = Mapping[str, DataFrame]


def _update_edges(table: str, column: str) -> Iterator[tuple[str, str, str]]:
    """``(child, column, action)`` of every reference a change of the column reaches."""
    for spec, fk in references_to(table):
        if column in fk.parent_columns:
            child_column = fk.columns[fk.parent_columns.index(column)]
            yield spec.name, child_column, fk.on_update
            if fk.on_update == "cascade":
                yield from _update_edges(spec.name, child_column)


def blocked_key_update(tables: Tables, table: str, column: str, mapping: DataFrame) -> DataFrame:
    """``(old_value, blocked_by)``: changes refused because of rows that do not follow.

    ``mapping`` has ``old_value`` and ``new_value``. Besides child tables,
    ``blocked_by`` can be ``"null"``, for a key cannot be NULL, and ``"collision"``: the
    new value is wanted by two changes or belongs to a row that keeps it, also
    one that keeps it because its own change is refused. The changes are stored when this is called.
    """
    wanted = mapping.select("old_value").distinct()
    blocks = [
        _named(tables[child], child_column, wanted).select("old_value", F.lit(child).alias("blocked_by"))
        for child, child_column, action in _update_edges(table, column)
        if action == "restrict"
    ]
    blocks.append(mapping.filter("new_value IS NULL").select("old_value", F.lit("null").alias("blocked_by")))
    restricted = reduce(DataFrame.unionByName, blocks).distinct()
    collisions = _colliding_changes(tables[table], column, mapping, restricted.select("old_value").distinct())
    return restricted.unionByName(collisions.select("old_value", F.lit("collision").alias("blocked_by"))).distinct()


def _named(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The values of ``wanted`` that occur; a short list finds them without a shuffle of the table."""
    return df.select(F.col(column).alias("old_value")).join(wanted, "old_value", "left_semi").distinct()


def _colliding_changes(df: DataFrame, column: str, mapping: DataFrame, restricted: DataFrame) -> DataFrame:
    """Changes whose new value is not free once all refused changes stay as they are.

    A change waits for the one that would free its new value. Along such a chain a refusal carries on to all
    that wait; each round doubles how far it looks, on the mapping alone.
    """
    spark = df.sparkSession
    real = mapping.join(_named(df, column, mapping.select("old_value").distinct()), "old_value", "left_semi").distinct()
    occupied = _named(df, column, mapping.select(F.col("new_value").alias("old_value")).distinct())
    stuck = restricted.select("old_value", F.lit(True).alias("stuck"))
    several = F.count(F.lit(1)).over(Window.partitionBy("old_value")) > 1
    contested = F.count(F.lit(1)).over(Window.partitionBy("new_value")) > 1
    marked = (
        real.withColumn("several", several)
        .withColumn("collides", contested)
        .join(occupied.select(F.col("old_value").alias("new_value"), F.lit(True).alias("taken")), "new_value", "left")
        .join(stuck, "old_value", "left")
    )
    moving = mapping.select(F.col("old_value").alias("new_value"), F.lit(True).alias("leaves")).distinct()
    changes = marked.join(moving, "new_value", "left").select(
        "old_value",
        F.when(F.col("leaves"), F.col("new_value")).alias("next"),
        (F.col("collides") | (F.coalesce("taken", F.lit(False)) & F.col("leaves").isNull())).alias("collides"),
        (F.col("several") | F.coalesce("stuck", F.lit(False))).alias("stays"),
    )
    changes = _stored(changes, spark)
    for _ in range(changes.count().bit_length()):
        ahead = changes.groupBy(F.col("old_value").alias("next")).agg(
            F.max(F.col("collides") | F.col("stays")).alias("refused"), F.max("next").alias("beyond")
        )
        changes = _stored(
            changes.join(ahead, "next", "left").select(
                "old_value",
                F.when(F.col("beyond") != F.col("old_value"), F.col("beyond")).alias("next"),
                (F.col("collides") | F.coalesce("refused", F.lit(False))).alias("collides"),
                "stays",
            ),
            spark,
        )
    return changes.filter("collides").select("old_value").distinct()


def _stored(df: DataFrame, spark: SparkSession) -> DataFrame:
    folder = working_folder(spark, "key-changes")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _one_value_per_key(mapping: DataFrame) -> DataFrame:
    """Changes that name one new value; a key with several, or with NULL, keeps its old one."""
    return (
        mapping.groupBy("old_value")
        .agg(
            F.min("new_value").alias("new_value"),
            F.max("new_value").alias("__other"),
            F.count_if(F.col("new_value").isNull()).alias("__nulls"),
        )
        .filter((F.col("new_value") == F.col("__other")) & (F.col("__nulls") == 0))
        .drop("__other", "__nulls")
    )


def renamed(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """``df`` with the values of a column replaced; ``mapping`` names one new value per old one."""
    changes = mapping.select(F.col("old_value").alias(column), "new_value", F.lit(True).alias("__hit"))
    value = F.when(F.col("__hit"), F.col("new_value")).otherwise(F.col(column))
    return df.join(changes, column, "left").withColumn(column, value).select(*df.columns)


def settled_changes(tables: Tables, table: str, column: str, mapping: DataFrame, force: bool = False) -> DataFrame:
    """The changes that are made, one new value per key.

    Those listed by ``blocked_key_update`` are left out; ``force`` makes them too.
    """
    if not force:
        blocked = blocked_key_update(tables, table, column, mapping).select("old_value").distinct()
        mapping = mapping.join(blocked, "old_value", "left_anti")
    return _one_value_per_key(mapping)


def changed_columns(table: str, column: str) -> list[tuple[str, str]]:
    """``(table, column)`` of all that follows a change of key values, itself first."""
    return [(table, column)] + [(c, k) for c, k, action in _update_edges(table, column) if action == "cascade"]


def cascade_key_update(
    tables: Tables, table: str, column: str, mapping: DataFrame, force: bool = False
) -> dict[str, DataFrame]:
    """The tables that change when key values are replaced, in their new version.

    All values are looked up at once, so swapping two keys is safe. Changes
    listed by ``blocked_key_update`` are left out; ``force`` applies them too
    and leaves the rows that do not follow without a parent.
    """
    mapping = settled_changes(tables, table, column, mapping, force)
    changed: dict[str, DataFrame] = {}
    for name, of in changed_columns(table, column):
        changed[name] = renamed(changed.get(name, tables[name]), of, mapping)
    return changed


def _doomed(tables: Tables, table: str, deletes: DataFrame, cascade: bool) -> Iterator[tuple[str, DataFrame, str]]:
    """``(child, rows, action)`` for every reference reached from the deleted rows.

    For a cascade ``rows`` are the child rows that go, otherwise the deleted
    parent rows that the child still needs. Both carry ``__origin``, the key
    text of the deleted row they come from.
    """
    for spec, fk in references_to(table):
        on = list(fk.columns)
        parents = deletes.select(
            *[F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns)], "__origin"
        ).distinct()
        child = tables[spec.name]
        if cascade and fk.on_delete == "cascade":
            needed = list(dict.fromkeys([*spec.key, *_referenced_columns(spec.name), *on]))
            gone = child.select(*needed).join(parents, on)
            yield spec.name, gone, "cascade"
            yield from _doomed(tables, spec.name, gone, cascade)
        else:
            held = matching(child.select(*on), parents, on).distinct()
            yield spec.name, parents.join(held, on, "left_semi"), "restrict"


def _referenced_columns(table: str) -> list[str]:
    return [c for _, fk in references_to(table) for c in fk.parent_columns]


def _deleted_rows(tables: Tables, table: str, deletes: DataFrame) -> DataFrame:
    key = list(TABLES[table].key)
    origin = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    needed = list(dict.fromkeys([*key, *_referenced_columns(table)]))
    listed = deletes.select(*key).distinct()
    return tables[table].select(*needed).join(listed, key, "left_semi").withColumn("__origin", origin)


def blocked_delete(tables: Tables, table: str, deletes: DataFrame, cascade: bool = True) -> DataFrame:
    """``(row_key, blocked_by)``: deletes refused because rows elsewhere need them.

    ``deletes`` holds key values of ``table``. With ``cascade`` references that
    carry a delete on do so, and only the others refuse; without, all refuse.
    """
    doomed = _deleted_rows(tables, table, deletes)
    blocks = [
        rows.select(F.col("__origin").alias("row_key"), F.lit(child).alias("blocked_by"))
        for child, rows, action in _doomed(tables, table, doomed, cascade)
        if action == "restrict"
    ]
    return reduce(DataFrame.unionByName, blocks).distinct()


def doomed_keys(tables: Tables, table: str, deletes: DataFrame) -> list[tuple[str, DataFrame]]:
    """``(table, keys)`` of the rows that go with the deleted ones, the deleted ones first; a table may come several times."""
    doomed = _deleted_rows(tables, table, deletes)
    return [(table, deletes.select(*TABLES[table].key).distinct())] + [
        (child, rows.select(*TABLES[child].key).distinct())
        for child, rows, action in _doomed(tables, table, doomed, True)
        if action == "cascade"
    ]


def cascade_delete(tables: Tables, table: str, deletes: DataFrame) -> dict[str, DataFrame]:
    """The tables that lose rows when keys of ``table`` are deleted, in their new version.

    Only references that carry deletes on are followed; run ``blocked_delete``
    first to learn which deletes the others refuse.
    """
    left: dict[str, DataFrame] = {}
    for name, keys in doomed_keys(tables, table, deletes):
        now = left.get(name, tables[name])
        left[name] = now.join(keys, list(TABLES[name].key), "left_anti").select(*now.columns)
    return left
