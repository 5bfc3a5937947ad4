"""Integrity audits: one row per violation, ``(table_name, rule, row_key, detail)``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions import messages
from pledgeflow.functions.expressions import check_violated, row_key
from pledgeflow.operators.joins import spread_join
from pledgeflow.schema import TABLES, ForeignKey, TableSpec
from pledgeflow.session import working_folder

RULES = ("not_null", "check")


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _held(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in the shared folder, so that it is computed once and Spark knows its bytes."""
    folder = working_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def audit_rows(df: DataFrame, spec: TableSpec, rules: Sequence[str] = RULES) -> DataFrame | None:
    """NOT NULL and CHECK violations of one table, found in a single scan.

    None when the table declares no such rule.
    """
    findings = []
    if "not_null" in rules:
        findings += [(F.col(c).isNull(), "not_null", c) for c in spec.required]
    if "check" in rules:
        findings += [(check_violated(F.expr(c)), "check", c) for c in spec.checks]
    if not findings:
        return None
    found = F.array(
        *[
            F.when(broken, F.struct(F.lit(rule).alias("rule"), F.lit(detail).alias("detail")))
            for broken, rule, detail in findings
        ]
    )
    return df.select(
        row_key(df.schema, spec.key).alias("row_key"),
        F.explode(F.filter(found, lambda f: f.isNotNull())).alias("found"),
    ).select(
        F.lit(spec.name).alias("table_name"), F.col("found.rule").alias("rule"), "row_key",
        F.col("found.detail").alias("detail"),
    )


def audit_all_rows(tables: Mapping[str, DataFrame], rules: Sequence[str] = RULES, names: Sequence[str] = tuple(TABLES)) -> DataFrame:
    parts = [audit_rows(tables[n], TABLES[n], rules) for n in names]
    return _all([p for p in parts if p is not None])


def audit_domain(df: DataFrame, table: str, key: Sequence[str], column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside a fixed list; NULL passes."""
    return df.filter(check_violated(F.col(column).isin(*allowed))).select(
        F.lit(table).alias("table_name"),
        F.lit("domain").alias("rule"),
        row_key(df.schema, key).alias("row_key"),
        F.format_string(f"{column}: %s", column).alias("detail"),
    )


def audit_unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part is no key. Copies are counted before the shuffle."""
    repeated = df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return repeated.select(
        F.lit(table).alias("table_name"),
        F.lit("unique").alias("rule"),
        row_key(df.schema, key).alias("row_key"),
        F.format_string("%d rows", "copies").alias("detail"),
    )


def audit_unique_by_digest(
    df: DataFrame, table: str, key: Sequence[str], digest: Callable[..., Column] = F.xxhash64
) -> DataFrame:
    """The rows of ``audit_unique``, with digests of the keys counted first.

    Keys are nearly all different, so counting them moves every key. Here 64-bit digests move, and the full keys of those rows alone
    whose digest occurs twice; equal digests of different keys are told apart by the second count. The
    digests that occur twice are stored when this is called, so Spark knows their size.
    """
    key = list(key)
    keys = df.dropna(subset=key).select(*key, digest(*key).alias("__digest"))
    twice = keys.groupBy("__digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__digest")
    doubtful = _held(twice, "digests")
    return audit_unique(keys.join(doubtful, "__digest", "left_semi").select(*key), table, key)


def audit_all_keys(tables: Mapping[str, DataFrame], names: Sequence[str] = tuple(TABLES)) -> DataFrame:
    return _all([audit_unique(tables[n], n, TABLES[n].key) for n in names])


def key_conflicts(batch: DataFrame, key: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
    """Keys of the batch that cannot be added: repeated in it, or already stored.

    Returns the key columns, ``copies`` in the batch and ``is_stored``. The
    batch is counted per key first, so a key with very many copies travels as
    one row per map task. The stored table is on the streamed side of its join:
    a batch small enough to broadcast finds its clashes without shuffling it.
    """
    key = list(key)
    offered = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    repeated = offered.filter("copies > 1").withColumn("is_stored", F.lit(False))
    if stored is None:
        return repeated
    taken = stored.select(*key).join(offered, key).withColumn("is_stored", F.lit(True))
    return (
        repeated.unionByName(taken)
        .groupBy(*key)
        .agg(F.max("copies").alias("copies"), F.max("is_stored").alias("is_stored"))
    )


def with_key_reason(judged: DataFrame, batch: DataFrame, table: str, key: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
    """Add ``key_reason`` to a judged batch; only rows without a reason compete for a key.

    Runs one job now: it counts the keys of the plain batch and stores the
    clashes in the shared folder, so Spark knows their size in bytes. As a rule
    they are few and it broadcasts them: then neither finding the copies that pass
    the rules nor marking the batch moves its rows. A batch without any is returned as it is;
    with some, the judged batch is stored as well.
    """
    key = list(key)
    clashes = _held(key_conflicts(batch, key, stored), "clashes")
    if clashes.isEmpty():
        return judged.withColumn("key_reason", F.lit(None).cast("string"))
    # Asked for the contested keys and for the result, so judged once.
    judged = _held(judged, "judged")
    repeated = clashes.filter(~F.col("is_stored")).select(*key)
    contested = (
        judged.join(repeated, key, "left_semi")
        .filter(F.col("reason").isNull())
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .select(*key, F.lit(messages.KEY_REPEATED.format(table=table)).alias("key_reason"))
    )
    taken = clashes.filter("is_stored").select(
        *key, F.lit(messages.KEY_STORED.format(table=table)).alias("key_reason")
    )
    return judged.join(contested.unionByName(taken), key, "left")


def audit_collision(batch: DataFrame, stored: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Keys of a new batch that clash with stored rows or with each other."""
    return key_conflicts(batch, key, stored).select(
        F.lit(table).alias("table_name"),
        F.lit("collision").alias("rule"),
        row_key(batch.schema, key).alias("row_key"),
        F.when(F.col("is_stored"), "already stored").otherwise("repeated in batch").alias("detail"),
    )


def audit_foreign_key(child: DataFrame, spec: TableSpec, fk: ForeignKey, parent: DataFrame, hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Child rows whose reference has no parent; a NULL part passes.

    ``hot`` maps a column of the foreign key to its hot keys.
    """
    keys = parent.select(*[F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns)])
    spread = next((hot[c] for c in fk.columns if c in hot), None) if hot else None
    needed = list(dict.fromkeys([*spec.key, *fk.columns]))
    rows = child.select(*needed).dropna(subset=list(fk.columns))
    orphans = spread_join(rows, keys, fk.columns, "left_anti", spread, spread_by=spec.key)
    return orphans.select(
        F.lit(spec.name).alias("table_name"),
        F.lit("foreign_key").alias("rule"),
        row_key(child.schema, spec.key).alias("row_key"),
        F.lit(fk.label).alias("detail"),
    )


def audit_foreign_keys(
    tables: Mapping[str, DataFrame], composite: bool | None = None, hot: Mapping[str, Mapping[str, DataFrame]] | None = None
) -> DataFrame:
    """All references of the model; ``composite`` picks those of one or of several columns.

    ``hot`` holds, by table, the hot keys of its referring columns. Where none are given
    the child rows are on the left of a plain join, which adaptive execution splits.
    """
    parts = []
    for spec in TABLES.values():
        for fk in spec.foreign_keys:
            if composite is None or composite == (len(fk.columns) > 1):
                spread = hot.get(spec.name) if hot else None
                parts.append(audit_foreign_key(tables[spec.name], spec, fk, tables[fk.parent], spread))
    return _all(parts)


def cast_quarantine(df: DataFrame, raw: str, target: str = "date") -> DataFrame:
    """Rows with ``value``, the cast of ``raw``, and whether the text was no such value."""
    value = F.col(raw).try_cast(target)
    return df.select(
        "*", value.alias("value"), (F.col(raw).isNotNull() & value.isNull()).alias("is_bad")
    )
