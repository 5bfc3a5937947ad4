"""Rows without a parent, kept up to date by changes instead of audited anew.

Per reference the state holds the child rows whose parent is missing: their key, their reference, and how many copies there are.
A batch of added and removed rows changes it in four ways: added children without a parent come in, removed children go, children of
parents that left come in, and children of parents that arrived go. Children that were there before are read
only for parents that left, by a semi join on their keys; parents are asked for the keys of the batch alone. Of the state
itself only the buckets of these references are rewritten (see ``sources.versions``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions.expressions import row_key
from pledgeflow.operators.joins import matching
from pledgeflow.schema import TABLES, ForeignKey, TableSpec
from pledgeflow.session import working_folder
from pledgeflow.sources.versions import Change, Store

Tables = Mapping[str, DataFrame]
BUCKETS = 64


def references(composite: bool | None = None) -> list[tuple[TableSpec, ForeignKey]]:
    return [
        (spec, fk)
        for spec in TABLES.values()
        for fk in spec.foreign_keys
        if composite is None or composite == (len(fk.columns) > 1)
    ]


def _name(spec: TableSpec, fk: ForeignKey) -> str:
    return f"orphans-{spec.name}-{'-'.join(fk.columns)}"


def _columns(spec: TableSpec, fk: ForeignKey) -> list[str]:
    return list(dict.fromkeys([*spec.key, *fk.columns]))


def _parent_keys(rows: DataFrame, fk: ForeignKey) -> DataFrame:
    return rows.select(*[F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns)])


def _copies(children: DataFrame, spec: TableSpec, fk: ForeignKey, sign: int = 1) -> DataFrame:
    """(key, reference, copies) of rows whose reference is not NULL."""
    columns = _columns(spec, fk)
    counted = children.select(*columns).dropna(subset=list(fk.columns)).groupBy(*columns)
    return counted.agg((F.lit(sign) * F.count(F.lit(1))).alias("copies"))


def start(store: Store, tables: Tables, buckets: int = BUCKETS) -> None:
    """The state of tables as they are, by a full audit."""
    made, by = {}, {}
    for spec, fk in references():
        parents = _parent_keys(tables[fk.parent], fk)
        made[_name(spec, fk)] = _copies(tables[spec.name].join(parents, list(fk.columns), "left_anti"), spec, fk)
        by[_name(spec, fk)] = (fk.columns, buckets)
    store.create(made, by)


def _held(df: DataFrame, name: str) -> DataFrame:
    folder = working_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _change(now: Tables, spec: TableSpec, fk: ForeignKey, added: Tables, removed: Tables) -> Change | None:
    on, parts, lost, gained = list(fk.columns), [], None, None
    # an updated parent row is removed and added again; only keys without any row left are lost
    if fk.parent in removed or fk.parent in added:
        gone, come = (side.get(fk.parent) for side in (removed, added))
        if gone is not None:
            keys = _parent_keys(gone, fk).distinct()
            lost = _held(keys.join(matching(_parent_keys(now[fk.parent], fk), keys, on), on, "left_anti"), "lost-parents")
            parts.append(_copies(matching(now[spec.name], lost, on), spec, fk))
        if come is not None:
            keys = _parent_keys(come, fk).distinct()
            gained = _held(matching(_parent_keys(now[fk.parent], fk), keys, on).distinct(), "gained-parents")
    for side, sign in ((added, 1), (removed, -1)):
        if spec.name in side:
            rows = side[spec.name]
            if lost is not None:  # counted in full above
                rows = rows.join(lost, on, "left_anti")
            if sign == 1:
                rows = rows.join(matching(_parent_keys(now[fk.parent], fk), rows.dropna(subset=on), on), on, "left_anti")
            parts.append(_copies(rows, spec, fk, sign))
    if not parts and gained is None:
        return None
    columns = _columns(spec, fk)
    delta = None
    for part in parts:
        delta = part if delta is None else delta.unionByName(part)
    if delta is not None:
        delta = _held(delta, "orphan-changes")

    def rewrite(rows: DataFrame) -> DataFrame:
        if delta is not None:
            rows = rows.unionByName(delta).groupBy(*columns).agg(F.sum("copies").alias("copies")).filter("copies > 0")
        return rows if gained is None else rows.join(gained, on, "left_anti").select(*columns, "copies")

    return Change([df.select(*on) for df in (delta, gained) if df is not None], rewrite, whole_buckets=True)


def update(store: Store, now: Tables, added: Tables, removed: Tables, tag: str | None = None) -> dict[str, list[str]]:
    """The state after rows have come and gone; ``now`` are the tables with these changes made.

    A row that changes is in ``removed`` as it was and in ``added`` as it is.
    """
    changes = {_name(spec, fk): _change(now, spec, fk, added, removed) for spec, fk in references()}
    return store.apply({name: c for name, c in changes.items() if c is not None}, tag)


def violations(store: Store, composite: bool | None = None) -> DataFrame:
    """The rows of ``audit.audit_foreign_keys``, from the state."""
    found = None
    version = store.version()
    for spec, fk in references(composite):
        orphans = store.read(_name(spec, fk), version)
        part = orphans.select(
            F.lit(spec.name).alias("table_name"),
            F.lit("foreign_key").alias("rule"),
            row_key(orphans.schema, spec.key).alias("row_key"),
            F.lit(fk.label).alias("detail"),
            F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("__copy"),
        ).drop("__copy")
        found = part if found is None else found.unionByName(part)
    return found
