"""Bulk changes of stored tables that rewrite only the files they concern.

The same changes as in ``maintenance`` and ``cascade``, made in a ``Store`` and published as its next version. Keys of a change
that comes from a plan are stored first, since they are asked for several times.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.operators import cascade, maintenance
from pledgeflow.schema import TABLES
from pledgeflow.session import working_folder
from pledgeflow.sources.versions import Change, Store


def _held(df: DataFrame, name: str) -> DataFrame:
    folder = working_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _without(rows: DataFrame, keys: list[DataFrame]) -> DataFrame:
    for gone in keys:
        rows = rows.join(gone, gone.columns, "left_anti").select(*rows.columns)
    return rows


def append(store: Store, rows: Mapping[str, DataFrame], tag: str | None = None) -> None:
    """New rows in new files; nothing stored is read."""
    store.apply({name: Change(added=df) for name, df in rows.items()}, tag)


def update_requests(store: Store, changes: DataFrame, tag: str | None = None) -> dict[str, list[str]]:
    """``maintenance.apply_request_updates`` on the stored pledges."""
    changes = _held(changes, "request-changes")
    rewrite = lambda rows: maintenance.apply_request_updates(rows, changes)
    return store.apply({"backs": Change([changes.select("email", "id")], rewrite)}, tag)


def delete_users(store: Store, emails: DataFrame, tag: str | None = None) -> dict[str, list[str]]:
    """``maintenance.delete_users`` on the stored tables."""
    gone = _held(emails.select("email").distinct(), "deleted-users")
    change = Change([gone], lambda rows: _without(rows, [gone]))
    return store.apply({name: change for name in ("backers", "creators", "users")}, tag)


def update_keys(
    store: Store, table: str, column: str, mapping: DataFrame, force: bool = False, tag: str | None = None
) -> dict[str, list[str]]:
    """``cascade.cascade_key_update`` on the stored tables, all in one version."""
    tables = _Tables(store)
    mapping = _held(cascade.settled_changes(tables, table, column, mapping, force), "settled-changes")
    columns: dict[str, list[str]] = {}
    for name, of in cascade.changed_columns(table, column):
        columns.setdefault(name, []).append(of)

    def change(of: list[str]) -> Change:
        def rewrite(rows: DataFrame) -> DataFrame:
            for c in of:
                rows = cascade.renamed(rows, c, mapping)
            return rows

        return Change([mapping.select(F.col("old_value").alias(c)) for c in of], rewrite)

    return store.apply({name: change(of) for name, of in columns.items()}, tag)


def delete_rows(store: Store, table: str, deletes: DataFrame, tag: str | None = None) -> dict[str, list[str]]:
    """``cascade.cascade_delete`` on the stored tables, all in one version."""
    keys: dict[str, list[DataFrame]] = {}
    for name, gone in cascade.doomed_keys(_Tables(store), table, deletes):
        keys.setdefault(name, []).append(_held(gone.select(*TABLES[name].key), "doomed-keys"))
    change = lambda gone: Change(gone, lambda rows: _without(rows, gone))
    return store.apply({name: change(gone) for name, gone in keys.items()}, tag)


class _Tables(dict):
    """The tables of one version, read when asked for."""

    def __init__(self, store: Store):
        super().__init__()
        self.store, self.version = store, store.version()

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.store.read(name, self.version)
        return self[name]
