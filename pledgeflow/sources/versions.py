"""Stored tables in versions: a change rewrites only the files that hold a changed row.

A store is a folder with data files and one manifest per version, which lists the files of every table. A change finds the
files that hold one of its keys, writes their rows anew and publishes a manifest with these files in place of the old
ones; all other files stay under their names. Several tables change together, as one manifest is published at the end.
Readers of an older version are not disturbed, and a writer that fails halfway leaves files that no manifest names. Of two writers
that start from the same version the second one is refused.

A table may be dealt into buckets of the hash of some columns, one bucket per file; then a change looks for its keys in
their buckets only. Choose columns that no single value dominates. The driver reads names of files, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "__bucket"
_MANIFEST = (
    "name STRING, fields STRING, by ARRAY<STRING>, buckets INT, files ARRAY<STRUCT<path: STRING, bucket: INT>>, tag STRING"
)


@dataclass(frozen=True)
class Entry:
    """A table in a version: its schema, its buckets, and the path below the store and bucket of each file."""

    schema: T.StructType
    by: tuple[str, ...]
    buckets: int
    files: tuple[tuple[str, int | None], ...]


@dataclass(frozen=True)
class Change:
    """``rewrite`` gives the new rows for those of the files that hold one of ``keys``; ``added`` rows go to new files.

    Each DataFrame of ``keys`` has columns of the table; a file is concerned if a row agrees with one of them. With
    ``whole_buckets`` every file in the buckets of the keys is, and ``rewrite`` may add rows of these buckets.
    """

    keys: Sequence[DataFrame] = ()
    rewrite: Callable[[DataFrame], DataFrame] | None = None
    added: DataFrame | None = None
    whole_buckets: bool = False


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- manifests

    def version(self) -> int:
        """The latest version; -1 for an empty store."""
        try:
            manifests = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{self.root}/manifests")
        except AnalysisException:
            return -1
        found = manifests.agg(F.max("version")).first()[0] if "version" in manifests.columns else None
        return -1 if found is None else int(found)

    def _manifest(self, version: int) -> tuple[dict[str, Entry], str | None]:
        if version < 0:
            return {}, None
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifests/version={version}").collect()
        entries = {
            r["name"]: Entry(
                T.StructType.fromJson(json.loads(r["fields"])), tuple(r["by"]), r["buckets"],
                tuple((f["path"], f["bucket"]) for f in r["files"]),
            )
            for r in rows
        }
        return entries, rows[0]["tag"] if rows else None

    def _publish(self, version: int, entries: Mapping[str, Entry], tag: str | None) -> None:
        rows = [(n, e.schema.json(), list(e.by), e.buckets, list(e.files), tag) for n, e in entries.items()]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("errorifexists").parquet(f"{self.root}/manifests/version={version}")

    def files(self, name: str, version: int | None = None) -> list[str]:
        entries, _ = self._manifest(self.version() if version is None else version)
        return [path for path, _ in entries[name].files]

    # --- tables

    def _frame(self, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{p}" for p in paths))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        entries, _ = self._manifest(self.version() if version is None else version)
        return self._frame(entries[name].schema, [p for p, _ in entries[name].files])

    def create(self, tables: Mapping[str, DataFrame], by: Mapping[str, tuple[Sequence[str], int]] | None = None) -> None:
        """Adds tables; ``by`` names columns and number of buckets of those that are dealt into buckets."""
        version = self.version()
        entries, _ = self._manifest(version)
        for name, df in tables.items():
            columns, buckets = (by or {}).get(name, ((), 0))
            schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
            entry = Entry(schema, tuple(columns), buckets, ())
            entries[name] = replace(entry, files=self._written(name, df, entry))
        self._publish(version + 1, entries, None)

    def _written(self, name: str, df: DataFrame, entry: Entry, most: int | None = None) -> tuple[tuple[str, int | None], ...]:
        folder = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        df = df.select(*entry.schema.names)
        if entry.by:
            placed = df.withColumn(_BUCKET, self._bucket(entry)).repartition(entry.buckets, _BUCKET)
            placed.write.partitionBy(_BUCKET).parquet(folder)
        else:
            (df if most is None else df.coalesce(most)).write.parquet(folder)
        made = map(self._relative, self.spark.read.schema(entry.schema).parquet(folder).inputFiles())
        marker = f"/{_BUCKET}="
        return tuple((p, int(p.split(marker)[1].split("/")[0]) if marker in p else None) for p in sorted(made))

    def _relative(self, uri: str) -> str:
        return "data/" + unquote(uri).rsplit("/data/", 1)[1]

    def _bucket(self, entry: Entry):
        typed = [F.col(c).cast(entry.schema[c].dataType) for c in entry.by]
        return F.pmod(F.xxhash64(*typed), F.lit(entry.buckets)).cast("int")

    # --- changes

    def _concerned(self, entry: Entry, change: Change) -> list[tuple[str, int | None]]:
        found: set[str] = set()
        for keys in change.keys:
            candidates = list(entry.files)
            if entry.by and set(entry.by) <= set(keys.columns):
                hit = {r[0] for r in keys.select(self._bucket(entry)).distinct().collect()}  # one per bucket at most
                candidates = [f for f in candidates if f[1] in hit]
            paths = [p for p, _ in candidates]
            if paths and not change.whole_buckets:
                rows = self._frame(entry.schema, paths).select(*keys.columns, F.col("_metadata.file_path").alias("__file"))
                held = rows.join(keys.distinct(), keys.columns, "left_semi").select("__file").distinct().collect()
                paths = [self._relative(r[0]) for r in held]
            found.update(paths)
        return [f for f in entry.files if f[0] in found]

    def apply(self, changes: Mapping[str, Change], tag: str | None = None) -> dict[str, list[str]]:
        """Publishes the next version, with all ``changes``; gives the files each table lost.

        A change whose ``tag`` is that of the latest version has been published already and is not made again.
        """
        version = self.version()
        entries, last = self._manifest(version)
        if tag is not None and tag == last:
            return {}
        gone: dict[str, list[str]] = {}
        for name, change in changes.items():
            entry = entries[name]
            concerned = self._concerned(entry, change)
            gone[name] = [p for p, _ in concerned]
            files = [f for f in entry.files if f not in concerned]
            if change.rewrite and (concerned or change.whole_buckets):
                new = change.rewrite(self._frame(entry.schema, gone[name]))
                files += self._written(name, new, entry, len(concerned))
            if change.added is not None:
                files += self._written(name, change.added, entry)
            entries[name] = replace(entry, files=tuple(files))
        self._publish(version + 1, entries, tag)
        return gone
