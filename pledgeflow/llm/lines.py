"""Line dedup: lines that many documents share, with reversible counts.

The state is an exact table of reference counts, one row per line key with the
number of documents that hold it, and a cuckoo filter per shard of keys that are
common now. Documents can be inserted and deleted: counts are added and taken
away, keys that cross the threshold enter or leave their shard's filter.

To judge documents, their line keys go to the shard's filter, which turns away
nearly all rare lines; what passes is confirmed in the count table, so a false
positive of a filter never drops a line.

Filters may be kept: ``update_filters`` follows the counts, and ``drop_common_lines`` takes
both and judges by them; without, both are made from the documents.

Scale: counts are summed per task before the shuffle. Keys with at least ``HOT_LINES`` lines and one
``HOT_SHARE``-th of all lines, which are ``HOT_SHARE`` at most, are decided from a
broadcast list and never shuffled, as they would fill a shard; all others meet a filter, whatever the size of the table. The number of
shards follows the number of lines. Documents are told apart by a digest of id and
text, which decides the result, so equal rows share one answer.

Defined cases: a null or empty text is one empty line; keys shorter than
``min_chars`` (empty ones always) are never dropped; a line that occurs several
times in one document counts once there and is dropped everywhere; repeated rows
count as documents of their own; an empty table gives an empty result; other
columns are kept, those named like the added ones are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from pledgeflow.llm.common import Rows, arrow_pass, as_batch, encoded, stored, with_columns

MIN_DOCS, MIN_CHARS = 10, 1
#: Lines of one shard, about; a shard's lines are held by one task, 50 bytes each.
SHARD_LINES = 200_000
#: A key with so many lines, and one of so many parts of all lines, is decided from a broadcast list.
HOT_LINES, HOT_SHARE = 10_000, 10_000
#: Distinct keys a task sums up before it passes them on.
FLUSH_KEYS = 200_000
_BLANK = " \t\n\x0b\x0c\r"
_COUNTS = StructType([StructField("key", BinaryType()), StructField("n", LongType())])
_FILTERS = StructType([StructField("shard", LongType()), StructField("filter", BinaryType())])
_LINES = StructType(
    [StructField("doc", BinaryType()), StructField("key", BinaryType()), StructField("shard", LongType())]
)


class CuckooFilter:
    """Set of 64-bit hashes with deletion: two buckets of four 16-bit fingerprints for each.

    The second bucket is the first one xor a hash of the fingerprint, so entries
    move without their key. ``insert`` gives False when it is full; nothing is lost
    then, the caller builds a larger one from the exact keys.
    """

    SLOTS, KICKS = 4, 500

    def __init__(self, capacity: int = 0, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(1, int(np.ceil(np.log2(max(1, capacity) / self.SLOTS / 0.85))))
            table = np.zeros((buckets, self.SLOTS), np.uint16)
        self.table = table

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        """A filter that holds all of ``hashes``."""
        capacity = max(8, len(hashes))
        while True:
            made = cls(capacity)
            if all(map(made.insert, hashes.tolist())):
                return made
            capacity *= 2

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = hashes & mask
        second = first ^ (prints.astype(np.uint64) * np.uint64(0x5BD1E995) & mask)
        return prints, first, second

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(hashes)
        same = prints[:, None]
        return (self.table[first] == same).any(axis=1) | (self.table[second] == same).any(axis=1)

    def insert(self, key: int) -> bool:
        prints, first, second = (int(x[0]) for x in self._places(np.array([key], np.uint64)))
        for at in (first, second):
            if self._put(at, prints):
                return True
        undo, at, mask = [], second, len(self.table) - 1
        for kick in range(self.KICKS):
            slot = (key + kick) % self.SLOTS
            undo.append((at, slot, int(self.table[at, slot])))
            self.table[at, slot], prints = prints, undo[-1][2]
            at ^= prints * 0x5BD1E995 & mask
            if self._put(at, prints):
                return True
        for at, slot, was in reversed(undo):
            self.table[at, slot] = was
        return False

    def _put(self, at: int, prints: int) -> bool:
        free = np.flatnonzero(self.table[at] == 0)
        if len(free):
            self.table[at, free[0]] = prints
        return bool(len(free))

    def delete(self, key: int) -> bool:
        """Takes out one entry of a key that was inserted."""
        prints, first, second = (int(x[0]) for x in self._places(np.array([key], np.uint64)))
        for at in (first, second):
            held = np.flatnonzero(self.table[at] == prints)
            if len(held):
                self.table[at, held[0]] = 0
                return True
        return False


def split_lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit digest of the normalised line; None for a line that is never dropped."""
    line = line.strip(_BLANK)
    if not line or len(line) < min_chars:
        return None
    return xxhash.xxh3_128_digest(encoded(line).lower())


def _hashes(keys: list[bytes]) -> np.ndarray:
    """The second half of each digest; the first half chooses the shard."""
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 1]


def _shards(keys: list[bytes], shards: int) -> np.ndarray:
    return (np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 0] % np.uint64(shards)).astype(np.int64)


# --- the exact counts ----------------------------------------------------------


def count_lines(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, n): the number of rows of ``docs`` that hold each line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        target = to_arrow_schema(_COUNTS)
        for batch in batches:
            for value in batch.column(text).to_pylist():
                counts.update({line_key(x, min_chars) for x in split_lines(value)} - {None})
                if len(counts) > FLUSH_KEYS:
                    yield as_batch({"key": list(counts), "n": list(counts.values())}, target)
                    counts.clear()
        yield as_batch({"key": list(counts), "n": list(counts.values())}, target)

    return docs.select(text).mapInArrow(run, _COUNTS).groupBy("key").agg(F.sum("n").alias("n"))


def insert(counts: DataFrame, docs: DataFrame, **options) -> DataFrame:
    """The counts after ``docs`` have come in."""
    return counts.unionByName(count_lines(docs, **options)).groupBy("key").agg(F.sum("n").alias("n"))


def delete(counts: DataFrame, docs: DataFrame, **options) -> DataFrame:
    """The counts after ``docs``, which were inserted before, have gone; the exact reverse of ``insert``."""
    gone = count_lines(docs, **options).withColumn("n", -F.col("n"))
    left = counts.unionByName(gone).groupBy("key").agg(F.sum("n").alias("n"))
    return left.filter(F.col("n") > 0)


# --- the filters ---------------------------------------------------------------


def _with_shard(keys: DataFrame, shards: int) -> DataFrame:
    schema = StructType([*keys.schema.fields, StructField("shard", LongType())])

    def start() -> Callable[[pa.RecordBatch], Rows]:
        return lambda batch: {n: batch.column(n) for n in batch.schema.names} | {
            "shard": pa.array(_shards(batch.column("key").to_pylist(), shards))
        }

    return arrow_pass(keys, schema, start)


def build_filters(counts: DataFrame, shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """(shard, filter) of the keys that at least ``min_docs`` documents hold."""
    common = _with_shard(counts.filter(F.col("n") >= min_docs).select("key"), shards)

    def build(group: pa.Table) -> pa.Table:
        made = CuckooFilter.of(_hashes(group.column("key").to_pylist()))
        return pa.table({"shard": group.column("shard").slice(0, 1), "filter": [made.to_bytes()]})

    return common.groupBy("shard").applyInArrow(build, _FILTERS)


def update_filters(
    filters: DataFrame, before: DataFrame, after: DataFrame, shards: int, min_docs: int = MIN_DOCS
) -> DataFrame:
    """The filters after the counts went from ``before`` to ``after``: changed keys are put in or taken out.

    A filter that is full is built anew from the keys of its shard, so the keys that stay come along
    for shards that gain some.
    """
    was = before.select("key", (F.col("n") >= min_docs).alias("was"))
    now = after.select("key", (F.col("n") >= min_docs).alias("now"))
    both = was.join(now, "key", "full_outer").na.fill(False)
    marked = _with_shard(both.filter("was or now"), shards)

    def update(known: pa.Table, keys: pa.Table) -> pa.Table:
        shard = (keys if keys.num_rows else known).column("shard").slice(0, 1)
        if not keys.num_rows:
            return known.select(["shard", "filter"])
        old, new = keys.column("was").to_numpy(), keys.column("now").to_numpy()
        hashes = _hashes(keys.column("key").to_pylist())
        held = CuckooFilter.from_bytes(known.column("filter")[0].as_py()) if known.num_rows else CuckooFilter()
        for key in hashes[old & ~new].tolist():
            held.delete(key)
        if not all(map(held.insert, hashes[new & ~old].tolist())):
            held = CuckooFilter.of(hashes[new])
        return pa.table({"shard": shard, "filter": [held.to_bytes()]})

    return filters.groupBy("shard").cogroup(marked.groupBy("shard")).applyInArrow(update, _FILTERS)


# --- judging documents -----------------------------------------------------------


def _doc_digest(id_value, text: str | None) -> bytes:
    return xxhash.xxh3_128_digest(f"{id_value!r}:".encode() + encoded(text))


def drop_common_lines(
    docs: DataFrame,
    counts: DataFrame | None = None,
    id: str = "doc_id",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    shard_lines: int = SHARD_LINES,
    filters: DataFrame | None = None,
    shards: int | None = None,
) -> DataFrame:
    """``docs`` with the shortened text in place of the old one, and ``n_lines`` and ``n_dropped``.

    ``counts`` defaults to those of ``docs`` themselves. They are stored, and summed up, when this is called.
    ``filters`` are kept ones of these counts, with the number of ``shards`` they were built for; by default they are built.
    """
    if (filters is None) != (shards is None):
        raise ValueError("filters and their number of shards go together")
    spark = docs.sparkSession
    if counts is None:
        counts = count_lines(docs, text, min_chars)
    counts = stored(counts, "line-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    shards = shards or max(1, -(-total // shard_lines))
    hot = {
        bytes(r["key"]): r["n"] >= min_docs
        for r in counts.filter(F.col("n") >= max(HOT_LINES, min_docs, -(-total // HOT_SHARE))).collect()
    }
    decided = spark.sparkContext.broadcast(hot)
    filters = build_filters(counts, shards, min_docs) if filters is None else filters
    lines = _lines(docs, id, text, min_chars, decided, shards)
    maybe = (
        lines.groupBy("shard").cogroup(filters.groupBy("shard"))
        .applyInArrow(_probe, StructType(_LINES.fields[:2]))
    )
    common = counts.filter(F.col("n") >= min_docs).select("key")
    dropped = (
        maybe.join(common, "key", "left_semi")
        .groupBy(F.col("doc").alias("__doc"))
        .agg(F.collect_set("key").alias("__dropped"))
    )
    marked = with_columns(
        docs, StructType([StructField("__doc", BinaryType())]),
        lambda: lambda batch: {"__doc": [
            _doc_digest(i, t) for i, t in zip(batch.column(id).to_pylist(), batch.column(text).to_pylist())
        ]},
    )
    return _shortened(marked.join(dropped, "__doc", "left"), text, min_chars, decided).drop("__doc", "__dropped")


def _lines(docs, id, text, min_chars, decided, shards) -> DataFrame:
    """The distinct line keys of each document that are not decided already."""

    def start() -> Callable[[pa.RecordBatch], Rows]:
        known = decided.value

        def convert(batch: pa.RecordBatch) -> Rows:
            out, keys = [], []
            for i, value in zip(batch.column(id).to_pylist(), batch.column(text).to_pylist()):
                own = {k for x in split_lines(value) if (k := line_key(x, min_chars)) and k not in known}
                out += [_doc_digest(i, value)] * len(own)
                keys += own
            return {"doc": out, "key": keys, "shard": pa.array(_shards(keys, shards))}

        return convert

    return arrow_pass(docs.select(id, text), _LINES, start)


def _probe(lines: pa.Table, filters: pa.Table) -> pa.Table:
    lines = lines.select(["doc", "key"])
    if not filters.num_rows or not lines.num_rows:
        return lines.slice(0, 0)
    held = CuckooFilter.from_bytes(filters.column("filter")[0].as_py())
    return lines.filter(pa.array(held.contains(_hashes(lines.column("key").to_pylist()))))


def _shortened(marked: DataFrame, text: str, min_chars: int, decided) -> DataFrame:
    added = StructType(
        [StructField(text, StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
    )

    def start() -> Callable[[pa.RecordBatch], Rows]:
        hot = {k for k, common in decided.value.items() if common}

        def convert(batch: pa.RecordBatch) -> Rows:
            texts, before, gone = [], [], []
            for value, dropped in zip(batch.column(text).to_pylist(), batch.column("__dropped").to_pylist()):
                lines = split_lines(value)
                out = hot.union(dropped) if dropped else hot
                kept = [x for x in lines if line_key(x, min_chars) not in out] if out else lines
                texts.append("\n".join(kept))
                before.append(len(lines))
                gone.append(len(lines) - len(kept))
            return {text: texts, "n_lines": before, "n_dropped": gone}

        return convert

    return with_columns(marked, added, start)
