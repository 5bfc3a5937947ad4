"""Benchmark decontamination: training passages that occur in a benchmark.

A broadcast set of normalised test n-grams is looked up for every window of
every document. A window is ``size`` consecutive words of an item; a shorter
item is one window. Words are numbered by a dictionary of the benchmark, so a
window with a foreign word is skipped without hashing; the others are hashed
together in numpy, and each hit is verified word by word.

Bounds: a block of the benchmark has at most ``block_words`` words (a single
longer item is a block of its own) and is all that is broadcast at a time; a
larger benchmark gives more blocks, each one a further pass over what the pass before has
stored; its broadcast is destroyed before the next one is made.

Defined cases: null and empty texts have no words and no hits; an item without
words is no window; a null item id counts as the id ``null``; repeated items count
once, as the same id; repeated document rows are judged one by one; empty tables
give empty results or no hits; columns of the input named like the added ones
are replaced, all others are kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from pledgeflow.llm.common import Rows, alnum_words, set_aside, stored, with_columns

#: Words of an item that make one window.
WINDOW = 10
#: Words of the benchmark in one broadcast set: some 100 MB in a Python worker.
BLOCK_WORDS = 500_000

_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField("hit_spans", ArrayType(_SPAN)),
        StructField("hit_items", ArrayType(StringType())),
    ]
)


class NgramSet:
    """The windows of some items: by length, a sorted array of hashes and the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int):
        self.ids: dict[bytes, int] = {}
        windows: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, found in items:
            ids = np.fromiter((self.ids.setdefault(w, len(self.ids)) for w in found), np.int32, len(found))
            length = min(size, len(ids))
            for i in range(len(ids) - length + 1 if length else 0):
                windows[length][ids[i : i + length].tobytes()].add(item)
        self.windows = {n: dict(w) for n, w in windows.items()}
        self.hashes = {
            n: np.unique(self._hash(np.frombuffer(b"".join(w), np.int32).reshape(-1, n))) for n, w in windows.items()
        }

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        powers = np.cumprod(np.full(rows.shape[1], 0x9E3779B97F4A7C15, np.uint64))
        return (rows.astype(np.uint64) + np.uint64(1)) @ powers

    def find(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans (end exclusive, merged, ascending) inside windows that occur, and their items."""
        ids = np.fromiter(map(self.ids.get, found, repeat(-1)), np.int32, len(found))
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        for n, windows in self.windows.items():
            starts = np.flatnonzero(known[n:] - known[:-n] == n) if len(ids) >= n else ()
            if not len(starts):
                continue
            rows = ids[starts[:, None] + np.arange(n)]
            hashes, these = self._hash(rows), self.hashes[n]
            at = np.minimum(np.searchsorted(these, hashes), len(these) - 1)
            for k in np.flatnonzero(these[at] == hashes):
                if (of := windows.get(rows[k].tobytes())) is not None:
                    hits.append((int(starts[k]), int(starts[k]) + n))
                    items |= of
        return merged(hits), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans united."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, size: int, block_words: int):
    """The benchmark in pieces whose words are counted, one at a time."""
    rows = benchmark.select(F.col(item).cast("string"), F.col(text)).dropDuplicates()
    block: list[tuple[str, list[bytes]]] = []
    held = 0
    for row in rows.toLocalIterator():
        found = alnum_words(row[1])
        if block and held + len(found) > block_words:
            yield NgramSet(block, size)
            block, held = [], 0
        block.append((row[0] if row[0] is not None else "null", found))
        held += len(found)
    if block:
        yield NgramSet(block, size)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word positions, end exclusive) and ``hit_items``.

    Reads the benchmark when called.
    """
    context = docs.sparkSession.sparkContext
    out = docs.drop(*[c for c in docs.columns if c.lower() in {f.name for f in _FOUND.fields}])
    last = None
    for one in _blocks(benchmark, item, item_text, size, block_words):
        again = last is not None
        if again:
            out = stored(out, "leaks")
            last.destroy()
        last = context.broadcast(one)
        out = with_columns(out, _FOUND, _scanner(text, last, again))
    return out if last else with_columns(out, _FOUND, _scanner(text, context.broadcast(NgramSet([], size)), False))


def _scanner(text: str, block, again: bool) -> Callable[[], Callable[[pa.RecordBatch], Rows]]:
    def start() -> Callable[[pa.RecordBatch], Rows]:
        grams = block.value

        def scan(batch: pa.RecordBatch) -> Rows:
            lengths, spans, items = [], [], []
            for value in batch.column(text).to_pylist():
                found = alnum_words(value)
                hits, of = grams.find(found)
                lengths.append(len(found))
                spans.append(hits)
                items.append(of)
            if again:
                before = [[(s["start"], s["end"]) for s in x] for x in batch.column("hit_spans").to_pylist()]
                spans = [merged(a + b) for a, b in zip(before, spans)]
                items = [of | set(x) for of, x in zip(items, batch.column("hit_items").to_pylist())]
            as_struct = [[{"start": s, "end": e} for s, e in x] for x in spans]
            return {"n_words": lengths, "hit_spans": as_struct, "hit_items": [sorted(x) for x in items]}

        return scan

    return start


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Only the documents in which no benchmark window occurs, with the columns of ``docs``."""
    renamed, back = set_aside(docs, {f.name for f in _FOUND.fields})
    return back(find_leaks(renamed, benchmark, **options).filter(F.size("hit_spans") == 0))
