"""Token files: ids of documents, compressed by a static range asymmetric numeral system (rANS).

One frequency table, counted over all documents, serves all blocks. A block holds up to ``BLOCK_IDS`` ids of
whole documents (a longer document is cut), dealt in turn to ``LANES`` states that are coded side by side and share one
stream of 32-bit words. At every ``CHECK_ROWS`` turns a block has a checkpoint: the states, the place in
the words and the crc32 of the ids up to the next one. So blocks are decoded independently of each other,
and from each checkpoint on within a block. A checksum covers what is stored, another one each stretch of ids.

A data set is a folder of two Parquet tables, so that any store Spark reads can hold it: ``frequencies`` (one row) and
``blocks``, one row per block with the pieces of documents in it and the coded bytes, which describe themselves.

Writing: documents are tokenized and stored once, ids are counted, then rows are put in ranges of (id, place where they were
stored), so that an id that many rows share is split as well. Every task writes its blocks; the driver
sees the counts of the vocabulary and one total per partition. Places are relative to the partition until
they are read.

Defined cases: a null or empty text is the end id alone; a null document id comes first; rows with
equal document ids follow each other in the order they were stored in, each with its own place; an empty table gives
files without blocks, which read as no rows; other columns are dropped. A damaged block raises ``ValueError``.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from pledgeflow.llm.common import as_batch, kept_in_worker, schema_of, stored
from pledgeflow.llm.packing import tokenized
from pledgeflow.session import working_folder

END_ID = 1
BLOCK_IDS, LANES, CHECK_ROWS = 1 << 20, 1 << 10, 1 << 8
#: Bits of the sum of all frequencies: more ids than its half cannot be told apart well.
SCALE = 20
#: Ids of one range of documents, about, where the shuffle has not more partitions.
PART_IDS = 1 << 26
#: Pieces of text in each of the two generations of a worker's dictionary while documents are tokenized, 150 bytes each.
CACHE_PIECES = 1_000_000
#: Lower end of the states; they are refilled by 32 bits.
_LOW, _WORD = 1 << 31, 32
_MAGIC, _HEAD = b"rANS", struct.Struct("<4sIIIIIII")


class Damaged(ValueError):
    """A block whose bytes or ids are not those that were written."""


# --- coding ---------------------------------------------------------------------------


@dataclass
class Frequencies:
    """A share of 2**SCALE for every id that occurs."""

    share: np.ndarray  # per id
    below: np.ndarray  # shares of all smaller ids
    owner: np.ndarray  # id of every unit

    @classmethod
    def of(cls, ids: np.ndarray, counts: np.ndarray) -> Frequencies:
        if len(ids) > 1 << (SCALE - 1):
            raise ValueError(f"{len(ids)} different ids are too many for {SCALE} bits")
        share = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
        # Python's integers, as counts of a large corpus times the scale pass 64 bits
        total = int(sum(counts.tolist())) or 1
        share[ids] = [1 + c * ((1 << SCALE) - len(ids)) // total for c in counts.tolist()]
        if len(ids):
            share[ids[np.argmax(counts)]] += (1 << SCALE) - share.sum()
        return cls.from_share(share)

    @classmethod
    def from_share(cls, share: np.ndarray) -> Frequencies:
        return cls(share, np.cumsum(share) - share, np.repeat(np.arange(len(share), dtype=np.int32), share))

    @property
    def number(self) -> int:
        return crc32(self.share.astype("<i8").tobytes())


def encode(ids: np.ndarray, table: Frequencies) -> bytes:
    """A block that describes itself."""
    n = len(ids)
    lanes = max(1, min(LANES, n >> 6))
    rows = -(-n // lanes)
    states = np.full(lanes, _LOW, np.int64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, bytes]] = []
    share, below = table.share[ids], table.below[ids]
    for row in range(rows - 1, -1, -1):
        here = slice(row * lanes, (row + 1) * lanes)
        f = share[here]
        x = states[: len(f)]
        full = np.flatnonzero((x >> (_LOW.bit_length() - 1 - SCALE + _WORD)) >= f)
        over = x[full]
        words.append(over.astype("<u4"))
        x[full] = over >> _WORD
        times, rest = np.divmod(x, f)
        times <<= SCALE
        times += rest
        np.add(times, below[here], out=x)
        if row % CHECK_ROWS == 0:
            stretch = ids[row * lanes : (row + CHECK_ROWS) * lanes]
            marks.append((row, crc32(stretch.astype("<u4").tobytes()), states.astype("<u8").tobytes()))
    words.reverse()
    places = [0, *accumulate(map(len, words))]
    body = b"".join(struct.pack("<II", places[row], crc) + state for row, crc, state in reversed(marks))
    body += b"".join(map(np.ndarray.tobytes, words))
    return _HEAD.pack(_MAGIC, n, lanes, CHECK_ROWS, len(marks), places[-1], table.number, crc32(body)) + body


def decode(block: bytes, table: Frequencies, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` of a block; of the rest only what lies between the checkpoints around them is decoded."""
    if len(block) < _HEAD.size:
        raise Damaged("shorter than its head")
    magic, n, lanes, step, n_marks, n_words, number, check = _HEAD.unpack_from(block)
    if magic != _MAGIC or check != crc32(memoryview(block)[_HEAD.size :]):
        raise Damaged("not the bytes that were written")
    if number != table.number:
        raise Damaged("written with other frequencies")
    last = n if last is None else min(last, n)
    words = np.frombuffer(block, "<u4", n_words, len(block) - 4 * n_words)
    out, size = [], 8 + 8 * lanes
    for mark in range(max(0, first) // lanes // step, -(-last // (lanes * step)) if last > first else 0):
        at = _HEAD.size + mark * size
        place, crc = struct.unpack_from("<II", block, at)
        states = np.frombuffer(block, "<u8", lanes, at + 8).astype(np.int64)
        stretch = np.empty(min(n - mark * step * lanes, step * lanes), "<u4")
        for begin in range(0, len(stretch), lanes):
            x = states[: len(stretch) - begin]
            units = x & ((1 << SCALE) - 1)
            ids = table.owner[units].astype(np.intp)
            x >>= SCALE
            x *= table.share[ids]
            x += units
            x -= table.below[ids]
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << _WORD) | words[place : place + len(low)]
            place += len(low)
            stretch[begin : begin + lanes] = ids
        if crc32(stretch.tobytes()) != crc:
            raise Damaged("ids differ from those that were written")
        start = mark * step * lanes
        out.append(stretch[max(0, first - start) : last - start])
    return np.concatenate(out) if out else np.empty(0, "<u4")


# --- checksums of pieces ------------------------------------------------------------------


def _times(matrix: list[int], value: int) -> int:
    out = 0
    for row in matrix:
        if value & 1:
            out ^= row
        value >>= 1
    return out


def _zeros() -> list[list[int]]:
    """What 2**k zero bytes do to a crc32, as a matrix of 32 columns for each k."""
    one = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
    for _ in range(3):
        one = [_times(one, c) for c in one]
    out = [one]
    for _ in range(40):
        out.append([_times(out[-1], c) for c in out[-1]])
    return out


_ZEROS = _zeros()


def moved(crc: int, n_bytes: int) -> int:
    """The share of a piece in the crc32 of a whole that has so many bytes behind it; a whole's crc32 is the xor of these."""
    k = 0
    while n_bytes:
        if n_bytes & 1:
            crc = _times(_ZEROS[k], crc)
        n_bytes >>= 1
        k += 1
    return crc


def _shared(spark: SparkSession, share: np.ndarray) -> tuple:
    """The frequencies as tasks get them, with a name for what a worker keeps."""
    return uuid.uuid4().hex, spark.sparkContext.broadcast(share)


def _table(key: str, share) -> Frequencies:
    return kept_in_worker("frequencies", key, lambda: Frequencies.from_share(share.value))


# --- writing ---------------------------------------------------------------------------------


def _blocks_schema(id_type) -> StructType:
    return StructType(
        [
            *schema_of(part="int", block="int", first="long", n_ids="long").fields,
            StructField("ids", ArrayType(id_type)),
            *schema_of(places=["long"], starts=["long"], lengths=["long"], behind=["long"], data="binary").fields,
        ]
    )


_COUNTS = schema_of(token="long", n="long")
_SHARES = schema_of(share=["long"])


def _count(whole: DataFrame) -> DataFrame:
    """(token, n) over all documents; every task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, target = np.zeros(0, np.int64), to_arrow_schema(_COUNTS)
        for batch in batches:
            ids, n = b"".join(batch.column("ids").to_pylist()), sum(batch.column("n_tokens").to_pylist())
            if n:
                own = np.bincount(np.frombuffer(ids, f"<u{len(ids) // n}"), minlength=len(counts))
                own[: len(counts)] += counts
                counts = own
        found = np.flatnonzero(counts)
        yield as_batch({"token": pa.array(found), "n": pa.array(counts[found])}, target)

    return whole.select("n_tokens", "ids").mapInArrow(run, _COUNTS).groupBy("token").agg(F.sum("n").alias("n"))


def _encoder(id: str, schema: StructType, shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of the sorted documents of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(*shared)
        part, target = TaskContext.get().partitionId(), to_arrow_schema(schema)
        place = done = block = size = 0
        pieces: list[tuple] = []
        held: list[np.ndarray] = []

        def made() -> pa.RecordBatch:
            names = ("ids", "places", "starts", "lengths", "behind")
            ids = np.concatenate(held)
            row = {"part": [part], "block": [block], "first": [done], "n_ids": [len(ids)], "data": [encode(ids, table)]}
            return as_batch(row | {n: [list(v)] for n, v in zip(names, zip(*pieces))}, target)

        for batch in batches:
            for key, n, ids in zip(*(batch.column(c).to_pylist() for c in (id, "n_tokens", "ids"))):
                ids = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4")
                for start in range(0, n, BLOCK_IDS):
                    piece = ids[start : start + BLOCK_IDS]
                    if size and size + len(piece) > BLOCK_IDS:
                        yield made()
                        block, done, size, pieces, held = block + 1, done + size, 0, [], []
                    pieces.append((key, place, start, len(piece), n - start - len(piece)))
                    held.append(piece)
                    size += len(piece)
                place += 1
        if size:
            yield made()

    return run


def write(
    docs: DataFrame, path: str, folder: str | None = None, id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> str:
    """Writes the ids of all texts in ascending order of ``id`` and gives the folder, by default one below the shared folder."""
    spark = docs.sparkSession
    folder = folder or working_folder(spark, "token-files")
    whole = stored(tokenized(docs, path, id, text, end_id, CACHE_PIECES), "token-ids")
    counted = sorted(map(tuple, _count(whole).collect()))  # one row per id of the vocabulary at most
    ids, counts = (np.array([r[i] for r in counted], np.int64) for i in (0, 1))
    table = Frequencies.of(ids, counts)
    spark.createDataFrame([(table.share.tolist(),)], _SHARES).coalesce(1).write.parquet(f"{folder}/frequencies")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // PART_IDS))
    order = [F.asc_nulls_first(id), "part", "first"]
    placed = whole.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(id, "n_tokens", "ids")
    schema = _blocks_schema(docs.schema[id].dataType)
    shared = _shared(spark, table.share)
    coded = placed.mapInArrow(_encoder(id, schema, shared), schema)
    coded.write.option("compression", "zstd").parquet(f"{folder}/blocks")
    return folder


# --- reading -----------------------------------------------------------------------------------


def _opened(spark: SparkSession, folder: str):
    share = np.array(spark.read.parquet(f"{folder}/frequencies").first()[0], np.int64)
    return spark.read.parquet(f"{folder}/blocks"), _shared(spark, share)


def _decoded(blocks: DataFrame, shared, schema: StructType, piece: Callable) -> DataFrame:
    """One row of ``piece`` per piece of a document; blocks are decoded one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(*shared)
        target = to_arrow_schema(schema)
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
                ids = decode(row["data"], table)
                ends = list(accumulate(row["lengths"], initial=0))
                if len(ids) != row["n_ids"] or ends[-1] != len(ids):
                    raise Damaged(f"block {row['block']} of part {row['part']} has another number of ids")
                rows = [
                    piece(row["part"], row["first"] + at, *own, ids[at:end])
                    for at, end, *own in zip(ends, ends[1:], row["ids"], row["places"], row["starts"], row["behind"])
                ]
                yield as_batch(dict(zip(target.names, zip(*rows))), target)

    return blocks.mapInArrow(run, schema)


def _starts(spark: SparkSession, blocks: DataFrame) -> DataFrame:
    """(part, before): the ids of all parts before; the driver sees one number per part."""
    totals = sorted(map(tuple, blocks.groupBy("part").agg(F.sum("n_ids")).collect()))
    before = accumulate((n for _, n in totals), initial=0)
    return spark.createDataFrame([(p, b) for (p, _), b in zip(totals, before)], "part int, before long")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), piece_start, ids: one row per piece, nearly always a whole document."""
    blocks, shared = _opened(spark, folder)
    schema = StructType(
        [*schema_of(part="int", at="long", piece_start="long", ids=["long"]).fields, StructField("doc_id", blocks.schema["ids"].dataType.elementType)]
    )
    piece = lambda part, at, key, place, start, behind, ids: (part, at - start, start, ids.tolist(), key)
    found = _decoded(blocks, shared, schema, piece).join(_starts(spark, blocks), "part")
    return found.select("doc_id", (F.col("at") + F.col("before")).alias("start"), "piece_start", "ids")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 (of the ids as unsigned 32-bit numbers), from the files."""
    blocks, shared = _opened(spark, folder)
    schema = StructType(
        [*schema_of(part="int", place="long", at="long", n="long", crc="long").fields, StructField("doc_id", blocks.schema["ids"].dataType.elementType)]
    )

    def piece(part, at, key, place, start, behind, ids):
        return part, place, at - start, len(ids), moved(crc32(ids.tobytes()), 4 * behind), key

    whole = _decoded(blocks, shared, schema, piece).groupBy("part", "place").agg(
        F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"), F.min("doc_id").alias("doc_id")
    )
    return whole.join(_starts(spark, blocks), "part").select(
        "doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
