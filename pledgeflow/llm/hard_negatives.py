"""Hard negatives by Kronecker-packed products: exact integer scores of anchors against all rows.

Components become integers, ``floor(scale * x)``. Those of several candidates are made non-negative by a bias
and put into separated fields of one wide integer per dimension; a field is wide enough for a whole inner
product, so one multiplication per anchor component serves all candidates of the integer, and the fields
of the sum over dimensions hold their scores. The biases are taken off again, which gives exact scores.
If the fields fit the 53 bits that a double holds exactly, the integers of a block are such doubles and the
products one matrix product; wider fields are those of Python's integers.

Rows are dealt evenly into blocks, whatever their ids or labels, and so are the anchors. Each pair of a block and a
block of anchors is one group of a cogroup: a stated set of queries against all rows, in blocks. A pair gives the
best rows per anchor and, in a second run that knows the positives, per anchor and positive; a ranking over
the pairs keeps the best of all, cut down in every task before it is shuffled. Blocks are bounded by their
number of components (``BLOCK_VALUES``) and anchors (``ANCHOR_ROWS``), so memory doesn't grow with the table.

Defined cases: rows with a null label, a null vector or a component that is null or not finite (also after
scaling) take no part. A shorter vector is filled up with zeros. Repeated rows are rows of their own: a copy of an anchor is
one of its positives, and an anchor that is repeated is answered as often. A null id is no anchor unless the condition says so,
and comes last among equal scores. A score outside 64 bits counts as the nearest long. An anchor without positives, or a
positive without negatives, gives no rows; an empty table gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pledgeflow.llm.common import as_batch, schema_of, stored

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
#: Components of a block and its rows at least, anchors of a block, anchors whose scores are held at a time.
BLOCK_VALUES, LEAST_ROWS, ANCHOR_ROWS, TILE = 1 << 22, 2_048, 8_192, 32
#: Integers up to here are exact in a double.
EXACT_BITS = 53
_LONG = (1 << 63) - 1
_BLOCK = schema_of(
    block="long", rids="binary", ids=["long"], labels=["string"], anchors=["boolean"], dim="int", kind="string", data="binary"
)
_ROW = schema_of(rid="long", id="long", label="string", anchor="boolean", vector=["double"])
_BEST = schema_of(block="long", at="int", anchor_id="long", id="long", score="long")
_MINED = schema_of(
    rid="long", place="int", anchor_id="long", positive_id="long", negative_id="long", positive_score="long", negative_score="long"
)


# --- exact products ---------------------------------------------------------------


def field_bits(dim: int, a: int, c: int) -> int:
    """Bits of the largest sum of ``dim`` products of biased components up to 2a and 2c."""
    return (4 * dim * a * c).bit_length() or 1


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows: int64, or Python integers where these don't do."""
    dim = max(anchors.shape[1], candidates.shape[1])
    anchors, candidates = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in (anchors, candidates))
    a, c = (int(np.abs(m).max(initial=0)) for m in (anchors, candidates))
    bits = field_bits(dim, a, c)
    if bits <= EXACT_BITS:
        return _in_doubles(anchors.astype(np.float64), candidates.astype(np.float64), float(a), float(c), bits)
    return _in_integers(anchors, candidates, a, c, -(-bits // 8))


def _in_doubles(anchors: np.ndarray, candidates: np.ndarray, a: float, c: float, bits: int) -> np.ndarray:
    fields, n, dim = EXACT_BITS // bits, len(candidates), anchors.shape[1]
    fields = max(1, min(fields, n))
    width = -(-n // fields)
    packed = np.zeros((width, dim))
    for f in range(fields):
        own = candidates[f * width : (f + 1) * width]
        packed[: len(own)] += (own + c) * 2.0 ** (f * bits)
    sums = ((anchors + a) @ packed.T).astype(np.int64)
    scores = np.concatenate([sums >> (f * bits) & ((1 << bits) - 1) for f in range(fields)], axis=1)[:, :n]
    taken = (c * anchors.sum(axis=1) + dim * a * c).astype(np.int64)
    return scores - taken[:, None] - (a * candidates.sum(axis=1)).astype(np.int64)[None, :]


def _in_integers(anchors: np.ndarray, candidates: np.ndarray, a: int, c: int, width: int) -> np.ndarray:
    n, dim = len(candidates), anchors.shape[1]
    columns = [list(map(int, column)) for column in candidates.T]
    packed = [int.from_bytes(b"".join((x + c).to_bytes(width, "little") for x in column), "little") for column in columns]
    sums = [sum(row) for row in zip(*columns)]
    out = np.empty((len(anchors), n), object)
    for i, row in enumerate(anchors):
        own = list(map(int, row))
        total = sum((x + a) * p for x, p in zip(own, packed)).to_bytes(width * n, "little")
        taken = c * sum(own) + dim * a * c
        out[i] = [int.from_bytes(total[j * width : (j + 1) * width], "little") - taken - a * sums[j] for j in range(n)]
    return np.clip(out, -_LONG - 1, _LONG).astype(np.int64)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first; of equal ones the first places."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= cut)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places].astype(object) if (scores == -_LONG - 1).any() else -scores[places], kind="stable")][:k]


# --- blocks --------------------------------------------------------------------------


def _packed(rows: DataFrame, blocks: int, scale: float) -> DataFrame:
    """One block of each partition, its rows in the order of their ids; ``rid`` tells rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, number = to_arrow_schema(_BLOCK), TaskContext.get().partitionId()
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found).sort_by([("id", "ascending"), ("label", "ascending")])
        vectors = table.column("vector").combine_chunks()
        lengths, flat = vectors.value_lengths().to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False)
        flat, dim = np.floor(flat * scale), int(lengths.max())
        if (lengths == dim).all():
            values = flat.reshape(-1, dim)
        else:
            values = np.zeros((len(lengths), dim))
            values[np.arange(dim) < lengths[:, None]] = flat
        most = np.abs(values).max(initial=0)
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
        rids = table.column("rid").to_numpy() if not table.column("rid").null_count else (number << 32) + np.arange(table.num_rows)
        yield as_batch(
            {
                "block": [number], "rids": [rids.astype("<i8").tobytes()], "ids": [table.column("id").to_pylist()],
                "labels": [table.column("label").to_pylist()], "anchors": [table.column("anchor").to_pylist()],
                "dim": [dim], "kind": [kind], "data": [values.astype(kind).tobytes()],
            },
            target,
        )

    return rows.repartition(blocks).mapInArrow(run, _BLOCK)


class _Block:
    def __init__(self, row: dict):
        self.rids = np.frombuffer(row["rids"], "<i8")
        self.ids, self.labels = row["ids"], np.array(row["labels"], object)
        self.values = np.frombuffer(row["data"], row["kind"]).reshape(len(self.rids), row["dim"])
        self.anchors = row["anchors"]


def _anchor_rows(blocks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(_ROW)
        for batch in batches:
            for n in range(batch.num_rows):
                own = _Block(batch.slice(n, 1).to_pylist()[0])
                at = np.flatnonzero(own.anchors)
                rows = {
                    "rid": own.rids[at], "id": [own.ids[i] for i in at], "label": list(own.labels[at]),
                    "anchor": [True] * len(at), "vector": list(own.values[at].astype(np.float64)),
                }
                yield as_batch(rows, target)

    return blocks.mapInArrow(run, _ROW)


def _pairs(blocks: DataFrame, n_blocks: int, anchors: DataFrame, n_anchors: int, work: Callable, schema: StructType) -> DataFrame:
    """Each block with each block of anchors, one group each, through ``work(block, anchor block, row of the latter)``."""
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = blocks.withColumn("of", numbers(n_anchors))
    right = anchors.withColumnRenamed("block", "of").withColumn("block", numbers(n_blocks))

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        target = to_arrow_schema(schema)
        if not one.num_rows or not other.num_rows:
            return target.empty_table()
        row = other.to_pylist()[0]
        made = work(_Block(one.drop_columns(["of"]).to_pylist()[0]), _Block(row), row)
        names = target.names
        return pa.Table.from_batches([as_batch(dict(zip(names, zip(*made))) if made else {n: [] for n in names}, target)])

    keys = ("block", "of")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _tiles(block: _Block, anchors: _Block, wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the anchor, its scores with all rows of the block)."""
    numbers = np.arange(len(anchors.rids)) if wanted is None else wanted
    for first in range(0, len(numbers), TILE):
        some = numbers[first : first + TILE]
        yield from zip(some.tolist(), products(anchors.values[some], block.values))


def _best_positives(k: int) -> Callable:
    def work(block: _Block, anchors: _Block, row: dict) -> list[tuple]:
        alike = {label: np.flatnonzero(block.labels == label) for label in set(anchors.labels)}
        out = []
        for n, scores in _tiles(block, anchors):
            places = alike[anchors.labels[n]]
            places = places[block.rids[places] != anchors.rids[n]]
            own = scores[places]
            out += [(row["of"], n, anchors.ids[n], block.ids[places[i]], int(own[i])) for i in best(own, k)]
        return out

    return work


def _best_negatives(k: int, low: int, high: int) -> Callable:
    def work(block: _Block, anchors: _Block, row: dict) -> list[tuple]:
        wanted: dict[int, list[dict]] = {}
        for p in row["positives"]:
            wanted.setdefault(p["at"], []).append(p)
        other = {label: block.labels != label for label in set(anchors.labels)}
        out = []
        for n, scores in _tiles(block, anchors, np.array(sorted(wanted), np.int64)):
            differs, answers = other[anchors.labels[n]], {}
            for p in wanted[n]:
                score = p["score"]
                if score not in answers:
                    least, most = -(-low * score // 100), high * score // 100
                    places = np.flatnonzero((scores >= least) & (scores <= most) & differs) if least <= most else np.zeros(0, int)
                    answers[score] = [(block.ids[places[i]], int(scores[places[i]])) for i in best(scores[places], k)]
                head = (int(anchors.rids[n]), p["place"], anchors.ids[n], p["id"])
                out += [(*head, found, score, own) for found, own in answers[score]]
        return out

    return work


def mine(
    rows: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """Rows of other labels that score nearly as high with an anchor as rows of its own label do.

    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: of every row that meets
    the condition ``anchor``, its ``positives`` best other rows of the same label, and for each of these the ``negatives`` best
    rows of other labels with low/100 to high/100 of its score. Blocks and positives are stored when this is called.
    """
    x = F.col(vector)
    fits = F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) * F.lit(float(scale)) < F.lit(float("inf"))))
    valid = rows.filter(F.col(label).isNotNull() & x.isNotNull() & fits).select(
        F.lit(None).cast("long").alias("rid"), F.col(id).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), x.cast("array<double>").alias("vector"),
    )
    n, n_of, dim = valid.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max(F.size("vector"))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, -(-n * (dim or 1) // BLOCK_VALUES), min(-(-n // LEAST_ROWS), 2 * cores))
    n_anchors = max(1, -(-n_of // ANCHOR_ROWS), -(-n_of * (dim or 1) // BLOCK_VALUES))
    blocks = stored(_packed(valid, n_blocks, float(scale)), "vector-blocks")
    anchors = stored(_packed(_anchor_rows(blocks), n_anchors, 1.0), "anchor-blocks")

    found = _pairs(blocks, n_blocks, anchors, n_anchors, _best_positives(positives), _BEST)
    order = Window.partitionBy("block", "at").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    chosen = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    per_block = stored(
        chosen.groupBy("block").agg(F.collect_list(F.struct("at", "place", "id", "score")).alias("positives")), "positives"
    )
    asking = anchors.join(per_block, "block")
    mined = _pairs(blocks, n_blocks, asking, n_anchors, _best_negatives(negatives, low, high), _MINED)
    order = Window.partitionBy("rid", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    ranked = mined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
