"""SimHash near-dedup with BK-trees: fingerprints that differ in few bits are linked.

Equal fingerprints are united first. Of two fingerprints within ``radius`` bits at
least two of ``radius + 2`` bit blocks are equal, so every fingerprint goes to one
shard per pair of blocks, keyed by their bits, and each link lies in some shard. A
shard is a BK-tree: children are keyed by the Hamming distance to their parent, and
only edges within the radius are followed. Shards come to their queries by a
shuffle; a broadcast of all trees would grow with the corpus.

A tree also knows the components found in it: a subtree that lies as a whole in the
query's component is skipped. So a group of thousands of near copies costs little more
than one walk per member, and a shard gives at most one link per fingerprint, not all pairs.

Bounds: a shard holds ``TREE_ROWS`` fingerprints at most; a larger one is cut into several
trees, and its fingerprints ask every one of them. Components are joined by
alternating stars on DataFrames, each round stored in the shared folder.

Defined cases: null and empty texts have fingerprint zero, linked like any other;
null ids take part, but name a component only if it has no other id; repeated
rows are one node of the graph and each get a result; an empty table gives an empty
result; columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from pledgeflow.llm.common import Rows, arrow_pass, as_batch, stored, with_columns, words

SHINGLE, RADIUS, BITS, SEED = 3, 3, 64, 42
TREE_ROWS = 50_000
#: Shingles whose bits are counted at a time; texts that are Python objects at a time.
CHUNK, TEXTS = 50_000, 500
_FINGERPRINT = StructType([StructField("fingerprint", LongType())])
_LINKS = StructType([StructField("a", LongType()), StructField("b", LongType())])


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The bits set in over half of the shingles' hashes, unsigned."""
    found = words(text)
    shingles = map(b" ".join, zip(*(found[i:] for i in range(size)))) if len(found) >= size else iter([b" ".join(found)] if found else [])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), ">u8")
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), CHUNK):
        counts += np.unpackbits(hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``, the 64 bits as a signed long."""

    def start() -> Callable[[pa.RecordBatch], Rows]:
        return lambda batch: {"fingerprint": _fingerprints(batch.column(text))}

    return with_columns(docs, _FINGERPRINT, start)


def _fingerprints(texts: pa.Array) -> pa.Array:
    made = [fingerprint(t) for a in range(0, len(texts), TEXTS) for t in texts.slice(a, TEXTS).to_pylist()]
    return pa.array(np.array(made, np.uint64).view(np.int64))


def _marked(rows: DataFrame, column: str, texts: Callable[[pa.RecordBatch], pa.Array]) -> DataFrame:
    """``column`` of the rows and the fingerprint of their texts; nothing else comes back from Python."""

    def start() -> Callable[[pa.RecordBatch], Rows]:
        return lambda batch: {column: batch.column(column), "fingerprint": _fingerprints(texts(batch))}

    return arrow_pass(rows, StructType([rows.schema[column], *_FINGERPRINT.fields]), start)


class BKTree:
    """Fingerprints by distance to their parent, and the components that links within ``radius`` make."""

    def __init__(self, radius: int):
        self.radius, self.codes, self.children = radius, [], []
        self.above: list[int] = []  # union-find over the nodes
        self.whole: list[bool] = []  # the subtree lies in one component

    def component(self, node: int) -> int:
        above = self.above
        while above[node] != node:
            above[node] = node = above[above[node]]
        return node

    def linked(self, code: int) -> set[int]:
        """A node of each component that has one within the radius."""
        out: set[int] = set()
        todo = [0] if self.codes else []
        while todo:
            node = todo.pop()
            if out and self.whole[node] and self.component(node) in out:
                continue
            distance = (code ^ self.codes[node]).bit_count()
            if distance <= self.radius:
                out.add(self.component(node))
            low, high = distance - self.radius, distance + self.radius
            todo += [child for edge, child in self.children[node].items() if low <= edge <= high]
        return out

    def add(self, code: int) -> None:
        """Put in a code and unite the components it links."""
        near = self.linked(code)
        new = len(self.codes)
        root = min(near, default=new)
        self.codes.append(code)
        self.children.append({})
        self.above.append(root)
        self.whole.append(True)
        for node in near:
            self.above[node] = root
        node = 0
        while node != new:
            self.whole[node] = self.whole[node] and self.component(node) == root
            node = self.children[node].setdefault((code ^ self.codes[node]).bit_count(), new)

    def links(self) -> Iterator[tuple[int, int]]:
        """One link per node that is not its component's root."""
        for node, code in enumerate(self.codes):
            if (root := self.component(node)) != node:
                yield code, self.codes[root]


def _shard_keys(radius: int) -> list[Column]:
    """A key for each pair of bit blocks: the number of the pair and the two blocks' bits."""
    blocks = radius + 2
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    bits = [
        F.shiftrightunsigned("fingerprint", a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:])
    ]
    width = max(b - a for a, b in zip(cuts, cuts[1:]))
    return [
        F.shiftleft(F.shiftleft(F.lit(n).cast("long"), width).bitwiseOR(bits[a]), width).bitwiseOR(bits[b])
        for n, (a, b) in enumerate(combinations(range(blocks), 2))
    ]


def near_links(distinct: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all those within ``radius`` bits, directly or by others."""
    keyed = distinct.select("fingerprint", F.explode(F.array(*_shard_keys(radius))).alias("shard"))
    large = (
        keyed.groupBy("shard").count().filter(F.col("count") > tree_rows)
        .select("shard", F.ceil(F.col("count") / tree_rows).cast("int").alias("trees"))
    )
    trees = F.coalesce("trees", F.lit(1))
    placed = (
        keyed.join(large, "shard", "left")
        .withColumn("own", F.pmod(F.xxhash64("fingerprint"), trees).cast("int"))
        .withColumn("tree", F.explode(F.sequence(F.lit(0), trees - 1)))
        .select("shard", "tree", (F.col("own") == F.col("tree")).alias("member"), "fingerprint")
    )
    ordered = placed.repartition("shard", "tree").sortWithinPartitions("shard", "tree", F.desc("member"), "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, at, tree = to_arrow_schema(_LINKS), None, BKTree(radius)
        for batch in batches:
            out: list[tuple[int, int]] = []
            shards, parts = (batch.column(n).to_numpy() for n in ("shard", "tree"))
            member = batch.column("member").to_numpy(zero_copy_only=False)
            codes = batch.column("fingerprint").to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.r_[True, (shards[1:] != shards[:-1]) | (parts[1:] != parts[:-1])])
            for a, b in zip(starts, [*starts[1:], len(shards)]):
                if at != (key := (int(shards[a]), int(parts[a]))):
                    out += tree.links()
                    at, tree = key, BKTree(radius)
                for code, of in zip(codes[a:b].tolist(), member[a:b].tolist()):
                    if of:
                        tree.add(code)
                    else:
                        out += [(code, tree.codes[n]) for n in tree.linked(code)]
            yield _links(out, target)
        yield _links(list(tree.links()), target)

    return ordered.mapInArrow(run, _LINKS)


def _links(pairs: list[tuple[int, int]], target: pa.Schema) -> pa.RecordBatch:
    both = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return as_batch({"a": pa.array(both[:, 0]), "b": pa.array(both[:, 1])}, target)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link.

    Large and small stars in turn, until a round changes nothing; rounds grow with the logarithm of the longest chain.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = _state(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.filter("u <> v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        edges = stored(small.filter("u <> v").distinct(), "small-star")
        before, state = state, _state(edges)
        if before == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1_000_003)).first())


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component_id, root, n_rows): of each distinct fingerprint, the smallest id of its component,
    the fingerprint that stands for the component, and the number of its own rows.

    Fingerprints and links are computed and stored when called.
    """
    named_texts = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    marks = _marked(named_texts, "__id", lambda batch: batch.column("__text"))
    distinct = stored(
        marks.groupBy("fingerprint").agg(F.min("__id").alias("__id"), F.count(F.lit(1)).alias("n_rows")), "fingerprints"
    )
    roots = components(near_links(distinct.select("fingerprint"), radius))
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "__id", "n_rows", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("__id").alias("component_id"))
    return rooted.join(named, "root").select("fingerprint", "component_id", "root", "n_rows")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with ``fingerprint`` and ``component_id``."""
    of = groups(docs, id, text, radius).select("fingerprint", "component_id")
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "component_id"])
    return with_fingerprint(docs, text).join(of, "fingerprint")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each component, with the smallest id in it; the columns of ``docs``.

    Rows that share this id and the component tie; which of them stays is not promised.
    """
    of = groups(docs, id, text, radius).select("fingerprint", "component_id", "root")
    # the row goes through Python as it is, its text not a second time beside it
    place = [c.lower() for c in docs.columns].index(text.lower())
    held = docs.select(F.struct(*docs.columns).alias("__row"))
    marked = _marked(held, "__row", lambda batch: batch.column("__row").field(place)).join(of, "fingerprint")
    first = marked.filter(F.col("__row").getField(id).eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["root"]).select("__row.*")
