"""The keys that earlier micro-batches accepted, in runs of hash-bucketed files.

A sink grows by one folder per micro-batch. The index folds ``fan`` of them into a run, ``fan`` runs into a
larger one and so on; which runs stand for the batches before batch N follows from the digits of N to the base ``fan``. So
there are at most ``fan - 1`` runs of each size and ``fan - 1`` folders not folded yet, whatever N is, and a key is
rewritten once per size. A run holds one row per key, the one of the latest batch, in buckets of the
hash of the key; there are so many that a bucket holds ``bucket_rows`` rows or less, on average, or ``MOST_BUCKETS``. A micro-batch
opens only the buckets its own keys fall in.

Every run has a manifest, which is written when its files are complete and names the buckets that exist. A run is a
function of the sink alone, and the one that ends at batch N is written anew whenever batch N starts, so a micro-batch that
is run again gives the same files and a replay with other data leaves no stale keys behind. A run that is missing, as
the sink is older than the index, is built from the folders it stands for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN, BUCKET_ROWS = 16, 1_000_000
#: A batch whose keys fall in more buckets than this opens all of them.
PRUNED_BUCKETS = 4_096
#: A run has so many buckets at most: each is a folder, which a lookup lists and a larger run writes anew.
MOST_BUCKETS = 256

_MANIFEST = T.StructType(
    [T.StructField("rows", T.LongType()), T.StructField("buckets", T.LongType()), T.StructField("present", T.ArrayType(T.LongType()))]
)

Run = tuple[int, int]


def runs_before(batch_id: int, fan: int = FAN) -> tuple[list[Run], int]:
    """The runs ``[first, last)`` that stand for the batches before ``batch_id``, and the first batch that is in none."""
    size, at, out = fan, 0, []
    while size * fan <= batch_id:
        size *= fan
    while size >= fan:
        while at + size <= batch_id:
            out.append((at, at + size))
            at += size
        size //= fan
    return out, at


@dataclass
class KeyIndex:
    """``columns`` are those of the stream; ``carried`` ones are kept beside the key."""

    spark: SparkSession
    sink: str
    columns: T.StructType
    key: Sequence[str]
    carried: Sequence[str] = ()
    fan: int = FAN
    bucket_rows: int = BUCKET_ROWS
    _manifests: dict[Run, tuple[int, int, list[int]]] = field(default_factory=dict)

    @property
    def kept(self) -> list[str]:
        return [*self.key, *self.carried]

    @property
    def folder(self) -> str:
        return f"{self.sink}-keys"

    def _row_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, self.columns[c].dataType, True) for c in self.kept] + [T.StructField("batch_id", T.LongType())]
        )

    def _hash(self, buckets: int):
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets))

    # --- what is stored

    def _unfolded(self, first: int, last: int) -> DataFrame | None:
        """Accepted rows of micro-batches; each has a folder, if only an empty one."""
        if first >= last:
            return None
        schema = T.StructType([*self._row_schema().fields, T.StructField("verdict", T.StringType())])
        paths = [f"{self.sink}/batch_id={n}" for n in range(first, last)]
        read = self.spark.read.schema(schema).option("basePath", self.sink).parquet(*paths)
        return read.filter("verdict = 'accepted'").drop("verdict")

    def _run_path(self, run: Run) -> str:
        return f"{self.folder}/runs/{run[0]}-{run[1]}"

    def _read_run(self, run: Run, buckets: Sequence[int] | None = None) -> DataFrame | None:
        _, _, present = self._manifest(run)
        wanted = present if buckets is None else sorted(set(present).intersection(buckets))
        if not wanted:
            return None
        path = self._run_path(run)
        schema = T.StructType([*self._row_schema().fields, T.StructField("bucket", T.LongType())])
        read = self.spark.read.schema(schema).option("basePath", path)
        return read.parquet(*(f"{path}/bucket={b}" for b in wanted)).drop("bucket")

    def _manifest(self, run: Run) -> tuple[int, int, list[int]]:
        if run not in self._manifests:
            try:
                found = self.spark.read.schema(_MANIFEST).parquet(f"{self.folder}/manifests/{run[0]}-{run[1]}").first()
            except AnalysisException:
                found = None
            if found is None:
                return self._write_run(run)
            self._manifests[run] = tuple(found)
        return self._manifests[run]

    def _write_run(self, run: Run) -> tuple[int, int, list[int]]:
        first, last = run
        # the runs the batch before saw; a run of the smallest size has none
        smaller, at = runs_before(last - 1, self.fan)
        parts = [self._read_run(r) for r in smaller if r[0] >= first]
        parts.append(self._unfolded(max(first, at), last))
        rows = reduce(DataFrame.unionByName, [p for p in parts if p is not None])
        latest = rows.groupBy(*self.key).agg(
            *(F.max_by(c, "batch_id").alias(c) for c in self.carried), F.max("batch_id").alias("batch_id")
        )
        most = rows.count()  # not fewer than there are keys
        buckets = 1
        while buckets < MOST_BUCKETS and buckets * self.bucket_rows < most:
            buckets *= 2
        placed = latest.withColumn("bucket", self._hash(buckets))
        placed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._run_path(run))
        schema = T.StructType([*self._row_schema().fields, T.StructField("bucket", T.LongType())])
        written = self.spark.read.schema(schema).parquet(self._run_path(run)).groupBy("bucket").count().collect()
        made = sum(r["count"] for r in written), buckets, sorted(r["bucket"] for r in written)
        manifest = self.spark.createDataFrame([made], _MANIFEST)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifests/{first}-{last}")
        self._manifests[run] = made
        return made

    # --- what a micro-batch sees

    def before(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows that earlier micro-batches accepted, with ``batch_id``, among them all with a key of ``batch``.

        Folds the micro-batches that fill a run at ``batch_id``, and looks up the buckets of the batch's keys, when called.
        """
        runs, at = runs_before(batch_id, self.fan)
        if runs and at == batch_id:
            self._write_run(runs[-1])
        parts = []
        if runs:
            most = max(self._manifest(run)[1] for run in runs)
            found = batch.select(self._hash(most).alias("b")).distinct().limit(PRUNED_BUCKETS + 1).collect()
            for run in runs:
                # numbers of buckets are powers of two, so the larger hash tells the smaller one
                wanted = {r["b"] % self._manifest(run)[1] for r in found} if len(found) <= PRUNED_BUCKETS else None
                parts.append(self._read_run(run, wanted))
        parts.append(self._unfolded(at, batch_id))
        parts = [p for p in parts if p is not None]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self._row_schema())
