"""Stream guards: each micro-batch is judged like a batch and stored with its verdicts.

A guard writes ``sink/batch_id=N/verdict=accepted|rejected``. The folder of a
micro-batch is overwritten as a whole, and a batch looks only at batches before
it, so a micro-batch that is run again after a failure gives the same files.
Keys taken in earlier micro-batches are found in an index of the sink (see ``key_index``), not
in stream state, and a micro-batch opens only the parts of it that its keys fall in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pledgeflow.operators import ingest, rules, verdicts
from pledgeflow.operators.joins import matching
from pledgeflow.plans.funding import project_totals
from pledgeflow.schema import TABLES
from pledgeflow.session import put_by, shuffles_freed, working_folder
from pledgeflow.streaming.key_index import BUCKET_ROWS, FAN, KeyIndex

Judge = Callable[[DataFrame, DataFrame], DataFrame]
#: A stored table, or a function that gives its present version; it is asked for every micro-batch.
Stored = DataFrame | Callable[[], DataFrame]


def _now(table: Stored) -> DataFrame:
    return table() if callable(table) else table


def read_verdicts(spark: SparkSession, sink: str, columns: T.StructType) -> DataFrame:
    """All rows of a guard's sink, with ``reason``, ``verdict`` and ``batch_id``."""
    stored = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in columns.fields]
        + [
            T.StructField("reason", T.StringType()),
            T.StructField("batch_id", T.LongType()),
            T.StructField("verdict", T.StringType()),
        ]
    )
    return spark.read.schema(stored).parquet(sink)


def _taken(before: DataFrame, stored: Stored | None, key: tuple[str, ...]) -> DataFrame:
    keys = before.select(*key)
    return keys if stored is None else keys.unionByName(_now(stored).select(*key))


def guard(
    stream: DataFrame, sink: str, judge: Judge, key: Sequence[str], carried: Sequence[str] = (),
    checkpoint: str | None = None, fan: int = FAN, bucket_rows: int = BUCKET_ROWS, **trigger,
) -> StreamingQuery:
    """Run ``judge(batch, accepted_before)`` on every micro-batch of ``stream``.

    ``accepted_before`` has the ``key``, the ``carried`` columns and ``batch_id`` of accepted rows; those whose key is not in
    the batch may be left out. ``trigger`` is passed on; by default the stream stops when it has caught up.
    """
    columns = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema.fields])
    index = KeyIndex(stream.sparkSession, sink, columns, key, carried, fan, bucket_rows)

    def store(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            # Once held, Spark knows the bytes of a micro-batch: it broadcasts a small
            # one to the stored tables and shuffles neither.
            held.count()
            before = index.before(held, batch_id)
            with shuffles_freed(held.sparkSession):
                verdicts.write_judged(judge(held, before), f"{sink}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint or f"{sink}-checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def guard_pledges(
    stream: DataFrame, sink: str, projects: Stored, rewards: Stored, backers: Stored,
    stored: Stored | None = None, hot: rules.Hot = None, **options,
) -> StreamingQuery:
    """Pledges under all pledge rules. Of stored tables only the rows that the micro-batch names go on."""

    def judge(batch: DataFrame, before: DataFrame) -> DataFrame:
        taken = _taken(before, stored, TABLES["backs"].key)
        return rules.judge_pledges(
            batch,
            matching(_now(projects), batch, ["id"]),
            matching(_now(rewards), batch, ["id", "name"]),
            matching(_now(backers), batch, ["email"]),
            taken,
            hot,
        )

    return guard(stream, sink, judge, TABLES["backs"].key, **options)


def guard_refunds(
    stream: DataFrame, sink: str, backs: Stored, projects: Stored, employees: Stored,
    stored: Stored | None = None, hot: rules.Hot = None, **options,
) -> StreamingQuery:
    """Refund decisions under the decision rule and the table's constraints."""

    def judge(batch: DataFrame, before: DataFrame) -> DataFrame:
        taken = _taken(before, stored, TABLES["refunds"].key)
        named = batch.select(F.col("pid").alias("id"))
        staff = batch.select(F.col("eid").alias("id"))
        return rules.judge_refunds(
            batch, _now(backs), matching(_now(projects), named, ["id"]), matching(_now(employees), staff, ["id"]), taken, hot
        )

    return guard(stream, sink, judge, TABLES["refunds"].key, **options)


def guard_request_changes(
    stream: DataFrame, sink: str, backs: Stored, projects: Stored,
    lock_existing: bool = False, totals: Stored | None = None, hot: rules.Hot = None, **options,
) -> StreamingQuery:
    """Refund requests, seen against the requests set by earlier micro-batches.

    ``totals`` may hold stored ``project_totals``; without, the pledges of the named projects are added up. These sums and the
    pledges named are stored beside the sink, in the place of those of the micro-batch before, so that the shuffles of one
    step are gone when the next begins.
    """
    keys = ["email", "id"]

    def judge(batch: DataFrame, before: DataFrame) -> DataFrame:
        latest = matching(before, batch, keys).groupBy(*keys).agg(
            F.max_by("new_request", "batch_id").alias("new_request")
        )
        pledges = _now(backs)
        if totals is None:
            sums = put_by(project_totals(matching(pledges, batch, ["id"])), f"{sink}-step/totals")
        else:
            sums = matching(_now(totals), batch, ["id"])
        current = put_by(rules.named_pledges(batch, pledges, latest), f"{sink}-step/pledges")
        return rules.judge_request_changes(
            batch, pledges, matching(_now(projects), batch, ["id"]), lock_existing, sums, hot, current
        )

    return guard(stream, sink, judge, keys, ["new_request"], **options)


def guard_registrations(stream: DataFrame, sink: str, tables: Mapping[str, Stored], **options) -> StreamingQuery:
    """Registrations; a micro-batch is complete in itself, as one transaction was."""

    def judge(batch: DataFrame, before: DataFrame) -> DataFrame:
        taken = {name: matching(_now(tables[name]), batch, ["email"]) for name in ("users", "backers", "creators")}
        taken["users"] = taken["users"].select("email").unionByName(before.select("email"))
        return ingest.judge_registrations(batch, taken)

    return guard(stream, sink, judge, ["email"], **options)


def guard_project_loads(stream: DataFrame, sink: str, tables: Mapping[str, Stored], **options) -> StreamingQuery:
    """Project loads with their rewards."""

    def judge(batch: DataFrame, before: DataFrame) -> DataFrame:
        taken = {
            "creators": matching(_now(tables["creators"]), batch, ["email"]),
            "project_types": matching(_now(tables["project_types"]), batch.select(F.col("ptype").alias("name")), ["name"]),
            "projects": matching(_now(tables["projects"]), batch, ["id"]).select("id").unionByName(before.select("id")),
        }
        return ingest.judge_project_loads(batch, taken)

    return guard(stream, sink, judge, ["id"], **options)


def replay(
    rows: DataFrame | Sequence[DataFrame],
    name: str,
    start: Callable[[DataFrame, str], StreamingQuery],
    files_per_batch: int = 4,
    most_batches: int = 3,
) -> DataFrame:
    """Store ``rows`` in the shared folder, stream them through a guard, return all verdicts.

    This runs the stream to its end. It serves backfills and checks: the
    verdicts are those of the batch job wherever rows do not compete for a key. Several
    DataFrames are streamed in turn: the rows of one come in later micro-batches than those before it.

    A micro-batch takes ``files_per_batch`` files, or as many more as keep a DataFrame within ``most_batches``: each micro-batch
    reads the stored tables, so with a fixed number of files the work would grow with the square of the rows.
    """
    parts = [rows] if isinstance(rows, DataFrame) else list(rows)
    schema, spark = parts[0].schema, parts[0].sparkSession
    folder, before = working_folder(spark, f"replay-{name}"), 0
    for part in parts:
        with shuffles_freed(spark):
            part.write.mode("append").option("compression", "zstd").parquet(f"{folder}/in")
        files = len(spark.read.schema(schema).parquet(f"{folder}/in").inputFiles())
        taken, before = max(files_per_batch, -(-(files - before) // most_batches)), files
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", taken).parquet(f"{folder}/in")
        start(stream, f"{folder}/out").awaitTermination()
    return read_verdicts(spark, f"{folder}/out", schema).drop("batch_id", "verdict")
