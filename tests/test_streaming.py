import pytest

from pledgeflow.operators import ingest, rules
from pledgeflow.streaming import guards
from tests.data import PLEDGES, backer, bag, creator, five_projects, rows, table


@pytest.fixture(scope="module")
def world(spark):
    tables = five_projects(spark)
    tables["backs"] = table(spark, "backs", PLEDGES)
    return tables


def run(spark, tmp_path, batches, guard):
    """Feed one file per micro-batch, in order; returns the sink."""
    source, sink = tmp_path / "in", str(tmp_path / "out")
    for n, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(batch.schema).parquet(str(source))
        guard(stream, sink).awaitTermination()
    return sink


def test_pledge_stream(spark, tmp_path, world):
    first = table(spark, "backs", [
        (backer(1), "gold", 1, "2021-10-07", None, 600), (backer(2), "gold", 1, "2020-10-07", None, 600), ("nobody", "gold", 1, "2021-10-07", None, 600),
    ])
    second = table(spark, "backs", [
        (backer(1), "gold", 1, "2021-10-08", None, 700), (backer(2), "gold", 1, "2021-10-07", None, 600), (backer(3), "tin", 1, "2021-10-07", None, 600),
    ])
    args = (world["projects"], world["rewards"], world["backers"])
    sink = run(spark, tmp_path, [first, second], lambda s, out: guards.guard_pledges(s, out, *args))
    got = guards.read_verdicts(spark, sink, first.schema)
    accepted = got.filter("verdict = 'accepted'")
    assert bag(accepted, "email", "batch_id") == [(backer(1), 0), (backer(2), 1)]
    assert bag(got.filter("batch_id = 0").drop("batch_id", "verdict")) == bag(rules.judge_pledges(first, *args))
    stored = accepted.filter("batch_id = 0").select(*first.columns)
    assert bag(got.filter("batch_id = 1").drop("batch_id", "verdict")) == bag(rules.judge_pledges(second, *args, stored))


def test_micro_batch_run_again_gives_the_same_rows(spark, tmp_path, world):
    batch = table(spark, "backs", [(backer(1), "gold", 1, "2021-10-07", None, 600)])
    guard = lambda s, out, **o: guards.guard_pledges(s, out, world["projects"], world["rewards"], world["backers"], **o)
    sink = run(spark, tmp_path, [batch], guard)
    # A fresh checkpoint replays the same files as batch 0 into the same sink.
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    guard(stream, sink, checkpoint=str(tmp_path / "again")).awaitTermination()
    assert bag(guards.read_verdicts(spark, sink, batch.schema), "email", "verdict") == [(backer(1), "accepted")]


def test_request_stream_sees_earlier_requests(spark, tmp_path, world):
    backs = table(spark, "backs", [(*p[:4], None, p[5]) for p in PLEDGES])
    changes = [
        table(spark, "request_changes", [(backer(6), 5, "2050-01-01"), (backer(3), 3, "2050-01-01")]),
        table(spark, "request_changes", [(backer(6), 5, "2021-01-01"), (backer(5), 5, "2021-01-01")]),
    ]
    sink = run(spark, tmp_path, changes, lambda s, out: guards.guard_request_changes(s, out, backs, world["projects"]))
    got = guards.read_verdicts(spark, sink, changes[0].schema)
    # The second change of backer 6 meets a request that is set by now, and goes unchecked.
    assert bag(got, "batch_id", "email", "verdict") == [
        (0, backer(3), "rejected"), (0, backer(6), "accepted"), (1, backer(5), "rejected"), (1, backer(6), "accepted"),
    ]


def test_refund_stream(spark, tmp_path, world):
    batches = [table(spark, "refunds", [(backer(3), 3, 1, "2022-12-01", True), (backer(5), 5, 1, "2022-12-01", True)])] * 2
    args = (world["backs"], world["projects"], world["employees"])
    sink = run(spark, tmp_path, batches, lambda s, out: guards.guard_refunds(s, out, *args))
    got = guards.read_verdicts(spark, sink, batches[0].schema)
    assert bag(got, "batch_id", "pid", "verdict") == [
        (0, 3, "accepted"), (0, 5, "rejected"), (1, 3, "rejected"), (1, 5, "rejected"),
    ]


def test_registration_and_project_streams(spark, tmp_path, world):
    people = [table(spark, "registrations", [("new", "n", "1", "2", "s", "9", "z", "SG", k), ("bad", "n", "1", "1", "s", "9", "z", "SG", k)]) for k in ("BOTH", "BACKER")]
    sink = run(spark, tmp_path / "r", people, lambda s, out: guards.guard_registrations(s, out, world))
    got = guards.read_verdicts(spark, sink, people[0].schema)
    assert bag(got.filter("verdict = 'accepted'"), "batch_id", "email") == [(0, "new")]
    assert bag(got.filter("batch_id = 0").drop("batch_id", "verdict")) == bag(ingest.judge_registrations(people[0], world))
    loads = [table(spark, "project_loads", [(70 + n, creator(1), "type1", "2021-10-01", "p", "2022-01-01", 5, ["a"] * n, [1] * n)]) for n in (0, 1, 1)]
    sink = run(spark, tmp_path / "p", loads, lambda s, out: guards.guard_project_loads(s, out, world))
    got = guards.read_verdicts(spark, sink, loads[0].schema)
    assert rows(got.orderBy("batch_id"), "id", "reason") == [
        (70, "No reward levels for project"), (71, None), (71, "duplicate key in projects: already stored"),
    ]


def test_replay_equals_batch(spark, world):
    args = (world["projects"], world["rewards"], world["backers"])
    got = guards.replay(world["backs"], "test", lambda s, out: guards.guard_pledges(s, out, *args), files_per_batch=1)
    assert bag(got) == bag(rules.judge_pledges(world["backs"], *args))


def test_replay_of_many_files_takes_few_batches(spark, world, tmp_path):
    args = (world["projects"], world["rewards"], world["backers"])
    sinks = []

    def start(stream, out):
        sinks.append(out)
        return guards.guard_pledges(stream, out, *args)

    many = spark.createDataFrame(world["backs"].collect() * 4, world["backs"].schema).repartition(20)
    guards.replay([many, many], "many", start)
    batches = {r[0] for r in guards.read_verdicts(spark, sinks[0], many.schema).select("batch_id").collect()}
    assert batches == set(range(6))


def _shuffles(spark):
    """Numbers of the shuffles whose files are there."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def test_steps_of_request_stream_leave_no_shuffles(spark, tmp_path, world):
    backs = world["backs"].repartition(2)
    changes = [table(spark, "request_changes", [(backer(n), 5, "2050-01-01"), (backer(3), 3, "2050-01-01")]) for n in (6, 5)]
    before, threshold = _shuffles(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run(spark, tmp_path, changes, lambda s, out: guards.guard_request_changes(s, out, backs, world["projects"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # one count per micro-batch, and none of the joins and sums
    assert len(_shuffles(spark) - before) <= len(changes)


def test_request_stream_with_pledges_stored_twice_and_nulls(spark, tmp_path, world):
    twice = [p for p in PLEDGES if p[0] == backer(6)] * 2 + [(None, *PLEDGES[0][1:])]
    backs = table(spark, "backs", [(*p[:4], None, p[5]) for p in [*PLEDGES, *twice]])
    changes = [table(spark, "request_changes", [(backer(6), 5, d), (None, 5, d), (backer(3), None, d)]) for d in ("2050-01-01", None)]
    sink = run(spark, tmp_path, changes, lambda s, out: guards.guard_request_changes(s, out, backs, world["projects"]))
    got = guards.read_verdicts(spark, sink, changes[0].schema)
    first = got.filter("batch_id = 0").drop("batch_id", "verdict")
    assert bag(first) == bag(rules.judge_request_changes(changes[0], backs, world["projects"]))
    assert bag(got.filter("batch_id = 1 AND email IS NOT NULL AND id IS NOT NULL"), "email", "verdict") == [(backer(6), "accepted")] * 3
