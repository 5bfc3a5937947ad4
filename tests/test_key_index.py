"""The index of accepted keys: whole answers, flat reads, the same files when run again."""

import os
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from pledgeflow.streaming import guards, key_index
from pledgeflow.streaming.key_index import KeyIndex, runs_before
from tests.data import PLEDGES, bag, five_projects, table

COLUMNS = T.StructType([T.StructField("email", T.StringType()), T.StructField("id", T.LongType()), T.StructField("request", T.StringType())])


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_runs_cover_each_earlier_batch_once(fan):
    for batch_id in range(300):
        runs, at = runs_before(batch_id, fan)
        covered = [n for first, last in runs for n in range(first, last)] + list(range(at, batch_id))
        assert covered == list(range(batch_id)) and batch_id - at < fan
        sizes = [last - first for first, last in runs]
        assert sizes == sorted(sizes, reverse=True) and all(sizes.count(s) < fan for s in sizes)


def store(sink, batch_id, rows, verdict="accepted"):
    folder = f"{sink}/batch_id={batch_id}/verdict={verdict}"
    os.makedirs(folder, exist_ok=True)
    columns = {name: [r[i] for r in rows] for i, name in enumerate(COLUMNS.names)}
    schema = pa.schema([("email", pa.string()), ("id", pa.int64()), ("request", pa.string()), ("reason", pa.string())])
    pq.write_table(pa.table({**columns, "reason": [None] * len(rows)}, schema), f"{folder}/part.parquet")


def opened(df):
    return sum(os.path.getsize(urlparse(f).path) for f in df.inputFiles())


def snapshot(folder):
    found = {}
    for root, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                table_ = pq.read_table(os.path.join(root, name), partitioning=None)
                found.setdefault(os.path.relpath(root, folder), []).extend(sorted(map(repr, table_.to_pylist())))
    return {k: sorted(v) for k, v in found.items()}


def test_reads_stay_flat_over_200_batches(spark, tmp_path):
    sink, fan, per_batch = str(tmp_path / "sink"), 4, 60
    index = KeyIndex(spark, sink, COLUMNS, ["email", "id"], fan=fan, bucket_rows=40)
    read, known = {}, {}
    for n in range(200):
        asked = [("e%d" % (k % 997), k) for k in (n * 7, n * per_batch // 2, 10**9)]
        batch = spark.createDataFrame([(*a, None) for a in asked], COLUMNS)
        if n % fan == 0 or n % 9 == 1:
            before = index.before(batch, n)
            read[n] = opened(before)
            if n % 20 == 1 or n == 196:
                got = {(r["email"], r["id"]): r["batch_id"] for r in before.collect()}
                assert {a for a in asked if a in known} <= set(got)
                assert all(known[k] == b for k, b in got.items())
        rows = [("e%d" % (k % 997), k, None) for k in range(n * per_batch, (n + 1) * per_batch)]
        store(sink, n, rows)
        store(sink, n, [("never", n, None)], "rejected")
        known.update({r[:2]: n for r in rows})
    early, late = max(v for n, v in read.items() if 10 <= n < 64), max(v for n, v in read.items() if n >= 136)
    assert late < 2 * early
    everything = sum(os.path.getsize(f"{sink}/batch_id={n}/verdict=accepted/part.parquet") for n in range(200))
    assert late < everything / 4


def test_the_latest_batch_of_a_key_is_kept(spark, tmp_path):
    sink = str(tmp_path / "sink")
    for n, request in enumerate(["a", "b", None, "d"]):
        store(sink, n, [("x", 1, request), ("y", n, None)])
    for n in (4, 6):
        if n == 6:
            store(sink, 4, [])
            store(sink, 5, [("x", 1, "f")])
        index = KeyIndex(spark, sink, COLUMNS, ["email", "id"], ["request"], fan=2)
        got = index.before(spark.createDataFrame([("x", 1, None)], COLUMNS), n).filter("email = 'x'")
        assert bag(got) == ([("x", 1, "d", 3)] if n == 4 else [("x", 1, "d", 3), ("x", 1, "f", 5)])


def test_an_index_is_the_same_when_built_late_or_again(spark, tmp_path):
    late, steady = str(tmp_path / "late"), str(tmp_path / "steady")
    batch = spark.createDataFrame([("e1", 1, None)], COLUMNS)
    for sink in (late, steady):
        index = KeyIndex(spark, sink, COLUMNS, ["email", "id"], fan=2, bucket_rows=3)
        for n in range(7):
            if sink == steady:
                index.before(batch, n)
            store(sink, n, [(f"e{k}", k, None) for k in range(3 * n, 3 * n + 3)])
    assert bag(KeyIndex(spark, late, COLUMNS, ["email", "id"], fan=2, bucket_rows=3).before(batch, 7).filter("id = 1")) == [("e1", 1, 0)]
    for run in ("0-4", "4-6"):
        assert snapshot(f"{late}-keys/runs/{run}") == snapshot(f"{steady}-keys/runs/{run}")
    before = snapshot(f"{steady}-keys")
    KeyIndex(spark, steady, COLUMNS, ["email", "id"], fan=2, bucket_rows=3).before(batch, 6)
    assert snapshot(f"{steady}-keys") == before


def test_other_data_leave_no_stale_keys(spark, tmp_path):
    sink = str(tmp_path / "sink")
    batch = spark.createDataFrame([("old", 1, None), ("new", 1, None)], COLUMNS)
    for email in ("old", "new"):
        for n in range(2):
            store(sink, n, [(email, 1, None)])
        got = KeyIndex(spark, sink, COLUMNS, ["email", "id"], fan=2).before(batch, 2)
        assert bag(got) == [(email, 1, 1)]


def test_returning_keys_through_a_guard(spark):
    world = five_projects(spark)
    pledges = table(spark, "backs", PLEDGES)
    start = lambda s, out: guards.guard_pledges(s, out, world["projects"], world["rewards"], world["backers"], fan=2)
    once = guards.replay(pledges, "once", start)
    got = guards.replay([pledges.coalesce(1)] * 5, "returning", start, files_per_batch=1)
    want = bag(once)
    stored = [(*r[:-1], r[-1] or "duplicate key in backs: already stored") for r in want]
    assert bag(got) == sorted(want + stored * 4, key=repr)


def test_buckets_of_a_run_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_BUCKETS", 4)
    sink = str(tmp_path / "sink")
    for n in range(2):
        store(sink, n, [(f"e{k}", k, None) for k in range(50 * n, 50 * n + 50)])
    index = KeyIndex(spark, sink, COLUMNS, ["email", "id"], fan=2, bucket_rows=1)
    batch = spark.createDataFrame([("e7", 7, None)], COLUMNS)
    assert bag(index.before(batch, 2).filter("id = 7")) == [("e7", 7, 0)]
    assert len([f for f in os.listdir(f"{sink}-keys/runs/0-2") if f.startswith("bucket=")]) == 4
