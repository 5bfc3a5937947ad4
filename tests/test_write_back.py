"""Stored versions: only files that hold a changed row are rewritten, and the rows are those of the plain changes."""

import random

import pytest
from pyspark.sql import functions as F

from pledgeflow.operators import cascade, maintenance, write_back
from pledgeflow.plans import funding, maintained
from pledgeflow.sources.versions import Change, Store
from tests.data import PLEDGES, backer, bag, creator, days_after, five_projects, table


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def many_pledges(spark, n=1000):
    return table(spark, "backs", [(f"e{i:04}", "gold", i % 7, "2021-10-07", None, 100 + i) for i in range(n)])


def test_ten_keys_in_a_hundred_files(spark, store):
    backs = many_pledges(spark).repartitionByRange(100, "email")
    store.create({"backs": backs})
    before = store.files("backs")
    changes = table(spark, "request_changes", [(f"e{i:04}", i % 7, "2022-01-01") for i in range(5, 1000, 100)] + [("nobody", 1, None)])
    gone = write_back.update_requests(store, changes)["backs"]
    after = store.files("backs")
    assert len(before) == 100 and 0 < len(gone) <= 10 and len(after) <= 100
    assert set(before) - set(after) == set(gone) and len(set(after) - set(before)) <= 10
    assert bag(store.read("backs")) == bag(maintenance.apply_request_updates(backs, changes))
    assert bag(store.read("backs", 0)) == bag(backs)  # readers of the version before


def test_changes_that_concern_nothing_rewrite_nothing(spark, store):
    store.create({"backs": many_pledges(spark, 20)})
    before = store.files("backs")
    assert write_back.update_requests(store, table(spark, "request_changes", [("nobody", 1, None), (None, None, None)])) == {"backs": []}
    assert store.files("backs") == before and store.version() == 1
    write_back.append(store, {"backs": many_pledges(spark, 3)})
    assert set(before) < set(store.files("backs")) and store.read("backs").count() == 23


def test_key_changes_and_deletes_follow_references(spark, store):
    world = {name: df for name, df in five_projects(spark).items()}
    world["backs"] = table(spark, "backs", PLEDGES)
    world["updates"] = table(spark, "updates", [("2021-10-05 00:00:00", i, "m") for i in (1, 3, 3)])
    world["refunds"] = table(spark, "refunds", [(backer(3), 3, 1, "2022-12-01", True)])
    for name in ("verifies", "employees", "project_types"):
        world.setdefault(name, table(spark, name))
    store.create(world)
    mapping = spark.createDataFrame([(creator(1), "new@x"), (backer(1), "b@x"), ("no", "no2")], "old_value string, new_value string")
    want = cascade.cascade_key_update(world, "users", "email", mapping, force=True)
    write_back.update_keys(store, "users", "email", mapping, force=True)
    assert store.version() == 1
    for name, df in world.items():
        assert bag(store.read(name)) == bag(want.get(name, df)), name
    deletes = spark.createDataFrame([(3,), (99,)], "id long")
    world = {name: store.read(name) for name in world}
    want = cascade.cascade_delete(world, "projects", deletes)
    write_back.delete_rows(store, "projects", deletes)
    for name, df in world.items():
        assert bag(store.read(name)) == bag(want.get(name, df)), name
    emails = spark.createDataFrame([(backer(2),), (backer(2),)], "email string")
    want = maintenance.delete_users({name: store.read(name) for name in world}, emails)
    write_back.delete_users(store, emails)
    for name, df in want.items():
        assert bag(store.read(name)) == bag(df)


def test_versions_tags_and_two_writers(spark, store):
    assert store.version() == -1
    store.create({"a": spark.range(5).toDF("id")})
    store.create({"b": spark.range(0).toDF("id")})
    assert store.version() == 1 and store.read("a").count() == 5 and store.read("b").count() == 0
    for _ in range(2):
        write_back.append(store, {"a": spark.range(2).toDF("id")}, tag="batch 7")
    assert store.version() == 2 and store.read("a").count() == 7
    entries, _ = store._manifest(1)
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        store._publish(2, entries, None)


def test_buckets_are_looked_up_alone(spark, store):
    rows = spark.range(400).select("id", F.lit(1).alias("n"))
    store.create({"t": rows}, {"t": (["id"], 16)})
    before = store.files("t")
    gone = store.apply({"t": Change([spark.createDataFrame([(7,)], "id int")], lambda df: df.withColumn("n", F.lit(2)))})
    assert len(gone["t"]) == 1 and len(set(before) & set(store.files("t"))) == len(before) - 1
    assert store.read("t").count() == 400


@pytest.mark.parametrize("seed", [1, 2])
def test_maintained_sums_equal_a_full_count(spark, store, seed):
    r = random.Random(seed)
    world = five_projects(spark)
    some = lambda n: [(f"e{r.random()}", "gold", r.randint(1, 5), days_after("2021-10-01", r.randint(0, 6)), None, r.randint(1, 10**6)) for _ in range(n)]
    now = some(30)
    maintained.create(store, table(spark, "backs", now), buckets=4)
    for step in range(4):
        added, removed = some(r.randint(0, 12)), r.sample(now, r.randint(0, len(now) // 2))
        if step == 2:
            removed = list(now)
        now = [p for p in now if p not in removed] + added
        files = store.files("daily")
        for _ in range(2):  # sent twice, counted once
            lost = maintained.update(store, table(spark, "backs", added), table(spark, "backs", removed), tag=str(step))
        assert lost == {} and set(files) & set(store.files("daily")) <= set(files)
        pledges, state = table(spark, "backs", now), maintained.daily(store)
        assert bag(state) == bag(funding.daily_funding(pledges))
        for job in (funding.funding_curve, funding.days_to_funding):
            assert bag(job(world["projects"], state)) == bag(job(world["projects"], pledges))
        success = lambda of: bag(funding.successful_projects(world["projects"], of, "2030-01-01"))
        assert success(state) == success(pledges)


def test_an_update_reads_the_state_and_the_batch_alone(spark, store):
    maintained.create(store, many_pledges(spark), buckets=8)
    before = store.files("daily")
    lost = maintained.update(store, added=table(spark, "backs", [("x", "gold", 3, "2021-10-09", None, 5), ("x", "gold", 900, "2021-10-09", None, 5)]))
    assert 0 < len(lost["daily"]) <= 2 < len(before)
    assert bag(maintained.daily(store).filter("id >= 900")) == bag(table(spark, "backs", [("x", "gold", 900, "2021-10-09", None, 5)]), "id", "backing", "amount")


def test_buckets_grow_with_the_state(spark, store):
    pledges = many_pledges(spark)
    # one row of the state for each of seven projects
    maintained.create(store, pledges, buckets=2, bucket_rows=1)
    assert store._manifest(store.version())[0][maintained.NAME].buckets == 7
    maintained.update(store, added=pledges)
    assert bag(funding.project_totals(maintained.daily(store))) == bag(funding.project_totals(pledges.unionByName(pledges)))
