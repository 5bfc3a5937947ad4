"""The incremental reference audit against the full one, and the two-level key check against the plain one."""

import random

import pytest
from pyspark.sql import functions as F

from pledgeflow.operators import audit, reference_state
from pledgeflow.schema import TABLES
from pledgeflow.sources.versions import Store
from tests.data import bag, table

EMPLOYEES = [(i, "n", 5) for i in range(4)]


def some(r, name):
    e, p, tier = (lambda: f"e{r.randrange(8)}"), (lambda: r.randrange(6)), (lambda: r.choice(["gold", "tin"]))
    return {
        "users": lambda: (e(), "n", "1", None), "backers": lambda: (e(), "s", "1", "z", "c"), "creators": lambda: (e(), "c"),
        "projects": lambda: (p(), e(), "t", "2021-10-01", "n", "2022-01-01", 5), "rewards": lambda: (tier(), p(), 1),
        "backs": lambda: (e(), tier(), r.choice([p(), None]), "2021-10-07", None, 5), "refunds": lambda: (e(), p(), r.randrange(6), "2022-01-01", True),
        "updates": lambda: ("2021-10-01 00:00:00", r.choice([p(), None]), "m"), "verifies": lambda: (e(), r.randrange(6), "2021-10-01"),
    }[name]()


def test_random_changes_equal_a_full_audit(spark, tmp_path):
    r = random.Random(4)
    names = ["users", "backers", "creators", "projects", "rewards", "backs", "refunds", "updates", "verifies"]
    now = {n: [some(r, n) for _ in range(5)] for n in names} | {"employees": EMPLOYEES, "project_types": [("t", 1)]}
    frames = lambda of: {n: table(spark, n, rows) for n, rows in of.items()}
    store = Store(spark, str(tmp_path / "s"))
    reference_state.start(store, frames(now), buckets=4)
    for step in range(2):
        changed = r.sample(names, 3)
        removed = {n: r.sample(now[n], r.randint(0, len(now[n]))) for n in changed[:2]}
        added = {n: [some(r, n) for _ in range(r.randint(0, 4))] for n in changed[1:]}
        for n, rows in removed.items():
            now[n] = list(now[n])
            for row in rows:
                now[n].remove(row)
        for n, rows in added.items():
            now[n] = now[n] + rows
        for _ in range(1 + step):  # sent again under its tag, it counts once
            reference_state.update(store, frames(now), frames(added), frames(removed), tag=str(step))
        assert bag(reference_state.violations(store)) == bag(audit.audit_foreign_keys(frames(now)))


class Unread(dict):
    """Tables of which only some may be asked for."""

    def __missing__(self, name):
        raise AssertionError(f"{name} was read")


def test_children_are_read_for_lost_parents_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    tables = {n: table(spark, n) for n in TABLES} | {"employees": table(spark, "employees", EMPLOYEES)}
    tables["projects"] = table(spark, "projects", [(1, None, None, None, None, None, None)])
    tables["updates"] = table(spark, "updates", [("2021-10-01 00:00:00", 1, "m"), ("2021-10-01 00:00:00", 2, "m")])
    reference_state.start(store, tables, buckets=4)
    more = table(spark, "updates", [("2021-10-02 00:00:00", 3, "m"), ("2021-10-02 00:00:00", 1, "m")])
    reference_state.update(store, Unread(projects=tables["projects"]), {"updates": more}, {})
    found = lambda: sorted(r["row_key"][-1] for r in reference_state.violations(store).collect())
    assert found() == ["2", "3"]
    project = table(spark, "projects", [(2, None, None, None, None, None, None)])
    now = Unread(projects=tables["projects"].union(project), creators=tables["creators"], project_types=tables["project_types"])
    reference_state.update(store, now, {"projects": project}, {})
    assert found() == ["3"]


def shuffled_bytes(df):
    """Bytes that the shuffles of a DataFrame's own plan wrote, once it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().get("shuffleBytesWritten").get().value() if "Exchange" == name else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(plan)


def test_digests_move_instead_of_keys(spark):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("email"), (F.col("id") % 50).alias("id"))
    rows = rows.union(rows.filter("email < '001'"))
    plain, two = audit.audit_unique(rows, "backs", ["email", "id"]), audit.audit_unique_by_digest(rows, "backs", ["email", "id"])
    assert shuffled_bytes(two) * 4 < shuffled_bytes(plain) > 500_000
    assert bag(two) == bag(plain) and two.count() > 2


@pytest.mark.parametrize("digest", [F.xxhash64, lambda *key: F.lit(1).cast("long"), lambda *key: F.length(key[0]).cast("long")])
def test_equal_digests_of_different_keys(spark, digest):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("cc", 1), (None, 1), (None, 1), ("d", None), ("d", None)], "email string, id long")
    assert bag(audit.audit_unique_by_digest(rows, "backs", ["email", "id"], digest)) == [("backs", "unique", "a|1", "2 rows")]
    assert audit.audit_unique_by_digest(rows.limit(0), "backs", ["email", "id"], digest).count() == 0
