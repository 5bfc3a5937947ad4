from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pledgeflow.operators import maintenance
from tests.data import bag, people, rows, table


def test_appends(spark):
    users = table(spark, "users", [("a", "n", "1", "2")])
    more = spark.createDataFrame([("b", "m", "3", "4")], "w string, x string, y string, z string")
    assert bag(maintenance.append_positional(users, more)) == [("a", "n", "1", "2"), ("b", "m", "3", "4")]
    named = spark.createDataFrame([("9", "b", "m")], "cc1 string, email string, name string")
    assert bag(maintenance.append_named(users, named)) == [("a", "n", "1", "2"), ("b", "m", "9", None)]


def test_default_fills_only_an_absent_column(spark):
    bare = spark.createDataFrame([("a",)], "email string")
    assert rows(maintenance.fill_default(bare, "status", F.lit("pending"))) == [("a", "pending")]
    given_null = bare.withColumn("status", F.lit(None).cast("string"))
    assert rows(maintenance.fill_default(given_null, "status", F.lit("pending"))) == [("a", None)]


def test_request_updates(spark):
    backs = table(spark, "backs", [(e, "g", 1, "2022-01-01", "2022-02-01", 5) for e in "abcd"])
    changes = table(spark, "request_changes", [
        ("a", 1, "2022-03-01"), ("b", 1, None), ("c", 2, "2022-03-01"), ("d", 1, "2022-03-01"), ("d", 1, "2022-04-01"),
    ])
    new = maintenance.apply_request_updates(backs, changes)
    assert new.columns == backs.columns
    old = date(2022, 2, 1)
    assert bag(new, "email", "request") == [("a", date(2022, 3, 1)), ("b", None), ("c", old), ("d", old)]


def test_delete_users(spark):
    gone = spark.createDataFrame([("backer1@gmail.com",), ("creator1@gmail.com",), ("nobody",)], "email string")
    left = maintenance.delete_users(people(spark), gone)
    assert {name: df.count() for name, df in left.items()} == {"backers": 5, "creators": 4, "users": 9}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(size=st.integers(0, 300), parts=st.integers(1, 12), start=st.integers(-5, 1000))
def test_ids_are_dense(spark, size, parts, start):
    df = spark.range(size).repartition(parts).withColumn("id2", F.col("id") * 2).drop("id")
    got = rows(maintenance.assign_ids(df, "n", start))
    assert sorted(n for n, _ in got) == list(range(start, start + size))
    assert sorted(v for _, v in got) == [2 * i for i in range(size)]


@pytest.mark.parametrize("parts", [1, 7])
def test_ids_follow_the_order_and_go_on(spark, tmp_path, parts):
    marks = str(tmp_path / "marks")
    made = lambda lo, hi: spark.range(lo, hi).repartition(parts).select((F.col("id") % 5).alias("k"), (-F.col("id")).alias("v"))
    number = lambda df, tag: rows(maintenance.assign_next_ids(df, marks, tag, "n", ["k", F.desc("v")]))
    first = number(made(0, 60), "a")
    want = sorted(((i % 5, -i) for i in range(60)), key=lambda r: (r[0], -r[1]))
    assert sorted(first) == [(n, *r) for n, r in enumerate(want, 1)]
    second = number(made(60, 83), "b")
    assert sorted(n for n, *_ in second) == list(range(61, 84))
    assert sorted(number(made(60, 83).repartition(3), "b")) == sorted(second)  # a batch that is sent again
    assert number(made(0, 0), "c") == [] and sorted(n for n, *_ in number(made(0, 2), "d")) == [84, 85]


def test_equal_rows_and_nulls_in_the_order(spark):
    df = spark.createDataFrame([(None, "x")] * 3 + [(1, "b"), (1, "a")] + [(1, "a")] * 3, "k int, v string").repartition(4)
    got = sorted(rows(maintenance.assign_ids(df, "n", 1, [F.asc_nulls_last("k")])))
    assert got == [*((n, 1, "a") for n in range(1, 5)), (5, 1, "b"), *((n, None, "x") for n in range(6, 9))]
