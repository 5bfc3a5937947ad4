import pytest

from pledgeflow.operators.joins import hot_keys
from pledgeflow.plans import backers
from tests.data import backer, bag, creator, people, rows, table

TODAY = "2022-10-25"
STEPS = [
    [],
    [(1, p, 50, None) for p in range(1, 6)],
    [(2, 6, 1600, None)],
    [(3, 6, 1600, "2022-10-01")],
    [(4, p, 50, None) for p in (1, 7, 8, 9, 10)],
    [(5, 6, 1600, "2022-10-01")],
]
EXPECTED = [[], [1], [1, 2], [1, 2], [1, 2], [1, 2]]


@pytest.fixture(scope="module")
def world(spark):
    goals = {n: 1000 if n == 6 else 50 for n in range(1, 11)}
    projects = [
        (n, creator(min(n, 5)), f"type{min(n, 5)}", "2021-10-01", f"p{n}", "2022-10-01", goal) for n, goal in goals.items()
    ]
    return {
        **people(spark),
        "projects": table(spark, "projects", projects),
        "verifies": table(spark, "verifies", [(backer(n), 1, "2022-01-01") for n in range(1, 5)]),
    }


def _pledges(spark, steps):
    return table(spark, "backs", [
        (backer(b), "gold", p, "2022-01-05", request, amount) for step in steps for b, p, amount, request in step
    ])


@pytest.mark.parametrize("step", range(len(STEPS)))
def test_superbackers_step_by_step(spark, world, step):
    tables = {**world, "backs": _pledges(spark, STEPS[: step + 1])}
    found = rows(backers.find_superbackers(tables, TODAY), "email")
    assert found == [(backer(n),) for n in EXPECTED[step]]
    hot = hot_keys(tables["backs"], ["id"], parts=10**9)
    assert rows(backers.find_superbackers(tables, TODAY, hot_ids=hot), "email") == found
    broad = bag(backers.superbackers_breadth(tables, TODAY))
    large = bag(backers.superbackers_amount(tables, TODAY))
    assert sorted({*broad, *large}) == bag(backers.find_superbackers(tables, TODAY))


def test_thresholds_are_parameters(spark, world):
    tables = {**world, "backs": _pledges(spark, STEPS)}
    # backer 4 has two types and 250 in all; backer 3 asked for a refund 24 days ago.
    assert bag(backers.superbackers_breadth(tables, TODAY, min_types=2), "email") == [(backer(1),), (backer(4),)]
    # Within 23 days the deadline of 24 days ago is not recent either.
    assert rows(backers.find_superbackers(tables, TODAY, recent_days=23)) == []


def test_future_request_disqualifies(spark, world):
    tables = {**world, "backs": _pledges(spark, [[(2, 6, 1600, "2023-01-01")]])}
    assert rows(backers.superbackers_amount(tables, TODAY)) == []


def test_verified_on_the_day_counts(spark, world):
    got = backers.verified_users(world["users"], world["verifies"], "2022-01-01")
    assert bag(got, "email") == [(backer(n),) for n in range(1, 5)]
    assert rows(backers.verified_users(world["users"], world["verifies"], "2021-12-31")) == []


def test_hot_projects_are_spread(spark, world):
    tables = {**world, "backs": _pledges(spark, STEPS)}
    hot = hot_keys(tables["backs"], ["id"], parts=5)
    for keys in (None, hot):
        found = backers.find_superbackers(tables, TODAY, hot_ids=keys)
        assert rows(found, "email") == [(backer(1),), (backer(2),)]
