from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pledgeflow.plans import funding, rankings
from pledgeflow.plans import sql_functions
from tests.data import PLEDGES, backer, bag, days_after, five_projects, rows, table

TODAY = "2022-10-25"


@pytest.fixture(scope="module")
def success(spark):
    tables = five_projects(spark)
    tables["backs"] = table(spark, "backs", PLEDGES)
    return {k: v.cache() for k, v in tables.items()}


@pytest.mark.parametrize(
    "n, today, ptype, expected",
    [
        (5, "2021-12-31", "type1", []),
        (5, "2022-01-15", "type1", [(5, 10000), (1, 1000), (4, 1000)]),
        (5, "2022-01-15", "type2", []),
        (3, "2022-12-31", "type1", [(5, 10000), (2, 1000), (1, 1000)]),
        (5, "2022-12-31", "type1", [(5, 10000), (2, 1000), (1, 1000), (4, 1000)]),
        (0, "2022-12-31", "type1", []),
    ],
)
@pytest.mark.parametrize("job", [rankings.find_top_success, rankings.top_success_rejoin])
def test_top_success(success, job, n, today, ptype, expected):
    got = job(success["projects"], success["backs"], n, today, ptype)
    assert got.columns == ["id", "name", "email", "amount"]
    assert rows(got, "id", "amount") == expected


def test_successful_projects_bounds(success):
    # The deadline must lie before the date; a sum equal to the goal is enough.
    jobs = (funding.successful_projects, funding.successful_projects_rows)
    for job in jobs:
        assert bag(job(success["projects"], success["backs"], "2022-01-01"), "id") == []
        assert bag(job(success["projects"], success["backs"], "2022-01-02"), "id") == [(1,), (4,), (5,)]


def test_project_without_pledges_never_succeeds(spark, success):
    none = table(spark, "backs")
    assert rows(funding.successful_projects(success["projects"], none, TODAY)) == []


def test_exact_ratio_ties(spark):
    # 1/3 and 2/6 tie exactly, and the smaller id comes first; a nearby ratio does not tie.
    projects = table(spark, "projects", [
        (n, "c", "t", "2021-01-01", f"p{n}", "2021-02-01", goal)
        for n, goal in ((1, 600), (2, 300), (3, "299.9999"))
    ])
    backs = table(spark, "backs", [("b", "x", 1, "2021-01-02", None, 2000), ("b", "x", 2, "2021-01-02", None, 1000),
                                   ("b", "x", 3, "2021-01-02", None, 1000)])
    assert rows(rankings.find_top_success(projects, backs, 3, TODAY, "t"), "id") == [(3,), (1,), (2,)]


@pytest.fixture(scope="module")
def popular(spark):
    created = days_after(TODAY, -100)
    deadlines = dict(zip(range(1, 10), [-1, -2, -3, -4, -5, -6, -1, -2, -3]))
    ptype = lambda n: "default ptype" if n <= 6 else "second ptype" if n <= 8 else "third ptype"
    projects = [(n, "c", ptype(n), created, f"p{n}", days_after(TODAY, d), 100) for n, d in deadlines.items()]
    pledged = {
        1: [(0, 100)], 2: [(1, 300)], 3: [(1, 30), (2, 20), (3, 10), (4, 50)],
        4: [(1, 60), (2, 60), (3, 10), (4, 10)], 6: [(1, 40), (2, 30), (3, 20)],
        7: [(10, 110)], 8: [(10, 110)], 9: [(10, 110)],
    }
    backs = [
        (backer(i), "Third", n, days_after(created, day), None, amount)
        for n, list_ in pledged.items()
        for i, (day, amount) in enumerate(list_, 1)
    ]
    return table(spark, "projects", projects).cache(), table(spark, "backs", backs).cache()


DEFAULT = [(1, 0), (2, 1), (4, 2), (3, 4), (5, None), (6, None)]


@pytest.mark.parametrize(
    "n, offset, ptype, expected",
    [
        (10, 0, "default ptype", DEFAULT),
        (2, 0, "default ptype", DEFAULT[:2]),
        (0, 0, "default ptype", []),
        (10, -2, "default ptype", DEFAULT),
        (10, -4, "default ptype", DEFAULT),
        (10, -6, "default ptype", DEFAULT),
        (10, 0, "second ptype", [(7, 10), (8, 10)]),
        (10, 0, "third ptype", [(9, 10)]),
        (10, -100, "default ptype", []),  # the day of creation is not after it
    ],
)
def test_top_popular(popular, n, offset, ptype, expected):
    got = rankings.find_top_popular(*popular, n, days_after(TODAY, offset), ptype)
    assert rows(got, "id", "days") == expected


def test_top_popular_funded_drops_unfunded(popular):
    assert rows(rankings.top_popular_funded(*popular, 10, TODAY, "default ptype"), "id", "days") == DEFAULT[:4]


def test_curve_adds_up_ties_on_one_day(spark):
    projects = table(spark, "projects", [(1, "c", "t", "2021-01-01", "p", "2021-02-01", 100)])
    backs = table(spark, "backs", [
        ("a", "x", 1, "2021-01-02", None, 10), ("b", "x", 1, "2021-01-02", None, 20), ("c", "x", 1, "2021-01-05", None, 70),
    ])
    assert bag(funding.funding_curve(projects, backs), "backing", "amount", "running", "goal") == [
        (date(2021, 1, 2), 30, 30, 100),
        (date(2021, 1, 5), 70, 100, 100),
    ]
    assert rows(funding.days_to_funding(projects, backs)) == [(1, 4)]


def _days_by_loop(projects, backs):
    """Plain accumulation in date order."""
    answer = {}
    for pid, created, goal in projects:
        total, answer[pid] = 0, None
        for day, amount in sorted((d, a) for i, d, a in backs if i == pid):
            total += amount
            if total >= goal:
                answer[pid] = (day - created).days
                break
    return answer


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    goals=st.lists(st.integers(1, 60), min_size=1, max_size=6),
    pledges=st.lists(st.tuples(st.integers(0, 7), st.integers(0, 9), st.integers(1, 30)), max_size=30),
)
def test_days_to_funding_equals_plain_loop(spark, goals, pledges):
    start = date(2021, 1, 1)
    plain_projects = [(i, start, g) for i, g in enumerate(goals)]
    plain_backs = [(i, start + timedelta(days=d), a) for i, d, a in pledges]
    projects = table(spark, "projects", [(i, "c", "t", c, "p", c + timedelta(days=9), g) for i, c, g in plain_projects])
    backs = table(spark, "backs", [(f"b{n}", "x", i, d, None, a) for n, (i, d, a) in enumerate(plain_backs)])
    assert dict(rows(funding.days_to_funding(projects, backs))) == _days_by_loop(plain_projects, plain_backs)


def test_reports_as_sql_functions(spark, success):
    tables = {**success, "verifies": table(spark, "verifies", [(backer(1), 1, "2022-01-01"), (backer(2), 1, "2022-01-02")])}
    sql_functions.register(spark, tables)
    got = spark.sql("SELECT id, amount FROM successful_projects(DATE '2022-01-15')")
    assert bag(got) == [(1, Decimal(1000)), (4, Decimal(1000)), (5, Decimal(10000))]
    assert bag(spark.sql("SELECT email FROM verified_users(DATE '2022-01-01')")) == [(backer(1),)]


def test_sql_reports_come_in_order(spark):
    tables = dict(five_projects(spark))
    days = {1: 5, 2: 1, 3: 9, 4: 1}
    pledges = [(backer(b), "gold", n, days_after("2021-10-01", d), None, 1000 + 500 * n) for n, d in days.items() for b in (1, 2)]
    tables["backs"] = table(spark, "backs", pledges)
    tables["verifies"] = table(spark, "verifies", [(backer(b), 1, "2021-01-01") for b in (2, 1)])
    sql_functions.register(spark, tables)
    ask = lambda text: rows(spark.sql(text))
    top = ask("SELECT id FROM find_top_success(3, DATE '2022-03-01', 'type1')")
    assert top == [(n,) for n in (4, 3, 2)]
    popular = ask("SELECT id, days FROM find_top_popular(5, DATE '2022-03-01', 'type1')")
    assert popular == [(2, 1), (4, 1), (1, 5), (3, 9), (5, None)]
    both = [(backer(1),), (backer(2),)]
    assert ask("SELECT email FROM find_superbackers(DATE '2022-02-10')") == [*both]
    assert ask("SELECT email FROM find_superbackers(DATE '2022-02-10', 9)") == both
    assert ask("SELECT email FROM find_superbackers(DATE '2022-02-10', 9, 5, 3, 2000.5)") == []
    assert ask("SELECT email FROM find_superbackers(DATE '2022-02-10', 9, 1, 1, 99999)") == both
