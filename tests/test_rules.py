from decimal import Decimal

import pytest

from pledgeflow.functions import messages as m
from pledgeflow.operators import audit, rules, verdicts
from pledgeflow.operators.joins import hot_keys
from pledgeflow.operators.verdicts import apply_policy
from tests.data import PLEDGES, backer, bag, creator, five_projects, rows, table


def reasons(judged, *columns):
    return {tuple(r[:-1]) if len(columns) > 1 else r[0]: r[-1] for r in rows(judged, *columns, "reason")}


@pytest.fixture(scope="module")
def world(spark):
    return {k: v.cache() for k, v in five_projects(spark).items()}


def test_user_needs_a_role(spark, world):
    users = world["users"].union(table(spark, "users", [("loner", "l", "cc", None)]))
    judged = rules.judge_user_roles(users, world["backers"], world["creators"])
    assert {u for u, r in reasons(judged, "email").items() if r} == {"loner"}
    assert reasons(judged, "email")["loner"] == m.USER_WITHOUT_ROLE


def test_pledge_minimum(spark, world):
    batch = table(spark, "backs", [
        ("a", "gold", 1, "2021-10-07", None, 1100), ("b", "bronze", 1, "2021-10-07", None, 200),
        ("c", "gold", 1, "2021-10-07", None, 599), ("d", "bronze", 1, "2021-10-07", None, 199),
        ("e", "platinum", 1, "2021-10-07", None, 9999), ("f", "gold", 1, "2021-10-07", None, None),
    ])
    got = reasons(rules.judge_pledge_minimum(batch, world["rewards"]), "email")
    bad = m.PLEDGE_BELOW_MINIMUM
    assert got == {"a": None, "b": None, "c": bad, "d": bad, "e": bad, "f": bad}


def test_project_needs_a_reward(spark, world):
    batch = table(spark, "projects", [
        (n, creator(1), "type1", "2022-01-01", "p", "2022-02-01", 10) for n in (20, 21)
    ])
    rewards = world["rewards"].union(table(spark, "rewards", [("one", 20, 5)]))
    assert reasons(rules.judge_project_rewards(batch, rewards), "id") == {20: None, 21: m.NO_REWARD_LEVELS}


def test_pledge_dates(spark):
    projects = table(spark, "projects", [(1, "c", "t", "2021-10-01", "p", "2022-10-01", 5)])
    batch = table(spark, "backs", [
        (day or "none", "gold", 1, day, None, 5)
        for day in ("2021-10-01", "2022-10-01", "2021-10-02", "2021-09-30", "2022-10-02", None)
    ] + [("unknown", "gold", 7, "2022-01-01", None, 5)])
    got = reasons(rules.judge_pledge_dates(batch, projects), "email")
    assert {k for k, v in got.items() if v is None} == {"2021-10-01", "2022-10-01", "2021-10-02"}
    assert set(got.values()) == {None, m.PLEDGE_OUTSIDE_DATES}


def test_refund_decisions(spark, world):
    pledges = [p if p[:3:2] != (backer(2), 1) else (*p[:5], 1000) for p in PLEDGES]
    backs = table(spark, "backs", pledges + [(backer(6), "silver", 1, "2021-11-10", None, 5000)])
    batch = table(spark, "refunds", [
        (backer(b), p, 1, "2022-12-01", accepted)
        for b, p, accepted in ((3, 3, True), (4, 4, False), (5, 5, False), (6, 5, True), (6, 1, True), (5, 4, False), (5, 1, None))
    ] )
    got = reasons(rules.judge_refund_decisions(batch, backs, world["projects"]), "email", "pid")
    assert got == {
        (backer(3), 3): None, (backer(4), 4): None, (backer(5), 5): None,
        (backer(6), 5): m.REFUND_TOO_LATE, (backer(6), 1): m.REFUND_NOT_REQUESTED,
        (backer(5), 4): m.REFUND_NOT_REQUESTED, (backer(5), 1): m.REFUND_NOT_REQUESTED,
    }


def test_refund_decision_without_answer_is_refused_when_late(spark, world):
    backs = table(spark, "backs", PLEDGES)
    batch = table(spark, "refunds", [(backer(5), 5, 1, "2022-12-01", None), (backer(3), 3, 1, "2022-12-01", None)])
    got = reasons(rules.judge_refund_decisions(batch, backs, world["projects"]), "pid")
    assert got == {5: m.REFUND_TOO_LATE, 3: None}
    whole = rules.judge_refunds(batch, backs, world["projects"], world["employees"])
    assert reasons(whole, "pid")[3] == "null value in refunds.accepted"


def test_refund_keys_and_staff(spark, world):
    backs = table(spark, "backs", PLEDGES)
    batch = table(spark, "refunds", [
        (backer(3), 3, 1, "2022-12-01", True), (backer(4), 4, 99, "2022-12-01", True), (backer(1), 1, 1, "2022-12-01", False),
    ])
    stored = table(spark, "refunds", [(backer(1), 1, 2, "2022-11-01", False)])
    got = reasons(rules.judge_refunds(batch, backs, world["projects"], world["employees"], stored), "pid")
    assert got[3] is None
    assert got[4] == "missing parent: refunds (eid) -> employees(id)"
    assert got[1] == "duplicate key in refunds: already stored"


@pytest.fixture(scope="module")
def requests(spark):
    cleared = {(backer(4), 4), (backer(5), 5), (backer(6), 5)}
    pledges = [(*p[:4], None, p[5]) if (p[0], p[2]) in cleared or p[2] == 3 else p for p in PLEDGES]
    changes = [
        (backer(1), 1, "2050-02-01"), (backer(4), 4, None), (backer(6), 6, "2050-01-01"),
        (backer(6), 5, "2050-01-01"), (backer(3), 3, "2050-01-01"), (backer(5), 5, "2022-01-01"),
    ]
    return table(spark, "backs", pledges), table(spark, "request_changes", changes)


def test_request_needs_a_successful_project(world, requests):
    backs, changes = requests
    got = reasons(rules.judge_request_changes(changes, backs, world["projects"]), "email", "id")
    assert got == {
        (backer(1), 1): None,  # already set: not checked
        (backer(4), 4): None,  # stays NULL
        (backer(6), 6): m.NO_SUCH_PLEDGE,
        (backer(6), 5): None,
        (backer(3), 3): m.PROJECT_NOT_SUCCESSFUL,  # 600 of 1000
        (backer(5), 5): m.PROJECT_NOT_SUCCESSFUL,  # the deadline is not before the request
    }
    locked = rules.judge_request_changes(changes, backs, world["projects"], lock_existing=True)
    assert reasons(locked, "email", "id")[(backer(1), 1)] == m.REQUEST_LOCKED


def test_two_changes_for_one_pledge_are_refused(spark, world, requests):
    changes = table(spark, "request_changes", [(backer(6), 5, "2050-01-01"), (backer(6), 5, "2051-01-01")])
    judged = rules.judge_request_changes(changes, requests[0], world["projects"])
    assert [r[-1] for r in rows(judged)] == [m.CHANGE_AMBIGUOUS] * 2


@pytest.fixture(scope="module")
def offered(spark):
    return table(spark, "backs", [
        (backer(1), "gold", 1, "2021-10-07", None, 600),
        (backer(2), "gold", 1, "2021-09-07", None, 1),       # dates come before the minimum
        (backer(3), "gold", 1, "2021-10-07", None, 1),
        ("nobody", "gold", 2, "2021-10-07", None, 600),
        (None, "gold", 2, "2021-10-07", None, 600),
        (backer(4), "gold", 2, "2021-10-07", None, 600),      # twice
        (backer(4), "silver", 2, "2021-10-08", None, 600),
        (backer(5), "gold", 3, "2021-10-07", None, 600),      # its copy fails by itself
        (backer(5), "gold", 3, "2021-10-07", None, 1),
        (backer(6), "gold", 4, "2021-10-07", None, 700),      # stored before
    ])


def _judge(spark, world, offered, hot=None):
    stored = table(spark, "backs", [(backer(6), "gold", 4, "2021-10-06", None, 650)])
    return rules.judge_pledges(offered, world["projects"], world["rewards"], world["backers"], stored, hot)


def test_first_broken_pledge_rule_is_the_reason(spark, world, offered):
    got = bag(_judge(spark, world, offered), "email", "id", "amount", "reason")
    key = "duplicate key in backs: "
    assert got == sorted([
        (backer(1), 1, 600, None),
        (backer(2), 1, 1, m.PLEDGE_OUTSIDE_DATES),
        (backer(3), 1, 1, m.PLEDGE_BELOW_MINIMUM),
        ("nobody", 2, 600, "missing parent: backs (email) -> backers(email)"),
        (None, 2, 600, "null value in backs.email"),
        (backer(4), 2, 600, key + "repeated in batch"),
        (backer(4), 2, 600, key + "repeated in batch"),
        (backer(5), 3, 600, None),
        (backer(5), 3, 1, m.PLEDGE_BELOW_MINIMUM),
        (backer(6), 4, 700, key + "already stored"),
    ], key=lambda r: repr((r[0], r[1], Decimal(r[2]).quantize(Decimal("1.0000")), r[3])))


def test_key_clashes_are_joined_without_broadcast_too(spark, world, offered):
    expected = bag(_judge(spark, world, offered))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert bag(_judge(spark, world, offered)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_refund_decision_that_breaks_a_rule_does_not_compete(spark, world):
    asked = table(spark, "backs", [(backer(3), "gold", 3, "2021-11-01", "2022-11-01", 600)])
    both = table(spark, "refunds", [(backer(3), 3, 1, "2022-12-01", False), (backer(3), 3, 999, "2022-12-01", False)])
    got = rules.judge_refunds(both, asked, world["projects"], world["employees"])
    reasons = {r["eid"]: r["reason"] for r in got.collect()}
    assert reasons[1] is None and "missing parent" in reasons[999]


def test_hot_keys_do_not_change_the_verdicts(spark, world, offered):
    hot = {"id": hot_keys(offered, ["id"], parts=10**9), "email": hot_keys(offered, ["email"], parts=5)}
    assert bag(_judge(spark, world, offered, hot)) == bag(_judge(spark, world, offered))


def test_policy(spark, world, offered):
    judged = _judge(spark, world, offered)
    loose, strict = apply_policy(judged), apply_policy(judged, strict=True)
    assert loose.accepted.count() == 2 and loose.rejected.count() == 8
    assert loose.accepted.count() + loose.rejected.count() == offered.count()
    assert strict.accepted.count() == 0 and strict.rejected.count() == 8
    clean = apply_policy(_judge(spark, world, loose.accepted), strict=True)
    assert bag(clean.accepted) == bag(loose.accepted) and clean.rejected.count() == 0


def test_strict_policy_reads_a_held_batch(spark, world, offered):
    judged = verdicts.held(_judge(spark, world, offered))
    strict = apply_policy(judged, strict=True, stored=True)
    assert strict.rejected.inputFiles() == judged.inputFiles()
    again = apply_policy(judged, strict=True)
    assert bag(strict.accepted) == bag(again.accepted) and bag(strict.rejected) == bag(again.rejected)
