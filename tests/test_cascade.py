import pytest

from pledgeflow.operators import cascade
from pledgeflow.schema import TABLES
from tests.data import PLEDGES, backer, bag, creator, five_projects, table


@pytest.fixture(scope="module")
def world(spark):
    tables = {name: table(spark, name) for name in TABLES}
    tables.update(five_projects(spark))
    tables["backs"] = table(spark, "backs", PLEDGES)
    tables["updates"] = table(spark, "updates", [("2024-01-01 00:00:00", n, "m") for n in range(1, 6)])
    tables["verifies"] = table(spark, "verifies", [(creator(5), 1, "2022-01-01")])
    tables["refunds"] = table(spark, "refunds", [(backer(3), 3, 1, "2022-12-01", True)])
    return tables


def mapping(spark, pairs):
    kind = "string" if isinstance(pairs[0][0], str) else "bigint"
    return spark.createDataFrame(pairs, f"old_value {kind}, new_value {kind}")


def test_email_change_reaches_roles_and_projects(spark, world):
    new = cascade.cascade_key_update(world, "users", "email", mapping(spark, [(creator(1), "new1"), ("nobody", "new2")]))
    assert set(new) == {"users", "backers", "creators", "projects"}
    for name in ("users", "creators"):
        emails = [e for e, in bag(new[name], "email")]
        assert "new1" in emails and creator(1) not in emails and "new2" not in emails
    assert bag(new["projects"].filter("email = 'new1'"), "id") == [(1,)]
    assert new["users"].columns == world["users"].columns


def test_change_is_refused_while_others_refer_to_it(spark, world):
    changes = mapping(spark, [(backer(1), "n1"), (creator(5), "n2"), (creator(2), "n3")])
    assert bag(cascade.blocked_key_update(world, "users", "email", changes)) == [(backer(1), "backs"), (creator(5), "verifies")]
    kept = cascade.cascade_key_update(world, "users", "email", changes)
    assert {e for e, in bag(kept["users"], "email")} & {"n1", "n2", "n3"} == {"n3"}
    forced = cascade.cascade_key_update(world, "users", "email", changes, force=True)
    assert {e for e, in bag(forced["users"], "email")} >= {"n1", "n2", "n3"}


def test_swap_and_collisions(spark, world):
    swap = mapping(spark, [(creator(1), creator(2)), (creator(2), creator(1))])
    assert bag(cascade.blocked_key_update(world, "users", "email", swap)) == []
    new = cascade.cascade_key_update(world, "users", "email", swap)
    assert bag(new["projects"].filter("id <= 2"), "id", "email") == [(1, creator(2)), (2, creator(1))]
    clash = mapping(spark, [(creator(1), creator(3)), (creator(2), "same"), (creator(4), "same")])
    assert bag(cascade.blocked_key_update(world, "users", "email", clash)) == [
        (creator(n), "collision") for n in (1, 2, 4)
    ]


def test_one_key_with_two_new_values_keeps_its_old_one(spark, world):
    changes = mapping(spark, [(creator(1), "a"), (creator(1), "b")])
    new = cascade.cascade_key_update(world, "users", "email", changes, force=True)
    assert bag(new["users"]) == bag(world["users"])


def test_type_and_project_id_changes(spark, world):
    renamed = cascade.cascade_key_update(world, "project_types", "name", mapping(spark, [("type1", "games")]))
    assert bag(renamed["projects"].select("ptype").distinct()) == [("games",)]
    ids = mapping(spark, [(1, 101)])
    assert bag(cascade.blocked_key_update(world, "projects", "id", ids)) == [(1, "backs")]
    moved = cascade.cascade_key_update(world, "projects", "id", ids, force=True)
    assert moved["rewards"].filter("id = 101").count() == 3 and moved["updates"].filter("id = 101").count() == 1


def test_changes_to_rewards_and_pledges_are_refused(spark, world):
    assert bag(cascade.blocked_key_update(world, "rewards", "name", mapping(spark, [("gold", "g"), ("copper", "c")]))) == [
        ("gold", "backs")
    ]
    assert bag(cascade.blocked_key_update(world, "backs", "email", mapping(spark, [(backer(3), "x"), (backer(4), "y")]))) == [
        (backer(3), "refunds")
    ]


def _emails(spark, *emails):
    return spark.createDataFrame([(e,) for e in emails], "email string")


def test_delete_of_users(spark, world):
    gone = _emails(spark, backer(1), creator(1), creator(5), "nobody")
    assert bag(cascade.blocked_delete(world, "users", gone)) == [
        (backer(1), "backs"), (creator(1), "projects"), (creator(5), "projects"), (creator(5), "verifies"),
    ]
    strict = bag(cascade.blocked_delete(world, "users", gone, cascade=False))
    assert strict == [(backer(1), "backers"), (creator(1), "creators"), (creator(5), "creators"), (creator(5), "verifies")]
    left = cascade.cascade_delete(world, "users", gone)
    assert set(left) == {"users", "backers", "creators"}
    assert left["users"].count() == 8 and left["backers"].count() == 5 and left["creators"].count() == 3


def test_delete_of_projects_and_pledges(spark, world):
    ids = spark.createDataFrame([(1,), (3,)], "id bigint")
    left = cascade.cascade_delete(world, "projects", ids)
    assert {name: df.count() for name, df in left.items()} == {"projects": 3, "updates": 3, "rewards": 9}
    assert bag(cascade.blocked_delete(world, "projects", ids)) == [("1", "backs"), ("3", "backs")]
    pledge = spark.createDataFrame([(backer(3), 3)], "email string, id bigint")
    left = cascade.cascade_delete(world, "backs", pledge)
    assert left["backs"].count() == 6 and left["refunds"].count() == 0


def _user_emails(changed):
    return bag(changed["users"], "email")


@pytest.mark.parametrize("force", [False, True])
def test_changes_that_wait_for_a_refused_one_are_refused(spark, world, force):
    """creator(5) is verified, so its email stays; what would take it over stays too, and what waits for that."""
    chain = mapping(spark, [(creator(1), creator(2)), (creator(2), creator(5)), (creator(5), "free"), (creator(3), "other")])
    blocked = bag(cascade.blocked_key_update(world, "users", "email", chain))
    assert blocked == [(creator(1), "collision"), (creator(2), "collision"), (creator(5), "verifies")]
    new = cascade.cascade_key_update(world, "users", "email", chain, force=force)
    emails = [e for e, in _user_emails(new)]
    assert len(set(emails)) == len(emails) == world["users"].count()
    assert "other" in emails and ("free" in emails) == force


def test_ambiguous_change_keeps_its_key_and_refuses_those_behind(spark, world):
    changes = mapping(spark, [(creator(1), creator(2)), (creator(2), "x"), (creator(2), "y")])
    assert (creator(1), "collision") in bag(cascade.blocked_key_update(world, "users", "email", changes))
    assert _user_emails(cascade.cascade_key_update(world, "users", "email", changes)) == bag(world["users"], "email")


@pytest.mark.parametrize("force", [False, True])
def test_null_is_no_new_key(spark, world, force):
    changes = mapping(spark, [(creator(1), "x"), (creator(1), None), (creator(2), None)])
    assert (creator(2), "null") in bag(cascade.blocked_key_update(world, "users", "email", changes))
    assert _user_emails(cascade.cascade_key_update(world, "users", "email", changes, force=force)) == bag(world["users"], "email")


def test_long_chain_and_cycle_move_together(spark, world):
    ring = mapping(spark, [(creator(n), creator(n % 4 + 1)) for n in range(1, 5)])
    assert bag(cascade.blocked_key_update(world, "users", "email", ring)) == []
    assert _user_emails(cascade.cascade_key_update(world, "users", "email", ring)) == bag(world["users"], "email")
