import pytest
from pyspark.sql import functions as F

from pledgeflow.functions import messages as m
from pledgeflow.functions.expressions import money_array, text_array
from pledgeflow.operators import ingest
from tests.data import bag, creator, people, rows, table

VALID = [
    ("pureBacker", "n", "1", "2", "st", "9", "z", "SG", "BACKER"),
    ("pureBacker2", "n", "1", None, "st", "9", "z", "SG", "BACKER"),
    ("pureCreator", "n", "1", "2", None, None, None, "SG", "CREATOR"),
    ("pureCreator2", "n", "1", "2", "st", "9", "z", "SG", "CREATOR"),
    ("both1", "n", "1", "2", "st", "9", "z", "SG", "BOTH"),
    ("both2", "n", "1", "2", "st", "9", "z", "SG", "BOTH"),
]
INVALID = {
    ("noStreet", "n", "1", "2", None, "9", "z", "SG", "BACKER"): "null value in backers.street",
    ("noNum", "n", "1", "2", "st", None, "z", "SG", "BACKER"): "null value in backers.num",
    ("sameCards", "n", "1", "1", None, None, None, None, "CREATOR"): "check failed on users: cc1 <> cc2",
    ("noName", None, "1", "2", None, None, None, "SG", "CREATOR"): "null value in users.name",
    ("noZip", "n", "1", "2", "st", "9", None, "SG", "BOTH"): "null value in backers.zip",
    ("noNameBoth", None, "1", "2", "st", "9", "z", "SG", "BOTH"): "null value in users.name",
    ("neither", "n", "1", "2", "st", "9", "z", "SG", "NEITHER"): "Nonexistent kind --> NEITHER",
    ("twoKinds", "n", "1", "2", "st", "9", "z", "SG", "CREATOR BACKER"): "Nonexistent kind --> CREATOR BACKER",
}


def test_registrations_are_taken_whole_or_refused_whole(spark):
    batch = table(spark, "registrations", VALID + list(INVALID))
    new = ingest.register_users(batch, people(spark))
    assert bag(new["users"], "email") == sorted((r[0],) for r in VALID)
    assert bag(new["backers"], "email") == [("both1",), ("both2",), ("pureBacker",), ("pureBacker2",)]
    assert bag(new["creators"], "email") == [("both1",), ("both2",), ("pureCreator",), ("pureCreator2",)]
    assert dict(rows(new["rejected"], "email", "reason")) == {r[0]: reason for r, reason in INVALID.items()}


def test_registration_kind_is_case_sensitive_and_required(spark):
    batch = table(spark, "registrations", [(k or "none", "n", "1", "2", "s", "9", "z", "SG", k) for k in ("backer", None)])
    got = dict(rows(ingest.judge_registrations(batch), "email", "reason"))
    assert got == {"backer": "Nonexistent kind --> backer", "none": "Nonexistent kind --> <NULL>"}


def test_registration_keys(spark):
    good = ("n", "1", "2", "st", "9", "z", "SG")
    batch = table(spark, "registrations", [
        ("twice", *good, "BACKER"), ("twice", *good, "CREATOR"),
        ("once", *good, "BACKER"), ("once", *good, "nothing"),  # the bad copy does not compete
        (creator(1), *good, "BACKER"), ("orphanRole", *good, "CREATOR"), ("orphanRole2", *good, "BACKER"),
    ])
    stored = people(spark)
    stored["creators"] = stored["creators"].union(table(spark, "creators", [("orphanRole", "SG"), ("orphanRole2", "SG")]))
    got = bag(ingest.judge_registrations(batch, stored), "email", "kind", "reason")
    assert got == sorted([
        ("twice", "BACKER", "duplicate key in users: repeated in batch"),
        ("twice", "CREATOR", "duplicate key in users: repeated in batch"),
        ("once", "BACKER", None),
        ("once", "nothing", "Nonexistent kind --> nothing"),
        (creator(1), "BACKER", "duplicate key in users: already stored"),
        ("orphanRole", "CREATOR", "duplicate key in creators: already stored"),
        ("orphanRole2", "BACKER", None),
    ], key=repr)


def _load(id_, names, amounts, email=creator(1), ptype="type1", goal=1000, deadline="2022-01-01"):
    return (id_, email, ptype, "2021-10-01", f"p{id_}", deadline, goal, names, amounts)


THREE = ["level1", "level2", "level3"]


def test_project_loads(spark):
    batch = table(spark, "project_loads", [
        _load(1, THREE, [100, 200, 300]),
        _load(2, ["level1"], [100]),
        _load(3, ["level1"], ["0.1"], goal="0.0001"),
        _load(4, [], []),
        _load(5, ["level1"], []),
        _load(6, [], [100]),
        _load(7, THREE, [200, 400, 600, 2]),
        _load(8, None, None),
    ])
    new = ingest.load_projects(batch, people(spark))
    assert bag(new["projects"], "id") == [(1,), (2,), (3,), (7,)]
    levels = [r[0] for r in rows(new["rewards"].groupBy("id").count().orderBy("id"), "count")]
    assert levels == [3, 1, 1, 3]
    assert [float(r[0]) for r in rows(new["rewards"].filter("id = 7").orderBy("name"), "min_amt")] == [200, 400, 600]
    assert dict(rows(new["rejected"], "id", "reason")) == dict.fromkeys((4, 5, 6, 8), m.NO_REWARD_LEVELS)


def test_project_load_reasons(spark):
    batch = table(spark, "project_loads", [
        _load(1, ["a"], [1], goal=0),
        _load(2, ["a"], [1], deadline="2021-09-30"),
        _load(3, ["a"], [1], email="nobody"),
        _load(4, ["a"], [1], ptype="no type"),
        _load(5, ["a", None], [1, 2]),
        _load(6, ["a", "b"], [1, None]),
        _load(7, ["a", "b"], [1, 0]),
        _load(8, ["a", "a"], [1, 2]),
        _load(9, ["a"], [1]), _load(9, ["b"], [1]),
        _load(10, ["a"], [1], goal=None),
        _load(11, ["a"], [1]),
        _load(12, ["a", "b"], [1, 2]), _load(12, [], []),
    ])
    stored = people(spark)
    stored["projects"] = table(spark, "projects", [(11, creator(1), "type1", "2021-10-01", "p", "2022-01-01", 5)])
    got = bag(ingest.judge_project_loads(batch, stored), "id", "reason")
    repeated = "duplicate key in projects: repeated in batch"
    assert got == sorted([
        (1, "check failed on projects: goal > 0"),
        (2, "check failed on projects: deadline >= created"),
        (3, "missing parent: projects (email) -> creators(email)"),
        (4, "missing parent: projects (ptype) -> project_types(name)"),
        (5, "null value in rewards.name"),
        (6, "null value in rewards.min_amt"),
        (7, "check failed on rewards: min_amt > 0"),
        (8, "duplicate key in rewards: repeated in batch"),
        (9, repeated), (9, repeated),
        (10, "null value in projects.goal"),
        (11, "duplicate key in projects: already stored"),
        (12, None), (12, m.NO_REWARD_LEVELS),
    ], key=repr)


@pytest.mark.parametrize("text, expected", [
    ("{level1, level2}", ["level1", "level2"]), ("{}", []), ("{ }", []), ("{a}", ["a"]), ("{a,NULL}", ["a", None]), (None, None),
])
def test_text_array(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(text_array(df.t)).first()[0] == expected


def test_money_array(spark):
    df = spark.createDataFrame([("{1, 2.5, x}",)], "t string")
    got = df.select(money_array(df.t)).first()[0]
    assert [None if v is None else float(v) for v in got] == [1.0, 2.5, None]


@pytest.mark.parametrize("n", [1_000, 100_000])
def test_long_text_arrays(spark, n):
    plain = "{" + ", ".join(f"level{i}" for i in range(n)) + "}"
    quoted = "{" + ",".join(f'"a, {i} \\"x\\" \\\\"' for i in range(n)) + "}"
    escaped = '{"' + "\\," * n + '", b}'
    df = spark.createDataFrame([(plain,), (quoted,), (escaped,)], "t string").select(text_array(F.col("t")).alias("a"))
    got = [r["a"] for r in df.collect()]
    assert got[0] == [f"level{i}" for i in range(n)]
    assert got[1] == [f'a, {i} "x" \\' for i in range(n)]
    assert got[2] == ["," * n, "b"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ('{NULL, "NULL", null}', [None, "NULL", "null"]), ('{"", a}', ["", "a"]), ("{a\x01b, \x01, \x01d\x01c}", ["a\x01b", "\x01", "\x01d\x01c"]),
        ('{"\\\\", "\\"", \\"}', ["\\", '"', '\\"']), ('{a, "b, c}', ["a", '"b, c']), ("{,}", ["", ""]), ("{été, 😀}", ["été", "😀"]),
    ],
)
def test_awkward_text_arrays(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(text_array(df.t)).first()[0] == expected
