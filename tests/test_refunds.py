from datetime import date

import pytest

from pledgeflow.operators import refunds
from pledgeflow.operators.joins import hot_keys
from tests.data import bag, rows, table

G, M = "grossanita@gmail.com", "myerschristopher@martinez.com"
TODAY = "2024-10-20"
STEPS = [
    [],
    [(G, "bronze", 1, "2022-09-08", None, 400)],
    [(G, "bronze", 2, "2022-08-11", "2023-01-16", 400), (M, "bronze", 2, "2022-10-18", "2023-01-15", 400)],
    [(M, "bronze", 1, "2023-01-17", "2022-12-20", 400)],
]
EXPECTED = [[], [], [], [(M, 1, 1, date(2024, 10, 20), False)]]


@pytest.fixture(scope="module")
def projects(spark):
    return table(spark, "projects", [
        (1, "k", "type_1", "2022-09-20", "Instrumental", "2022-09-20", 1000),
        (2, "e", "type_1", "2022-08-11", "Post-Disco", "2022-10-18", "50.001"),
    ])


@pytest.mark.parametrize("step", range(len(STEPS)))
def test_auto_reject_step_by_step(spark, projects, step):
    backs = table(spark, "backs", [p for s in STEPS[: step + 1] for p in s])
    none = table(spark, "refunds")
    new = refunds.auto_reject(backs, projects, none, 1, TODAY)
    assert rows(new) == EXPECTED[step]
    # Running again on the result adds nothing; strict mode shows the clash.
    again = none.union(new)
    assert rows(refunds.auto_reject(backs, projects, again, 1, TODAY)) == []
    strict = refunds.auto_reject(backs, projects, again, 1, TODAY, strict=True)
    assert [r[-1] for r in rows(strict)] == ["duplicate key in refunds: already stored"] * len(EXPECTED[step])
    hot = hot_keys(backs, ["id"], parts=10**9)
    assert rows(refunds.auto_reject(backs, projects, none, 1, TODAY, hot_ids=hot)) == EXPECTED[step]


def test_refund_status(spark):
    backs = table(spark, "backs", [
        (who, "gold", 1, "2022-01-01", None if who == "quiet" else "2022-02-01", 5)
        for who in ("quiet", "waiting", "granted", "refused")
    ])
    decided = table(spark, "refunds", [("granted", 1, 1, "2022-03-01", True), ("refused", 1, 1, "2022-03-01", False)])
    assert bag(refunds.refund_status(backs, decided), "email", "status") == [
        ("granted", "approve"), ("quiet", None), ("refused", "reject"), ("waiting", "pending"),
    ]
