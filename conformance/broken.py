"""Tables in which every constraint is broken somewhere: expressions over the rows of the model's tables.

Both engines read the same texts. A number of the row, modulo ``EVERY``, chooses what is broken in it.
"""

from __future__ import annotations

EVERY = 53
_OF_EMAIL = "CAST(substr(email, 2) AS BIGINT)"
#: A number per row, by table.
NUMBER = {
    "employees": "id", "users": _OF_EMAIL, "verifies": _OF_EMAIL, "backers": _OF_EMAIL, "creators": _OF_EMAIL,
    "project_types": "id", "projects": "id", "updates": "id", "rewards": "id", "backs": "id", "refunds": "pid",
}
#: Values that break a CHECK, by table and column.
WRONG = {
    "employees": {"salary": "0"}, "users": {"cc2": "cc1"}, "projects": {"deadline": "created - 1", "goal": "0"},
    "rewards": {"min_amt": "-1"}, "backs": {"amount": "0"},
}
#: Of these rows there are two copies.
TWICE = 7


def replaced(table: str, required: list[str]) -> dict[str, str]:
    """Column and expression: each required column is NULL in some rows, each checked one wrong in others."""
    chosen = f"{NUMBER[table]} % {EVERY}"
    cases = {c: [f"WHEN {chosen} = {k} THEN NULL"] for k, c in enumerate(required)}
    for k, (c, value) in enumerate(WRONG.get(table, {}).items()):
        cases.setdefault(c, []).append(f"WHEN {chosen} = {k + 20} THEN {value}")
    return {c: f"CASE {' '.join(whens)} ELSE {c} END" for c, whens in cases.items()}
