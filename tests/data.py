"""Small hand-made tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import types as T

from pledgeflow.schema import PROJECT_LOADS, REGISTRATIONS, REQUEST_CHANGES, TABLES

BATCHES = {
    "registrations": REGISTRATIONS,
    "project_loads": PROJECT_LOADS,
    "request_changes": REQUEST_CHANGES,
}


def _typed(value, kind):
    if value is None:
        return None
    if isinstance(kind, T.ArrayType):
        return [_typed(v, kind.elementType) for v in value]
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value))
    if isinstance(kind, T.DateType) and isinstance(value, str):
        return date.fromisoformat(value)
    if isinstance(kind, T.TimestampNTZType) and isinstance(value, str):
        return datetime.fromisoformat(value)
    return value


def table(spark, name, rows=()):
    """A table or batch of the model; texts become dates and decimals as declared."""
    schema = TABLES[name].raw_schema if name in TABLES else BATCHES[name]
    typed = [tuple(_typed(v, f.dataType) for v, f in zip(r, schema.fields)) for r in rows]
    return spark.createDataFrame(typed, schema)


def rows(df, *columns):
    """Result rows as tuples, in the order they come."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def bag(df, *columns):
    return sorted(rows(df, *columns), key=repr)


def backer(n):
    return f"backer{n}@gmail.com"


def creator(n):
    return f"creator{n}@gmail.com"


def days_after(day, n):
    return (date.fromisoformat(day) + timedelta(days=n)).isoformat()


def people(spark):
    """Users, roles, staff and project types shared by the fixtures."""
    users = [(backer(n), f"b{n}", "cc1_123", None) for n in range(1, 7)]
    users += [(creator(n), f"c{n}", "cc1_123", None) for n in range(1, 6)]
    return {
        "employees": table(spark, "employees", [(n, f"zhili{n}", 1000) for n in range(1, 6)]),
        "users": table(spark, "users", users),
        "backers": table(spark, "backers", [(backer(n), "st", "999", "S123456", "SG") for n in range(1, 7)]),
        "creators": table(spark, "creators", [(creator(n), "SG") for n in range(1, 6)]),
        "project_types": table(spark, "project_types", [(f"type{n}", n) for n in range(1, 6)]),
    }


TIERS = (("bronze", 200), ("silver", 400), ("gold", 600))


def five_projects(spark):
    """Five projects of one type that ask for 1000 each, with three tiers."""
    projects = [
        (n, creator(n), "type1", "2021-10-01", f"project{n}", "2022-02-01" if n == 2 else "2022-01-01", 1000)
        for n in range(1, 6)
    ]
    rewards = [(tier, n, amount) for n in range(1, 6) for tier, amount in TIERS]
    return {
        **people(spark),
        "projects": table(spark, "projects", projects),
        "rewards": table(spark, "rewards", rewards),
    }


PLEDGES = [
    (backer(1), "gold", 1, "2021-10-07", "2022-05-01", 600),
    (backer(2), "bronze", 1, "2021-10-12", "2022-05-01", 400),
    (backer(2), "silver", 2, "2021-10-10", "2022-05-01", 1000),
    (backer(3), "bronze", 3, "2021-10-10", "2022-03-01", 600),
    (backer(4), "silver", 4, "2021-10-01", "2022-02-01", 1000),
    (backer(5), "silver", 5, "2021-10-10", "2022-10-10", 5000),
    (backer(6), "gold", 5, "2021-10-10", "2022-09-09", 5000),
]
