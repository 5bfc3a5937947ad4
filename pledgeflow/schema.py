"""The eleven tables of the model with their keys, checks and references.

Spark does not enforce keys, so this catalog is what the audits, the ingest
rules and the cascades read. A column that must not be NULL is non-nullable in
the declared schema; CHECK rules are SQL predicates over one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)


@dataclass(frozen=True)
class ForeignKey:
    """``columns`` of the owning table point at ``parent_columns`` of ``parent``.

    ``on_update`` / ``on_delete`` say what a change of the parent key does:
    ``"cascade"`` carries it to the child, ``"restrict"`` refuses it while
    children exist.
    """

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    on_update: str = "restrict"
    on_delete: str = "restrict"

    @property
    def label(self) -> str:
        return f"({', '.join(self.columns)}) -> {self.parent}({', '.join(self.parent_columns)})"


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    checks: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema.fields if not f.nullable)

    @property
    def raw_schema(self) -> T.StructType:
        """The same columns with NULL allowed, for data not checked yet."""
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in self.schema.fields])


def _columns(optional: tuple[str, ...] = (), **types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n in optional) for n, t in types.items()])


_INT, _TEXT, _DATE = T.LongType(), T.StringType(), T.DateType()

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "employees",
            _columns(id=_INT, name=_TEXT, salary=MONEY),
            ("id",),
            checks=("salary > 0",),
        ),
        TableSpec(
            "users",
            _columns(("cc2",), email=_TEXT, name=_TEXT, cc1=_TEXT, cc2=_TEXT),
            ("email",),
            checks=("cc1 <> cc2",),
        ),
        TableSpec(
            "verifies",
            _columns(email=_TEXT, id=_INT, verified=_DATE),
            ("email",),
            foreign_keys=(
                ForeignKey(("email",), "users", ("email",)),
                ForeignKey(("id",), "employees", ("id",)),
            ),
        ),
        TableSpec(
            "backers",
            _columns(email=_TEXT, street=_TEXT, num=_TEXT, zip=_TEXT, country=_TEXT),
            ("email",),
            foreign_keys=(ForeignKey(("email",), "users", ("email",), "cascade", "cascade"),),
        ),
        TableSpec(
            "creators",
            _columns(email=_TEXT, country=_TEXT),
            ("email",),
            foreign_keys=(ForeignKey(("email",), "users", ("email",), "cascade", "cascade"),),
        ),
        TableSpec(
            "project_types",
            _columns(name=_TEXT, id=_INT),
            ("name",),
            foreign_keys=(ForeignKey(("id",), "employees", ("id",)),),
        ),
        TableSpec(
            "projects",
            _columns(
                id=_INT, email=_TEXT, ptype=_TEXT, created=_DATE, name=_TEXT, deadline=_DATE, goal=MONEY
            ),
            ("id",),
            checks=("deadline >= created", "goal > 0"),
            foreign_keys=(
                ForeignKey(("email",), "creators", ("email",), on_update="cascade"),
                ForeignKey(("ptype",), "project_types", ("name",), on_update="cascade"),
            ),
        ),
        TableSpec(
            "updates",
            _columns(time=T.TimestampNTZType(), id=_INT, message=_TEXT),
            ("time", "id"),
            foreign_keys=(ForeignKey(("id",), "projects", ("id",), "cascade", "cascade"),),
        ),
        TableSpec(
            "rewards",
            _columns(name=_TEXT, id=_INT, min_amt=MONEY),
            ("name", "id"),
            checks=("min_amt > 0",),
            foreign_keys=(ForeignKey(("id",), "projects", ("id",), "cascade", "cascade"),),
        ),
        TableSpec(
            "backs",
            _columns(
                ("request",),
                email=_TEXT, name=_TEXT, id=_INT, backing=_DATE, request=_DATE, amount=MONEY,
            ),
            ("email", "id"),
            checks=("amount > 0",),
            foreign_keys=(
                ForeignKey(("email",), "backers", ("email",)),
                ForeignKey(("name", "id"), "rewards", ("name", "id")),
            ),
        ),
        TableSpec(
            "refunds",
            _columns(email=_TEXT, pid=_INT, eid=_INT, date=_DATE, accepted=T.BooleanType()),
            ("email", "pid"),
            foreign_keys=(
                ForeignKey(("eid",), "employees", ("id",)),
                ForeignKey(("email", "pid"), "backs", ("email", "id"), on_delete="cascade"),
            ),
        ),
    )
}

REGISTRATIONS = T.StructType(
    [
        T.StructField(c, _TEXT)
        for c in ("email", "name", "cc1", "cc2", "street", "num", "zip", "country", "kind")
    ]
)

PROJECT_LOADS = T.StructType(
    TABLES["projects"].raw_schema.fields
    + [
        T.StructField("names", T.ArrayType(_TEXT)),
        T.StructField("amounts", T.ArrayType(MONEY)),
    ]
)

REQUEST_CHANGES = T.StructType(
    [
        T.StructField("email", _TEXT),
        T.StructField("id", _INT),
        T.StructField("new_request", _DATE),
    ]
)


def references_to(parent: str) -> list[tuple[TableSpec, ForeignKey]]:
    """All (child table, foreign key) pairs that point at ``parent``."""
    return [
        (spec, fk) for spec in TABLES.values() for fk in spec.foreign_keys if fk.parent == parent
    ]
