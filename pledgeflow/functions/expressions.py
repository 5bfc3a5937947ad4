"""Predicates, dates, text arrays and reasons as plain Spark columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pledgeflow.functions import messages
from pledgeflow.schema import MONEY, TableSpec


def check_violated(predicate: Column) -> Column:
    """A CHECK fails only when its predicate is false; NULL passes."""
    return ~F.coalesce(predicate, F.lit(True))


def rule_ok(predicate: Column) -> Column:
    """A business rule holds only when its predicate is true; NULL fails."""
    return F.coalesce(predicate, F.lit(False))


def days_between(end: Column, start: Column) -> Column:
    """``end - start`` in whole days, as an integer."""
    return F.datediff(end, start)


def reason_if(condition: Column, text: str | Column) -> Column:
    """``text`` where the condition is true, else NULL."""
    return F.when(condition, F.lit(text) if isinstance(text, str) else text)


def first_reason(*reasons: Column) -> Column:
    """The first reason that is set; NULL when the row breaks no rule."""
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def null_reasons(spec: TableSpec, columns: Iterable[str] | None = None, names: dict[str, str] | None = None) -> list[Column]:
    """One reason per NOT NULL column; ``names`` maps a table column to the batch column."""
    names = names or {}
    return [
        reason_if(
            F.col(names.get(c, c)).isNull(),
            messages.NULL_VALUE.format(table=spec.name, column=c),
        )
        for c in (spec.required if columns is None else columns)
    ]


def check_reasons(spec: TableSpec) -> list[Column]:
    return [
        reason_if(
            check_violated(F.expr(check)),
            messages.CHECK_FAILED.format(table=spec.name, check=check),
        )
        for check in spec.checks
    ]


def row_key(df_schema, key: Sequence[str]) -> Column:
    """Readable text of a row's key: its parts joined by ``|``, NULL written out."""
    parts = []
    for name in key:
        column = F.col(name)
        if df_schema[name].dataType.typeName() in ("timestamp", "timestamp_ntz"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        parts.append(F.coalesce(column.cast("string"), F.lit("NULL")))
    return F.concat_ws("|", *parts)


def text_array(column: Column) -> Column:
    """``'{a, b}'`` to an array of its trimmed elements; ``'{}'`` to an empty one.

    An element in double quotes may hold commas and spaces, and a backslash before a character that stands for itself.
    A quote that is never closed reaches to the end. The steps each pass over the text once, so long literals are fine.
    """
    body = F.trim(F.regexp_replace(column, r"^\s*\{|\}\s*$", ""))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(
        F.transform(_split_outside_quotes(body), _element)
    )


# Stand-ins for an escaped backslash, an escaped quote and a comma between elements. They begin with a control
# character, which is written as a stand-in itself where the text has it.
_MARK = "\u0001"
_STAND_INS = ((_MARK, _MARK + "a"), ("\\\\", _MARK + "b"), ('\\"', _MARK + "c"))
_BETWEEN = _MARK + "d"


def _split_outside_quotes(body: Column) -> Column:
    """The text between commas that are not in double quotes."""
    for text, stand_in in _STAND_INS:
        body = F.replace(body, F.lit(text), F.lit(stand_in))
    # Every second piece between quotes lies outside them.
    pieces = F.transform(
        F.split(body, '"'),
        lambda piece, n: F.when(n % 2 == 0, F.replace(piece, F.lit(","), F.lit(_BETWEEN))).otherwise(piece),
    )
    return F.split(F.array_join(pieces, '"'), _BETWEEN)


def _element(x: Column) -> Column:
    for text, stand_in in reversed(_STAND_INS):
        x = F.replace(x, F.lit(stand_in), F.lit(text))
    plain = F.trim(x)
    inner = F.regexp_replace(plain, r'^"|"$', "")
    quoted = plain.startswith('"') & plain.endswith('"') & (F.length(plain) > 1)
    return F.when(quoted, F.regexp_replace(inner, r"\\(.)", "$1")).when(plain != "NULL", plain)


def money_array(column: Column) -> Column:
    """A text array of amounts as decimals; text that is no number becomes NULL."""
    return F.transform(text_array(column), lambda x: x.try_cast(MONEY))


def paired_prefix(names: Column, amounts: Column) -> Column:
    """Pairs of both arrays by position, up to the end of the shorter one."""
    length = F.least(F.coalesce(F.size(names), F.lit(0)), F.coalesce(F.size(amounts), F.lit(0)))
    pairs = F.transform(
        F.arrays_zip(names.alias("name"), amounts.alias("amount")),
        lambda p: F.struct(p["name"].alias("name"), p["amount"].alias("min_amt")),
    )
    return F.when(length > 0, F.slice(pairs, 1, length))
