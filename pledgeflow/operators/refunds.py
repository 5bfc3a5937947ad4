"""Refund processing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions import messages
from pledgeflow.functions.expressions import days_between, reason_if
from pledgeflow.operators.rules import REFUND_DAYS
from pledgeflow.operators.joins import spread_join
from pledgeflow.schema import TABLES

# The states of a refund request.
PENDING, APPROVE, REJECT = "pending", "approve", "reject"


def late_requests(backs: DataFrame, projects: DataFrame, hot_ids: DataFrame | None = None) -> DataFrame:
    """Keys of pledges whose refund was requested more than 90 days after the deadline."""
    asked = backs.filter(F.col("request").isNotNull()).select("email", "id", "request")
    dated = spread_join(asked, projects.select("id", "deadline"), ["id"], "inner", hot_ids, ["email"])
    late = days_between(F.col("request"), F.col("deadline")) > REFUND_DAYS
    return dated.filter(late).select("email", F.col("id").alias("pid"))


def auto_reject(
    backs: DataFrame,
    projects: DataFrame,
    refunds: DataFrame,
    eid: int,
    today: date | str,
    strict: bool = False,
    hot_ids: DataFrame | None = None,
    employees: DataFrame | None = None,
) -> DataFrame:
    """New refund rows that refuse every late request.

    With ``employees`` given, an unknown or NULL ``eid`` raises: a row without its employee could not be stored.

    Requests decided before are left alone, so a second run adds nothing. With
    ``strict`` they are kept, and ``reason`` marks those whose key is taken.
    """
    if employees is not None and (eid is None or employees.filter(F.col("id") == eid).isEmpty()):
        raise ValueError(messages.PARENT_MISSING.format(table="refunds", label=TABLES["refunds"].foreign_keys[0].label))
    fresh = late_requests(backs, projects, hot_ids).select(
        "email",
        "pid",
        F.lit(eid).cast("bigint").alias("eid"),
        F.lit(today).cast("date").alias("date"),
        F.lit(False).alias("accepted"),
    )
    if not strict:
        return fresh.join(refunds.select("email", "pid"), ["email", "pid"], "left_anti")
    taken = refunds.select("email", "pid", F.lit(True).alias("__taken"))
    return fresh.join(taken, ["email", "pid"], "left").select(
        *fresh.columns,
        reason_if(F.col("__taken").isNotNull(), messages.KEY_STORED.format(table="refunds")).alias("reason"),
    )


def refund_status(backs: DataFrame, refunds: DataFrame) -> DataFrame:
    """``(email, id, status)``: pending, approve or reject; NULL when nothing was requested."""
    decisions = refunds.select(
        "email", F.col("pid").alias("id"), F.col("accepted"), F.lit(True).alias("__decided")
    )
    state = (
        F.when(F.col("request").isNull(), F.lit(None))
        .when(F.col("__decided").isNull(), PENDING)
        .when(F.col("accepted"), APPROVE)
        .otherwise(REJECT)
    )
    return (
        backs.select("email", "id", "request")
        .join(decisions, ["email", "id"], "left")
        .select("email", "id", state.cast("string").alias("status"))
    )
