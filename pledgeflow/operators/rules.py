"""Business rules over proposed rows.

Each ``judge_*`` function returns its batch with a ``reason`` column. The
conditions are plain columns, so batch jobs and stream guards share them.
Lookup tables are taken to be unique on their key (see ``audit_unique``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions import messages
from pledgeflow.functions.expressions import (
    check_reasons,
    days_between,
    first_reason,
    null_reasons,
    reason_if,
    rule_ok,
)
from pledgeflow.operators.audit import with_key_reason
from pledgeflow.operators.joins import matching, spread_join
from pledgeflow.plans.funding import project_totals
from pledgeflow.schema import TABLES

#: Days after the deadline within which a refund request may be granted.
REFUND_DAYS = 90

Hot = Mapping[str, DataFrame] | None


def _hot(hot: Hot, column: str) -> DataFrame | None:
    return hot.get(column) if hot else None


def pledge_dates_reason(backing: Column, created: Column, deadline: Column) -> Column:
    inside = (backing >= created) & (backing <= deadline)
    return reason_if(~rule_ok(inside), messages.PLEDGE_OUTSIDE_DATES)


def pledge_minimum_reason(amount: Column, minimum: Column) -> Column:
    return reason_if(~rule_ok(amount >= minimum), messages.PLEDGE_BELOW_MINIMUM)


def refund_decision_reason(request: Column, deadline: Column, accepted: Column) -> Column:
    in_time = days_between(request, deadline) <= REFUND_DAYS
    may_stand = rule_ok(in_time | accepted.eqNullSafe(F.lit(False)))
    return F.when(request.isNull(), messages.REFUND_NOT_REQUESTED).when(
        ~may_stand, messages.REFUND_TOO_LATE
    )


def _with_project_dates(batch: DataFrame, projects: DataFrame, hot: Hot) -> DataFrame:
    dates = projects.select(
        "id", F.col("created").alias("__created"), F.col("deadline").alias("__deadline")
    )
    return spread_join(batch, dates, ["id"], "left", _hot(hot, "id"), ["email"])


def _with_tier_minimum(batch: DataFrame, rewards: DataFrame, hot: Hot) -> DataFrame:
    tiers = rewards.select("id", "name", F.col("min_amt").alias("__min_amt"))
    return spread_join(batch, tiers, ["id", "name"], "left", _hot(hot, "id"), ["email"])


def _dates_reason() -> Column:
    return pledge_dates_reason(F.col("backing"), F.col("__created"), F.col("__deadline"))


def _minimum_reason() -> Column:
    return pledge_minimum_reason(F.col("amount"), F.col("__min_amt"))


def judge_user_roles(users: DataFrame, backers: DataFrame, creators: DataFrame) -> DataFrame:
    """Every user must be a backer, a creator or both, once the batch is complete.

    ``backers`` and ``creators`` hold stored and new rows together.
    """
    roles = backers.select("email").union(creators.select("email")).distinct()
    known = users.join(roles.withColumn("__role", F.lit(True)), "email", "left")
    return known.select(
        *users.columns, reason_if(F.col("__role").isNull(), messages.USER_WITHOUT_ROLE).alias("reason")
    )


def judge_pledge_minimum(pledges: DataFrame, rewards: DataFrame, hot: Hot = None) -> DataFrame:
    """A pledge must reach the minimum of its tier; an unknown tier fails too."""
    return _with_tier_minimum(pledges, rewards, hot).select(
        *pledges.columns, _minimum_reason().alias("reason")
    )


def judge_pledge_dates(pledges: DataFrame, projects: DataFrame, hot: Hot = None) -> DataFrame:
    """A pledge must fall between creation and deadline; an unknown project fails too."""
    return _with_project_dates(pledges, projects, hot).select(
        *pledges.columns, _dates_reason().alias("reason")
    )


def judge_project_rewards(projects: DataFrame, rewards: DataFrame) -> DataFrame:
    """Every project must have a reward level, once the batch is complete.

    ``rewards`` holds stored and new rows together.
    """
    offered = rewards.groupBy("id").agg(F.count("name").alias("__levels"))
    return projects.join(offered, "id", "left").select(
        *projects.columns,
        reason_if(~rule_ok(F.col("__levels") > 0), messages.NO_REWARD_LEVELS).alias("reason"),
    )


def judge_refund_decisions(decisions: DataFrame, backs: DataFrame, projects: DataFrame, hot: Hot = None) -> DataFrame:
    """Only requested refunds are decided, and late requests can only be refused."""
    keys = ["email", "pid"]
    requests = backs.select("email", F.col("id").alias("pid"), F.col("request").alias("__request"))
    deadlines = projects.select(F.col("id").alias("pid"), F.col("deadline").alias("__deadline"))
    hot_ids = _hot(hot, "id")
    if hot_ids is not None:
        hot_ids = hot_ids.withColumnRenamed("id", "pid")
    found = spread_join(
        decisions.join(matching(requests, decisions, keys), keys, "left"),
        deadlines, ["pid"], "left", hot_ids, ["email"],
    )
    reason = refund_decision_reason(F.col("__request"), F.col("__deadline"), F.col("accepted"))
    return found.select(*decisions.columns, reason.alias("reason"))


def named_pledges(changes: DataFrame, backs: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """``(email, id, __request, __changes)``: the pledges that changes name, their request, how many changes name them.

    ``earlier`` has the requests set since, as ``new_request``, one row per key.
    """
    keys = ["email", "id"]
    # Pledges on the streamed side: few changes find them without a shuffle of all.
    wanted = changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__changes"))
    named = backs.select(*keys, F.col("request").alias("__request")).join(wanted, keys)
    if earlier is None:
        return named
    since = earlier.select(*keys, F.col("new_request").alias("__since"), F.lit(True).alias("__set"))
    request = F.when(F.col("__set"), F.col("__since")).otherwise(F.col("__request"))
    return named.join(since, keys, "left").select(*keys, request.alias("__request"), "__changes")


def judge_request_changes(
    changes: DataFrame,
    backs: DataFrame,
    projects: DataFrame,
    lock_existing: bool = False,
    totals: DataFrame | None = None,
    hot: Hot = None,
    current: DataFrame | None = None,
) -> DataFrame:
    """A refund may be requested only once the project has succeeded.

    Checked when the request goes from NULL to a date: the project must be
    funded and its deadline must lie before the requested date. A request that
    is already set may be changed unchecked, unless ``lock_existing``. A change
    without a pledge, or one of several for a pledge, cannot be applied.

    ``totals`` may hold stored ``project_totals``, so that frequent small
    batches need not add up all pledges, and ``current`` stored ``named_pledges``.
    """
    current = named_pledges(changes, backs) if current is None else current
    success = (
        projects.join(project_totals(backs) if totals is None else totals, "id")
        .filter(F.col("goal") <= F.col("amount"))
        .select("id", F.col("deadline").alias("__deadline"))
    )
    found = spread_join(
        changes.join(current, ["email", "id"], "left"),
        success, ["id"], "left", _hot(hot, "id"), ["email"],
    )
    opens = F.col("__request").isNull() & F.col("new_request").isNotNull()
    reasons = [
        reason_if(F.col("__changes").isNull(), messages.NO_SUCH_PLEDGE),
        reason_if(F.col("__changes") > 1, messages.CHANGE_AMBIGUOUS),
        reason_if(
            opens & ~rule_ok(F.col("__deadline") < F.col("new_request")), messages.PROJECT_NOT_SUCCESSFUL
        ),
    ]
    if lock_existing:
        reasons.append(reason_if(F.col("__request").isNotNull(), messages.REQUEST_LOCKED))
    return found.select(*changes.columns, first_reason(*reasons).alias("reason"))


def judge_pledges(
    pledges: DataFrame,
    projects: DataFrame,
    rewards: DataFrame,
    backers: DataFrame,
    stored: DataFrame | None = None,
    hot: Hot = None,
) -> DataFrame:
    """All pledge rules in one pass; the first broken one is the reason.

    Order: project dates, tier minimum, required columns and checks, key,
    references. ``stored`` are the pledges already accepted; of several new
    pledges for one key none is accepted, since none comes first. The keys are
    counted when this is called (see ``with_key_reason``).
    """
    spec = TABLES["backs"]
    found = _with_tier_minimum(_with_project_dates(pledges, projects, hot), rewards, hot)
    rows = found.select(
        *pledges.columns,
        first_reason(_dates_reason(), _minimum_reason(), *null_reasons(spec), *check_reasons(spec)).alias("reason"),
    )
    keyed = with_key_reason(rows, pledges, spec.name, spec.key, stored)
    known = backers.select("email", F.lit(True).alias("__backer"))
    linked = spread_join(keyed, known, ["email"], "left", _hot(hot, "email"), ["id"])
    orphan = reason_if(
        F.col("__backer").isNull(),
        messages.PARENT_MISSING.format(table=spec.name, label=spec.foreign_keys[0].label),
    )
    return linked.select(
        *pledges.columns, first_reason(F.col("reason"), F.col("key_reason"), orphan).alias("reason")
    )


def judge_refunds(
    decisions: DataFrame,
    backs: DataFrame,
    projects: DataFrame,
    employees: DataFrame,
    stored: DataFrame | None = None,
    hot: Hot = None,
) -> DataFrame:
    """Refund decisions under the decision rule, then the table's own constraints."""
    spec = TABLES["refunds"]
    ruled = judge_refund_decisions(decisions, backs, projects, hot)
    staff = employees.select(F.col("id").alias("eid"), F.lit(True).alias("__employee"))
    orphan = reason_if(
        F.col("__employee").isNull(),
        messages.PARENT_MISSING.format(table=spec.name, label=spec.foreign_keys[0].label),
    )
    # Only decisions that could stand by themselves compete for a pledge.
    rows = spread_join(ruled, staff, ["eid"], "left", _hot(hot, "eid"), ["email", "pid"]).select(
        *decisions.columns,
        first_reason(F.col("reason"), *null_reasons(spec)).alias("__own_reason"),
        orphan.alias("__orphan"),
    )
    rows = rows.withColumn("reason", F.coalesce("__own_reason", "__orphan"))
    keyed = with_key_reason(rows, decisions, spec.name, spec.key, stored)
    return keyed.select(
        *decisions.columns,
        first_reason(F.col("__own_reason"), F.col("key_reason"), F.col("__orphan")).alias("reason"),
    )
