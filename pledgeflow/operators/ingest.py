"""Bulk registration of users and loading of projects.

One input row stands for one call of the former one-row procedures: it is
taken whole or refused whole, with the first reason that would have stopped it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeflow.functions import messages
from pledgeflow.functions.expressions import (
    check_reasons,
    check_violated,
    first_reason,
    null_reasons,
    paired_prefix,
    reason_if,
)
from pledgeflow.operators.audit import with_key_reason
from pledgeflow.operators.joins import matching, spread_join
from pledgeflow.operators.verdicts import accepted
from pledgeflow.schema import TABLES

# The kinds a registration may have.
BACKER, CREATOR, BOTH = "BACKER", "CREATOR", "BOTH"


def _in_role(*kinds: str):
    return F.col("kind").isin(*kinds)


def judge_registrations(registrations: DataFrame, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Registrations with the first reason against them.

    ``tables`` holds the stored ``users``, ``backers`` and ``creators`` whose
    keys are taken. Order: user row, its key, kind, creator row, backer row.
    The emails are counted when this is called (see ``with_key_reason``).
    """
    tables = tables or {}
    users, backers, creators = TABLES["users"], TABLES["backers"], TABLES["creators"]
    unknown_kind = reason_if(
        ~F.coalesce(_in_role(BACKER, CREATOR, BOTH), F.lit(False)),
        F.format_string(messages.UNKNOWN_KIND, F.coalesce("kind", F.lit("<NULL>"))),
    )
    as_creator = [F.when(_in_role(CREATOR, BOTH), r) for r in null_reasons(creators, ["country"])]
    as_backer = [
        F.when(_in_role(BACKER, BOTH), r)
        for r in null_reasons(backers, ["street", "num", "zip", "country"])
    ]
    rows = registrations.select(
        "*",
        first_reason(*null_reasons(users), *check_reasons(users)).alias("__user_reason"),
        first_reason(unknown_kind, *as_creator, *as_backer).alias("__role_reason"),
    )
    # A role row stored without its user row would also refuse the email.
    role_reasons = []
    for name, kinds in (("creators", (CREATOR, BOTH)), ("backers", (BACKER, BOTH))):
        if name in tables:
            mark = f"__{name}"
            rows = rows.join(
                matching(tables[name], registrations, ["email"]).select("email", F.lit(True).alias(mark)),
                "email", "left",
            )
            role_reasons.append(
                reason_if(F.col(mark).isNotNull() & _in_role(*kinds), messages.KEY_STORED.format(table=name))
            )
    rows = rows.withColumn("__role_reason", first_reason(F.col("__role_reason"), *role_reasons))
    # Only rows that could stand by themselves compete for an email.
    rows = rows.withColumn("reason", F.coalesce("__user_reason", "__role_reason"))
    judged = with_key_reason(rows, registrations, "users", ["email"], tables.get("users"))
    return judged.select(
        *registrations.columns,
        first_reason(F.col("__user_reason"), F.col("key_reason"), F.col("__role_reason")).alias("reason"),
    )


def new_users(judged: DataFrame) -> DataFrame:
    return accepted(judged).select("email", "name", "cc1", "cc2")


def new_backers(judged: DataFrame) -> DataFrame:
    return accepted(judged).filter(_in_role(BACKER, BOTH)).select("email", "street", "num", "zip", "country")


def new_creators(judged: DataFrame) -> DataFrame:
    return accepted(judged).filter(_in_role(CREATOR, BOTH)).select("email", "country")


def register_users(registrations: DataFrame, tables: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """New ``users``, ``backers`` and ``creators`` rows, and ``rejected`` registrations.

    The four outputs read one judged input. To write them from a large batch,
    store it first with ``write_judged`` and split what was stored.
    """
    judged = judge_registrations(registrations, tables)
    return {
        "users": new_users(judged),
        "backers": new_backers(judged),
        "creators": new_creators(judged),
        "rejected": judged.filter(F.col("reason").isNotNull()),
    }


def judge_project_loads(
    loads: DataFrame, tables: Mapping[str, DataFrame], hot: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Project loads with the first reason against them.

    ``tables`` holds ``creators`` and ``project_types``, and the stored
    ``projects`` if there are any. Rewards are checked inside the row's arrays.
    Order: project row, its key, references, reward rows, at least one reward.
    ``hot`` may hold hot keys of ``email`` and ``ptype``.
    The ids are counted when this is called (see ``with_key_reason``).
    """
    spec, rewards = TABLES["projects"], TABLES["rewards"]
    levels = paired_prefix(F.col("names"), F.col("amounts"))
    any_level = lambda broken: F.coalesce(F.exists("__levels", broken), F.lit(False))
    reward_reasons = [
        reason_if(any_level(lambda x: x["name"].isNull()), messages.NULL_VALUE.format(table="rewards", column="name")),
        reason_if(any_level(lambda x: x["min_amt"].isNull()), messages.NULL_VALUE.format(table="rewards", column="min_amt")),
        reason_if(
            any_level(lambda x: check_violated(x["min_amt"] > 0)),
            messages.CHECK_FAILED.format(table="rewards", check=rewards.checks[0]),
        ),
        reason_if(
            F.size(F.array_distinct("__level_names")) < F.size("__level_names"),
            messages.KEY_REPEATED.format(table="rewards"),
        ),
    ]
    rows = (
        loads.withColumn("__levels", levels)
        .withColumn("__level_names", F.transform("__levels", lambda x: x["name"]))
        .select(
            *loads.columns,
            first_reason(*null_reasons(spec), *check_reasons(spec)).alias("__row_reason"),
            first_reason(
                *reward_reasons, reason_if(F.col("__levels").isNull(), messages.NO_REWARD_LEVELS)
            ).alias("__reward_reason"),
        )
    )
    owners = tables["creators"].select("email", F.lit(True).alias("__creator"))
    types = tables["project_types"].select(F.col("name").alias("ptype"), F.lit(True).alias("__type"))
    to_creator, to_type = spec.foreign_keys
    by_email, by_type = (hot.get(c) if hot else None for c in ("email", "ptype"))
    owned = spread_join(rows, owners, ["email"], "left", by_email, ["id"])
    linked = spread_join(owned, types, ["ptype"], "left", by_type, ["id"]).withColumn(
        "__parent_reason",
        first_reason(
            reason_if(
                F.col("__creator").isNull(),
                messages.PARENT_MISSING.format(table=spec.name, label=to_creator.label),
            ),
            reason_if(
                F.col("__type").isNull(),
                messages.PARENT_MISSING.format(table=spec.name, label=to_type.label),
            ),
        ),
    )
    ruled = linked.withColumn("reason", F.coalesce("__row_reason", "__parent_reason", "__reward_reason"))
    keyed = with_key_reason(ruled, loads, "projects", spec.key, tables.get("projects"))
    return keyed.select(
        *loads.columns,
        first_reason(
            F.col("__row_reason"), F.col("key_reason"), F.col("__parent_reason"), F.col("__reward_reason")
        ).alias("reason"),
    )


def new_projects(judged: DataFrame) -> DataFrame:
    return accepted(judged).select(*TABLES["projects"].schema.names)


def new_rewards(judged: DataFrame) -> DataFrame:
    """One reward per position up to the end of the shorter array."""
    level = F.explode(paired_prefix(F.col("names"), F.col("amounts")))
    return accepted(judged).select("id", level.alias("level")).select("level.name", "id", "level.min_amt")


def load_projects(loads: DataFrame, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """New ``projects`` and ``rewards`` rows, and ``rejected`` loads."""
    judged = judge_project_loads(loads, tables)
    return {
        "projects": new_projects(judged),
        "rewards": new_rewards(judged),
        "rejected": judged.filter(F.col("reason").isNotNull()),
    }
