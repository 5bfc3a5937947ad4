"""Verified users and superbackers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.operators.joins import spread_join
from pledgeflow.plans.funding import project_totals

#: Defaults of the superbacker rules.
RECENT_DAYS = 30
MIN_PROJECTS = 5
MIN_TYPES = 3
MIN_AMOUNT = 1500


def verified_users(users: DataFrame, verifies: DataFrame, given_date: date | str) -> DataFrame:
    """Users with a verification on or before ``given_date``."""
    dated = verifies.filter(F.col("verified") <= F.lit(given_date).cast("date"))
    return users.join(dated.select("email").distinct(), "email", "left_semi")


def _recently(column: str, today: Column, days: int) -> Column:
    """``today - column <= days``; a date in the future counts as recent.

    Written with the column alone on one side, so that the scan can use it.
    """
    return F.col(column) >= F.date_sub(today, days)


def _backing_profile(tables, today: date | str, recent_days: int, hot_ids: DataFrame | None) -> DataFrame:
    """Per user: pledges to projects that succeeded recently, counted and added up.

    Only pledges to projects that ended recently go on; they are brought
    together by project once, for their totals and for the backers' rows.
    """
    day = F.lit(today).cast("date")
    ended = (
        tables["projects"]
        .filter((F.col("deadline") < day) & _recently("deadline", day, recent_days))
        .select("id", "ptype", "goal")
    )
    pledges = tables["backs"].select("email", "id", "amount")
    asked_for = pledges.join(ended.select("id"), "id", "left_semi")
    won = (
        ended.join(project_totals(asked_for), "id")
        .filter(F.col("goal") <= F.col("amount"))
        .select("id", "ptype")
    )
    hits = spread_join(asked_for, won, ["id"], "inner", hot_ids, ["email"])
    return hits.groupBy("email").agg(
        F.count("id").alias("n_projects"),
        F.countDistinct("ptype").alias("n_types"),
        F.sum("amount").alias("amount"),
    )


def _recent_requesters(backs: DataFrame, today: date | str, recent_days: int) -> DataFrame:
    day = F.lit(today).cast("date")
    recent = F.col("request").isNotNull() & _recently("request", day, recent_days)
    return backs.filter(recent).select("email").distinct()


def _named(tables, profile: DataFrame, today: date | str) -> DataFrame:
    users = verified_users(tables["users"], tables["verifies"], today)
    return profile.join(users.select("email", "name"), "email").select("email", "name")


def superbackers_breadth(
    tables, today: date | str, recent_days: int = RECENT_DAYS,
    min_projects: int = MIN_PROJECTS, min_types: int = MIN_TYPES, hot_ids: DataFrame | None = None,
) -> DataFrame:
    """Verified users who backed many recently successful projects of several types."""
    profile = _backing_profile(tables, today, recent_days, hot_ids).filter(
        (F.col("n_projects") >= min_projects) & (F.col("n_types") >= min_types)
    )
    return _named(tables, profile, today)


def superbackers_amount(
    tables, today: date | str, recent_days: int = RECENT_DAYS,
    min_amount: int = MIN_AMOUNT, hot_ids: DataFrame | None = None,
) -> DataFrame:
    """Verified users who pledged much to such projects and asked for no refund lately."""
    profile = _backing_profile(tables, today, recent_days, hot_ids).filter(F.col("amount") >= min_amount)
    asked = _recent_requesters(tables["backs"], today, recent_days)
    return _named(tables, profile.join(asked, "email", "left_anti"), today)


def find_superbackers(
    tables, today: date | str, recent_days: int = RECENT_DAYS, min_projects: int = MIN_PROJECTS,
    min_types: int = MIN_TYPES, min_amount: int = MIN_AMOUNT, hot_ids: DataFrame | None = None,
) -> DataFrame:
    """Users who qualify by breadth or by amount, ordered by email and name.

    Both rules read one profile per user, so pledges are aggregated once.
    """
    broad = (F.col("n_projects") >= min_projects) & (F.col("n_types") >= min_types)
    profile = _backing_profile(tables, today, recent_days, hot_ids)
    candidates = profile.filter(broad | (F.col("amount") >= min_amount))
    asked = _recent_requesters(tables["backs"], today, recent_days).withColumn("__asked", F.lit(True))
    kept = candidates.join(asked, "email", "left").filter(
        broad | ((F.col("amount") >= min_amount) & F.col("__asked").isNull())
    )
    return _named(tables, kept, today).orderBy("email", "name")
