"""Top-n reports over projects."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pledgeflow.plans.funding import (
    days_to_funding,
    pledges_of,
    project_totals,
    projects_by_type,
    successful_projects,
    successful_projects_rows,
)


def _best_first() -> list[Column]:
    """Order by pledged share of the goal: its whole part, then the rest to 20 decimals, so totals of any size fit."""
    goal = F.col("goal").cast("decimal(18,4)")
    rest = F.col("amount") % goal
    whole = (F.col("amount") - rest) / goal
    return [whole.desc(), (rest.cast("decimal(18,4)") / goal).desc(), F.col("deadline").desc(), F.col("id").asc()]


def find_top_success(projects: DataFrame, backs: DataFrame, n: int, today: date | str, ptype: str) -> DataFrame:
    """The ``n`` successful projects of a type with the highest pledged share of the goal."""
    won = successful_projects(projects_by_type(projects, ptype), backs, today, selective=True)
    return (
        won.orderBy(*_best_first())
        .limit(n)
        .select("id", F.col("pname").alias("name"), F.col("c_email").alias("email"), "amount")
    )


def top_success_rejoin(projects: DataFrame, backs: DataFrame, n: int, today: date | str, ptype: str) -> DataFrame:
    """The same report from plain project rows joined to their totals."""
    mine = projects_by_type(projects, ptype)
    won = successful_projects_rows(mine, backs, today, selective=True)
    return (
        won.join(project_totals(pledges_of(mine, backs)), "id")
        .orderBy(*_best_first())
        .limit(n)
        .select("id", "name", "email", "amount")
    )


def _popular(projects: DataFrame, backs: DataFrame, today: date | str, ptype: str) -> DataFrame:
    started = projects_by_type(projects, ptype).filter(F.col("created") < F.lit(today).cast("date"))
    return started.join(days_to_funding(started, backs, selective=True), "id")


def find_top_popular(projects: DataFrame, backs: DataFrame, n: int, today: date | str, ptype: str) -> DataFrame:
    """The ``n`` projects of a type that reached their goal fastest; unfunded ones come last."""
    return (
        _popular(projects, backs, today, ptype)
        .orderBy(F.col("days").asc_nulls_last(), F.col("id").asc())
        .limit(n)
        .select("id", "name", "email", "days")
    )


def top_popular_funded(projects: DataFrame, backs: DataFrame, n: int, today: date | str, ptype: str) -> DataFrame:
    """As ``find_top_popular``, without the projects that never reached their goal."""
    return (
        _popular(projects, backs, today, ptype)
        .filter(F.col("days").isNotNull())
        .orderBy(F.col("days").asc(), F.col("id").asc())
        .limit(n)
        .select("id", "name", "email", "days")
    )
