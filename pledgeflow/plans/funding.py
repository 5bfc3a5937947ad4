"""Which projects reached their goal, and how fast.

Pledges are the large table. They are added up per project, or per project and
day, before anything else happens to them, so a viral project reaches the
shuffle as a few partial sums. Refunded pledges still count.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pledgeflow.functions.expressions import days_between


def _day(value: date | str) -> Column:
    return F.lit(value).cast("date")


def project_totals(backs: DataFrame) -> DataFrame:
    """``(id, amount)``: the sum of all pledges of each project that has any."""
    return backs.groupBy("id").agg(F.sum("amount").alias("amount"))


def reward_counts(rewards: DataFrame) -> DataFrame:
    """``(id, levels)``: reward levels per project that has any."""
    return rewards.groupBy("id").agg(F.count("name").alias("levels"))


def projects_by_type(projects: DataFrame, ptype: str) -> DataFrame:
    return projects.filter(F.col("ptype") == ptype)


def pledges_of(projects: DataFrame, backs: DataFrame) -> DataFrame:
    """The pledges to the given projects, for reports on a small part of all projects."""
    return backs.join(projects.select("id"), "id", "left_semi")


def funded_projects(projects: DataFrame, backs: DataFrame) -> DataFrame:
    """Projects whose pledges reach the goal, whatever the date, with ``amount``."""
    return projects.join(project_totals(backs), "id").filter(F.col("goal") <= F.col("amount"))


def successful_projects(
    projects: DataFrame, backs: DataFrame, given_date: date | str, selective: bool = False
) -> DataFrame:
    """Funded projects whose deadline lies before ``given_date``.

    ``selective`` says that ``projects`` is a small part of all, whose pledges are picked out before they are added up.
    """
    closed = projects.filter(F.col("deadline") < _day(given_date))
    return funded_projects(closed, pledges_of(closed, backs) if selective else backs).select(
        "id",
        F.col("email").alias("c_email"),
        F.col("ptype").alias("c_ptype"),
        F.col("created").alias("c_date"),
        F.col("name").alias("pname"),
        "deadline",
        "goal",
        "amount",
    )


def successful_projects_rows(
    projects: DataFrame, backs: DataFrame, given_date: date | str, selective: bool = False
) -> DataFrame:
    """The same projects as plain project rows."""
    closed = projects.filter(F.col("deadline") < _day(given_date))
    totals = project_totals(pledges_of(closed, backs) if selective else backs).select(F.col("id").alias("__id"), "amount")
    reached = (F.col("id") == F.col("__id")) & (F.col("goal") <= F.col("amount"))
    return closed.join(totals, reached, "left_semi")


def daily_funding(backs: DataFrame) -> DataFrame:
    """``(id, backing, amount)``: pledged per project and day."""
    return backs.groupBy("id", "backing").agg(F.sum("amount").alias("amount"))


def _upto_day() -> WindowSpec:
    # The window sees one row per day of a campaign, never single pledges.
    return Window.partitionBy("id").orderBy("backing")


def funding_curve(projects: DataFrame, backs: DataFrame) -> DataFrame:
    """Per project and day: pledged that day, pledged so far, and the goal."""
    running = F.sum("amount").over(_upto_day())
    return (
        daily_funding(backs)
        .join(projects.select("id", "goal"), "id")
        .select("id", "backing", "amount", running.alias("running"), "goal")
    )


def days_to_funding(projects: DataFrame, backs: DataFrame, selective: bool = False) -> DataFrame:
    """``(id, days)`` for each given project: days from creation to the goal.

    NULL when the goal is not reached. Several pledges on the day of crossing
    make no difference, as the answer is that day. ``selective`` says that
    ``projects`` is a small part of all, whose pledges are picked out before
    they are added up.
    """
    daily = daily_funding(pledges_of(projects, backs) if selective else backs)
    running = F.sum("amount").over(_upto_day())
    crossed = F.when(F.col("running") >= F.col("goal"), F.col("backing"))
    return (
        projects.select("id", "created", "goal")
        .join(daily, "id", "left")
        .withColumn("running", running)
        .groupBy("id", "created")
        .agg(F.min(crossed).alias("reached"))
        .select("id", days_between(F.col("reached"), F.col("created")).alias("days"))
    )
