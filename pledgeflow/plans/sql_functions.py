"""The parameterised reports as SQL table functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pledgeflow.plans import backers

#: Views of the session that the functions read have names that begin so.
PREFIX = "pledgeflow_"

# Parameters are qualified by the function's name: a bare name would bind to a
# column of the same name first. Names of the functions and of their columns.
_TOTALS = "SELECT id, SUM(amount) AS amount FROM {p}backs GROUP BY id"
_CURVE = """
    SELECT id, backing, SUM(amount) OVER (PARTITION BY id ORDER BY backing) AS running
    FROM (SELECT b.id, b.backing, SUM(b.amount) AS amount FROM {p}backs b
          LEFT SEMI JOIN {p}projects q ON q.id = b.id{only} GROUP BY b.id, b.backing)"""
_SHARE = "(s.amount - s.amount % p.goal) / p.goal DESC, CAST(s.amount % p.goal AS DECIMAL(18, 4)) / CAST(p.goal AS DECIMAL(18, 4)) DESC"

FUNCTIONS = (
    """
CREATE OR REPLACE TEMPORARY FUNCTION successful_projects(given_date DATE)
RETURNS TABLE (id BIGINT, c_email STRING, c_ptype STRING, c_date DATE, pname STRING,
               deadline DATE, goal DECIMAL(38, 4), amount DECIMAL(38, 4))
RETURN
  SELECT p.id, p.email, p.ptype, p.created, p.name, p.deadline, p.goal, s.amount
  FROM {p}projects p
  JOIN ({totals}) s ON p.id = s.id
  WHERE p.goal <= s.amount AND p.deadline < successful_projects.given_date
""",
    """
CREATE OR REPLACE TEMPORARY FUNCTION verified_users(given_date DATE)
RETURNS TABLE (email STRING, name STRING, cc1 STRING, cc2 STRING)
RETURN
  SELECT u.email, u.name, u.cc1, u.cc2
  FROM {p}users u
  LEFT SEMI JOIN {p}verifies v ON v.email = u.email AND v.verified <= verified_users.given_date
""",
    # The best n by row number: only n rows of each task get to the final order.
    """
CREATE OR REPLACE TEMPORARY FUNCTION find_top_success(n INT, today DATE, ptype STRING)
RETURNS TABLE (id BIGINT, name STRING, email STRING, amount DECIMAL(38, 2))
RETURN
  SELECT id, name, email, amount FROM (
    SELECT p.id, p.name, p.email, s.amount,
           ROW_NUMBER() OVER (PARTITION BY p.ptype ORDER BY {share}, p.deadline DESC, p.id) AS place
    FROM {p}projects p
    JOIN (SELECT b.id, SUM(b.amount) AS amount FROM {p}backs b
          LEFT SEMI JOIN {p}projects q ON q.id = b.id AND q.ptype = find_top_success.ptype GROUP BY b.id) s
      ON p.id = s.id
    WHERE p.ptype = find_top_success.ptype AND p.goal <= s.amount AND p.deadline < find_top_success.today)
  WHERE place <= find_top_success.n
  ORDER BY place
""",
    """
CREATE OR REPLACE TEMPORARY FUNCTION find_top_popular(n INT, today DATE, ptype STRING)
RETURNS TABLE (id BIGINT, name STRING, email STRING, days INT)
RETURN
  SELECT id, name, email, days FROM (
    SELECT id, name, email, days, ROW_NUMBER() OVER (PARTITION BY ptype ORDER BY days ASC NULLS LAST, id) AS place
    FROM (
      SELECT p.id, p.name, p.email, p.ptype, DATEDIFF(MIN(c.backing), p.created) AS days
      FROM {p}projects p LEFT JOIN ({curve_of_type}) c ON c.id = p.id AND c.running >= p.goal
      WHERE p.ptype = find_top_popular.ptype AND p.created < find_top_popular.today
      GROUP BY p.id, p.name, p.email, p.ptype, p.created))
  WHERE place <= find_top_popular.n
  ORDER BY place
""",
    """
CREATE OR REPLACE TEMPORARY FUNCTION find_superbackers(
  today DATE, recent_days INT DEFAULT {recent_days}, min_projects INT DEFAULT {min_projects},
  min_types INT DEFAULT {min_types}, min_amount DECIMAL(18, 4) DEFAULT {min_amount})
RETURNS TABLE (email STRING, name STRING)
RETURN
  SELECT u.email, u.name
  FROM (
    SELECT b.email, COUNT(*) AS n_projects, COUNT(DISTINCT w.ptype) AS n_types, SUM(b.amount) AS amount
    FROM {p}backs b
    JOIN (
      SELECT p.id, p.ptype
      FROM {p}projects p
      JOIN (SELECT c.id, SUM(c.amount) AS amount FROM {p}backs c
            LEFT SEMI JOIN {p}projects q ON q.id = c.id AND q.deadline < find_superbackers.today
              AND q.deadline >= DATE_SUB(find_superbackers.today, find_superbackers.recent_days)
            GROUP BY c.id) s ON p.id = s.id
      WHERE p.goal <= s.amount AND p.deadline < find_superbackers.today
        AND p.deadline >= DATE_SUB(find_superbackers.today, find_superbackers.recent_days)) w ON w.id = b.id
    GROUP BY b.email) f
  JOIN {p}users u ON u.email = f.email
  LEFT SEMI JOIN {p}verifies v ON v.email = u.email AND v.verified <= find_superbackers.today
  LEFT JOIN (SELECT DISTINCT email, TRUE AS asked FROM {p}backs
             WHERE request >= DATE_SUB(find_superbackers.today, find_superbackers.recent_days)) a ON a.email = f.email
  WHERE f.n_projects >= find_superbackers.min_projects AND f.n_types >= find_superbackers.min_types
    OR f.amount >= find_superbackers.min_amount AND a.asked IS NULL
  ORDER BY u.email, u.name
""",
    """
CREATE OR REPLACE TEMPORARY FUNCTION days_to_funding()
RETURNS TABLE (id BIGINT, days INT)
RETURN
  SELECT p.id, DATEDIFF(MIN(c.backing), p.created) AS days
  FROM {p}projects p LEFT JOIN ({curve}) c ON c.id = p.id AND c.running >= p.goal
  GROUP BY p.id, p.created
""",
)


def register(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = PREFIX) -> None:
    """Make the reports callable in SQL, such as ``find_top_success(n, day, type)``.

    Top lists and superbackers come in their order where a query takes them as they are; the thresholds of
    superbackers may be given after the day.
    The tables they read become temporary views of the session, ``prefix`` before their names.
    """
    for name in ("projects", "backs", "users", "verifies"):
        tables[name].createOrReplaceTempView(f"{prefix}{name}")
    parts = {
        "totals": _TOTALS.format(p=prefix),
        "curve": _CURVE.format(p=prefix, only=""),
        "curve_of_type": _CURVE.format(p=prefix, only=" AND q.ptype = find_top_popular.ptype"),
        "share": _SHARE,
        "recent_days": backers.RECENT_DAYS,
        "min_projects": backers.MIN_PROJECTS,
        "min_types": backers.MIN_TYPES,
        "min_amount": backers.MIN_AMOUNT,
    }
    for text in FUNCTIONS:
        spark.sql(text.format(p=prefix, **parts))
