"""The model's tables derived from the driver's star-schema Parquet files.

The driver's tables hold no pledges, so each table of the model is a view over
them. Remainders of the numeric keys stand in for attributes the source lacks
(tier, second card, kind); they decide which outcome a row meets. Which rows have a
role, a tier or a decision is decided by values of the data, and every row of the source
table is read.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgeflow.functions.expressions import money_array, text_array
from pledgeflow.operators.joins import hot_keys
from pledgeflow.session import put_by, working_folder

# Column types of the driver's files.
SOURCE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}

#: Reward tiers: name and factor on the part's retail price.
TIERS = (("bronze", 10), ("silver", 30), ("gold", 60))


class DriverTables(dict):
    """``name -> DataFrame`` of the model's tables and batches, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark = spark
        self.folder = folder

    def __missing__(self, name: str) -> DataFrame:
        view = VIEWS[name](self)
        self[name] = view
        return view

    def hold(self, name: str) -> DataFrame:
        """The view, stored in the shared folder: jobs that read it several times derive it once.

        Ask for it before the views that are derived from it, so that these read the stored rows too.
        """
        self[name] = put_by(self[name], working_folder(self.spark, f"held-{name}"))
        return self[name]

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def hot(self, parts: int) -> dict[str, DataFrame]:
        """Hot project ids and backer emails, counted on the source rows of the pledges."""
        lines = self.source("lineitem").select(F.col("l_partkey").alias("id"))
        orders = self.source("orders").select(_text("u", "o_custkey").alias("email"))
        return {"id": hot_keys(lines, ["id"], parts), "email": hot_keys(orders, ["email"], parts)}


def _text(prefix: str, key: str | Column) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), column.cast("string"))


def _money(column: Column) -> Column:
    return column.cast("decimal(18,2)")


def _remainder(key: str, by: int) -> Column:
    return F.col(key) % F.lit(by)


def employees(t: DriverTables) -> DataFrame:
    return t.source("supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        _money(F.col("s_acctbal")).alias("salary"),
    )


def users(t: DriverTables) -> DataFrame:
    second_card = F.when(_remainder("c_custkey", 3) != 0, _text("cc", _remainder("c_custkey", 5)))
    customers = t.source("customer").select(
        _text("u", "c_custkey").alias("email"),
        F.col("c_name").alias("name"),
        _text("cc", _remainder("c_custkey", 7)).alias("cc1"),
        second_card.alias("cc2"),
    )
    suppliers = t.source("supplier").select(
        _text("s", "s_suppkey").alias("email"),
        F.col("s_name").alias("name"),
        _text("cc", _remainder("s_suppkey", 7)).alias("cc1"),
        F.lit(None).cast("string").alias("cc2"),
    )
    return customers.union(suppliers)


def _customer_addresses(t: DriverTables) -> DataFrame:
    return (
        t.source("customer")
        .join(t.source("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.col("c_mktsegment").alias("street"),
            F.col("c_custkey").cast("string").alias("num"),
            F.col("c_nationkey").cast("string").alias("zip"),
            F.col("n_name").alias("country"),
        )
    )


def backers(t: DriverTables) -> DataFrame:
    return (
        _customer_addresses(t)
        .filter(F.col("c_acctbal") > -900)
        .select(_text("u", "c_custkey").alias("email"), "street", "num", "zip", "country")
    )


def creators(t: DriverTables) -> DataFrame:
    prefix = F.when(_remainder("s_suppkey", 2) == 0, "u").otherwise("s")
    return (
        t.source("supplier")
        .join(t.source("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(prefix, F.col("s_suppkey").cast("string")).alias("email"),
            F.col("n_name").alias("country"),
        )
    )


def verifies(t: DriverTables) -> DataFrame:
    return (
        t.source("customer")
        .filter(F.col("c_acctbal") > 0)
        .select(
            _text("u", "c_custkey").alias("email"),
            F.col("c_nationkey").cast("bigint").alias("id"),
            F.date_add(F.lit("1995-01-01").cast("date"), _remainder("c_custkey", 2000).cast("int")).alias("verified"),
        )
    )


def project_types(t: DriverTables) -> DataFrame:
    return (
        t.source("part")
        .groupBy(F.col("p_type").alias("name"))
        .agg((F.min("p_partkey") % F.lit(10)).alias("id"))
    )


def projects(t: DriverTables) -> DataFrame:
    prefix = F.when(_remainder("p_partkey", 2) == 0, "u").otherwise("s")
    return t.source("part").select(
        F.col("p_partkey").alias("id"),
        F.concat(prefix, _remainder("p_partkey", 10).cast("string")).alias("email"),
        F.col("p_type").alias("ptype"),
        F.date_add(F.lit("1995-01-01").cast("date"), _remainder("p_partkey", 365).cast("int")).alias("created"),
        F.col("p_name").alias("name"),
        F.date_add(F.lit("1998-12-31").cast("date"), (F.lit(180) * _remainder("p_size", 5)).cast("int")).alias("deadline"),
        _money(_money(F.col("p_retailprice")) * F.lit(1600)).alias("goal"),
    )


def updates(t: DriverTables) -> DataFrame:
    return t.source("events").select(
        F.col("ts").alias("time"),
        _remainder("user_id", 200).alias("id"),
        F.col("event_type").alias("message"),
    )


def rewards(t: DriverTables) -> DataFrame:
    tiers = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(factor).alias("factor")) for name, factor in TIERS]
    )
    return (
        t.source("part")
        .filter(F.col("p_size") != 25)
        .select("p_partkey", "p_retailprice", F.explode(tiers).alias("tier"))
        .select(
            F.col("tier.name").alias("name"),
            F.col("p_partkey").alias("id"),
            _money(_money(F.col("p_retailprice")) * F.col("tier.factor")).alias("min_amt"),
        )
    )


def backs(t: DriverTables) -> DataFrame:
    """One pledge per customer and part: their line items added up.

    Prices are whole cents, so they are added as integers: cheaper per line
    than decimals, and as exact. Lines and orders are shuffled with what the pledges are made of, days and cents, and no more.
    """
    lines = t.source("lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).cast("date").alias("returned"),
        F.floor(F.col("l_extendedprice") * 100 + F.lit(0.5)).alias("cents"),
    )
    orders = t.source("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("ordered"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "l_partkey")
        .agg(
            (F.min("l_linenumber") % F.lit(3)).alias("tier"),
            F.min("ordered").alias("backing"),
            F.min("returned").alias("request"),
            F.sum("cents").alias("cents"),
        )
        .select(
            _text("u", "o_custkey").alias("email"),
            F.when(F.col("tier") == 0, "bronze").when(F.col("tier") == 1, "silver").otherwise("gold").alias("name"),
            F.col("l_partkey").alias("id"),
            "backing",
            "request",
            _money(F.col("cents").cast("decimal(20,0)") * F.lit(Decimal("0.01"))).alias("amount"),
        )
    )


def refunds(t: DriverTables) -> DataFrame:
    """Requests of the first half of a year have been decided."""
    return (
        t["backs"]
        .filter(F.month("request") <= 6)
        .select(
            "email",
            F.col("id").alias("pid"),
            _remainder("id", 10).alias("eid"),
            F.date_add("request", 7).alias("date"),
            (_remainder("id", 8) == 0).alias("accepted"),
        )
    )


def request_changes(t: DriverTables) -> DataFrame:
    """A proposed refund request for every pledge; some clear the request."""
    return t["backs"].select(
        "email",
        "id",
        F.when(_remainder("id", 10) != 6, F.date_add("backing", 1500)).alias("new_request"),
    )


def delete_list(t: DriverTables) -> DataFrame:
    """Users to delete: customers whose balance is negative."""
    return t.source("customer").filter(F.col("c_acctbal") < 0).select(_text("u", "c_custkey").alias("email"))


def project_delete_list(t: DriverTables) -> DataFrame:
    """Projects to delete: those with the earliest deadline of the data."""
    return t["projects"].filter(F.col("deadline") == F.lit("1998-12-31").cast("date")).select("id")


def email_map(t: DriverTables) -> DataFrame:
    return t["users"].filter(F.col("cc1") == "cc0").select(
        F.col("email").alias("old_value"), F.concat(F.lit("x"), "email").alias("new_value")
    )


def registrations(t: DriverTables) -> DataFrame:
    second_card = F.when(_remainder("c_custkey", 3) != 0, _text("cc", _remainder("c_custkey", 5)))
    kind = (
        F.when(_remainder("c_custkey", 4) == 0, "BACKER")
        .when(_remainder("c_custkey", 4) == 1, "CREATOR")
        .when(_remainder("c_custkey", 4) == 2, "BOTH")
        .otherwise("NEITHER")
    )
    return (
        t.source("customer")
        .join(t.source("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _text("r", "c_custkey").alias("email"),
            F.col("c_name").alias("name"),
            _text("cc", _remainder("c_custkey", 7)).alias("cc1"),
            second_card.alias("cc2"),
            F.when(_remainder("c_custkey", 30) != 0, F.col("c_mktsegment")).alias("street"),
            F.col("c_custkey").cast("string").alias("num"),
            F.col("c_nationkey").cast("string").alias("zip"),
            F.col("n_name").alias("country"),
            kind.alias("kind"),
        )
    )


def project_loads(t: DriverTables) -> DataFrame:
    names = F.when(_remainder("id", 7) == 0, "{}").otherwise("{bronze, silver, gold}")
    amounts = (
        F.when(_remainder("id", 3) == 1, "{10,30,60,2}")
        .when(_remainder("id", 11) == 0, "{}")
        .otherwise("{10,30,60}")
    )
    return t["projects"].select(
        (F.col("id") + F.lit(1000000)).alias("id"),
        "email", "ptype", "created", "name", "deadline", "goal",
        text_array(names).alias("names"),
        money_array(amounts).alias("amounts"),
    )


def raw_dates(t: DriverTables) -> DataFrame:
    raw = (
        F.when(_remainder("id", 50) == 0, "hello")
        .when(_remainder("id", 50) == 1, "")
        .otherwise(F.col("deadline").cast("string"))
    )
    return t["projects"].select("id", raw.alias("raw"))


def offered_backs(t: DriverTables) -> DataFrame:
    """Every pledge offered again; some for a project id not seen before."""
    moved = F.when(_remainder("id", 10) == 4, F.col("id") + F.lit(2000000)).otherwise(F.col("id"))
    return t["backs"].withColumn("id", moved)


VIEWS: dict[str, Callable[[DriverTables], DataFrame]] = {
    view.__name__: view
    for view in (
        employees, users, backers, creators, verifies, project_types, projects, updates, rewards,
        backs, refunds, request_changes, delete_list, project_delete_list, email_map, registrations,
        project_loads, raw_dates, offered_backs,
    )
}
