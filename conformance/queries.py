"""Every job of the library applied to the driver's tables.

Each query takes the lazily built tables and returns one DataFrame. Jobs with
several outputs return them stacked, with the table's name in front. Sums are
cast to ``DECIMAL(18,2)`` so that both engines report one type.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conformance import broken
from pledgeflow.operators import audit, cascade, ingest, maintenance, reference_state, refunds, rules, verdicts, write_back
from pledgeflow.operators.joins import hot_keys
from pledgeflow.plans import backers, funding, maintained, rankings, sql_functions
from pledgeflow.schema import TABLES
from pledgeflow.session import working_folder
from pledgeflow.sources import files
from pledgeflow.sources.adapters import DriverTables
from pledgeflow.sources.versions import Store
from pledgeflow.streaming import guards

# Parameters of the driver data, the same in the oracle.
EARLY, LATE, PTYPE, TOP_N = "2000-01-01", "2001-06-30", "PROMO", 20

# Shares of all rows from which a key counts as hot; low, so that many do.
HOT_PARTS = 500

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: The jobs themselves, over any mapping of table names to DataFrames.
JOBS: dict[str, Callable] = {}


def query(job: Callable[[DriverTables], DataFrame]) -> Callable[[DriverTables], DataFrame]:
    JOBS[job.__name__] = job
    QUERIES[job.__name__] = lambda spark, folder: job(DriverTables(spark, folder))
    return job


def _pledges_held(t):
    """``t`` with its pledges stored: a job that reads them several times derives them once."""
    if isinstance(t, DriverTables):
        t.hold("backs")
    return t


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in columns})


def _stack(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows(name: str, df: DataFrame, key: str = "email", detail: str | None = None) -> DataFrame:
    return df.select(
        F.lit(name).alias("table_name"),
        F.col(key).cast("string").alias("row_key"),
        (F.col(detail) if detail else F.lit(None)).cast("string").alias("detail"),
    )


# --- table maintenance -------------------------------------------------------


@query
def scan_projects(t):
    return t["projects"]


@query
def append_backs(t):
    key = list(TABLES["backs"].key)
    clashes = audit.key_conflicts(t["offered_backs"], key, t["backs"]).select(*key)
    fresh = t["offered_backs"].join(clashes, key, "left_anti").select(*t["backs"].columns)
    return maintenance.append_positional(t["backs"], fresh.toDF(*"abcdef"))


@query
def append_named(t):
    return maintenance.append_named(t["users"], t["registrations"].select("cc1", "name", "email"))


@query
def default_status(t):
    requests = t["backs"].filter(F.col("request").isNotNull()).select("email", "id", "request")
    return maintenance.fill_default(requests, "status", F.lit(refunds.PENDING))


@query
def apply_request_updates(t):
    return maintenance.apply_request_updates(t["backs"], t["request_changes"])


@query
def delete_users(t):
    left = maintenance.delete_users(t, t["delete_list"])
    return _stack(*[_rows(name, df) for name, df in left.items()])


@query
def assign_ids(t):
    return maintenance.assign_ids(t["projects"].select("name", "ptype", "goal"))


@query
def assign_ids_summary(t):
    return maintenance.assign_ids(t["updates"].select("time", "message")).agg(
        F.count("id").alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


# --- integrity audits --------------------------------------------------------


def _with_registered(t) -> dict[str, DataFrame]:
    """The tables after an unchecked append of all registrations that ask to back."""
    new = t["registrations"].filter(F.col("kind").isin(ingest.BACKER, ingest.BOTH))
    tables = {name: t[name] for name in TABLES}
    tables["backers"] = t["backers"].unionByName(new.select(*t["backers"].columns))
    return tables


@query
def audit_not_null(t):
    return audit.audit_all_rows(_with_registered(t), ["not_null"])


@query
def audit_check(t):
    return audit.audit_all_rows(t, ["check"])


@query
def audit_broken_rows(t):
    """All NOT NULL and CHECK rules, each broken in some rows of its table."""
    tables = {}
    for name, spec in TABLES.items():
        new = broken.replaced(name, list(spec.required))
        tables[name] = t[name].select(*[F.expr(new[c]).alias(c) if c in new else c for c in t[name].columns])
    return audit.audit_all_rows(tables)


@query
def audit_broken_keys(t):
    """Every table with some rows twice."""
    some = {n: t[n].filter(f"{broken.NUMBER[n]} % {broken.TWICE} = 0") for n in TABLES}
    return audit.audit_all_keys({n: t[n].unionByName(some[n]) for n in TABLES})


@query
def audit_domain(t):
    status = refunds.refund_status(t["backs"], t["refunds"])
    labelled = status.withColumn("status", F.when(F.col("id") % 100 == 0, "unknown").otherwise(F.col("status")))
    allowed = (refunds.PENDING, refunds.APPROVE, refunds.REJECT)
    return audit.audit_domain(labelled, "refund_status", ["email", "id"], "status", allowed)


@query
def audit_unique(t):
    t = _pledges_held(t)
    tables = {name: t[name] for name in TABLES}
    tables["backs"] = t["backs"].unionByName(t["offered_backs"])
    return audit.audit_all_keys(tables)


@query
def audit_unique_digest(t):
    t = _pledges_held(t)
    backs = t["backs"].unionByName(t["offered_backs"])
    return _stack(
        *[audit.audit_unique_by_digest(backs if n == "backs" else t[n], n, spec.key) for n, spec in TABLES.items()]
    )


@query
def audit_collision(t):
    return audit.audit_collision(t["offered_backs"], t["backs"], "backs", TABLES["backs"].key)


@query
def audit_fk(t):
    return audit.audit_foreign_keys(t, composite=False)


@query
def audit_fk_composite(t):
    return audit.audit_foreign_keys(t, composite=True)


# Rows that come in later, and rows that go, in the data of the incremental audit: every reference has orphans in the end.
COMING = {"employees": "id % 10 = 7", "projects": "id % 9 = 4", "updates": "id % 3 = 0", "backs": "id % 7 = 1"}
GOING = {
    "employees": "id % 10 = 3", "users": "email LIKE '%7'", "backers": "email LIKE '%5'", "creators": "email LIKE '%4'",
    "project_types": "name = 'PROMO'", "projects": "id % 11 = 2", "rewards": "id % 13 = 5", "backs": "id % 17 = 4",
    "updates": "id % 19 = 1",
}


@query
def audit_fk_changes(t):
    """The state of all references after rows have come in and others have gone."""
    store, tables = Store(t.spark, working_folder(t.spark, "references")), _store(t, *TABLES)
    whole = {n: tables.read(n, 0) for n in TABLES}
    split = lambda rows: ({n: whole[n].filter(c) for n, c in rows.items()}, {n: whole[n].filter(f"NOT ({c})") for n, c in rows.items()})
    coming, before = split(COMING)
    going, after = split(GOING)
    reference_state.start(store, whole | before, buckets=4)
    reference_state.update(store, whole, coming, {})
    reference_state.update(store, whole | after, {}, going)
    return reference_state.violations(store)


@query
def cast_quarantine(t):
    return audit.cast_quarantine(t["raw_dates"], "raw")


@query
def cascade_key_update(t):
    new = cascade.cascade_key_update(t, "users", "email", t["email_map"], force=True)
    return _stack(
        *[_rows(name, new[name]) for name in ("users", "backers", "creators")],
        _rows("projects", new["projects"], "id", "email"),
    )


@query
def cascade_type_rename(t):
    mapping = t["project_types"].select(
        F.col("name").alias("old_value"), F.concat(F.lit("new "), "name").alias("new_value")
    )
    new = cascade.cascade_key_update(t, "project_types", "name", mapping)
    return _stack(
        _rows("project_types", new["project_types"], "name"), _rows("projects", new["projects"], "id", "ptype")
    )


@query
def cascade_project_ids(t):
    mapping = t["projects"].select(
        F.col("id").alias("old_value"), (F.col("id") + F.lit(5000000)).alias("new_value")
    )
    new = cascade.cascade_key_update(t, "projects", "id", mapping, force=True)
    return _stack(
        _rows("projects", new["projects"], "id", "name"),
        _rows("updates", new["updates"], "id", "message"),
        _rows("rewards", new["rewards"], "id", "name"),
    )


@query
def blocked_key_update(t):
    return cascade.blocked_key_update(t, "users", "email", t["email_map"])


@query
def cascade_delete(t):
    left = cascade.cascade_delete(t, "users", t["delete_list"])
    return _stack(*[_rows(name, df) for name, df in left.items()])


@query
def cascade_delete_projects(t):
    left = cascade.cascade_delete(t, "projects", t["project_delete_list"])
    return _stack(
        _rows("projects", left["projects"], "id", "name"),
        _rows("updates", left["updates"], "id", "message"),
        _rows("rewards", left["rewards"], "id", "name"),
    )


@query
def cascade_delete_pledges(t):
    gone = refunds.late_requests(t["backs"], t["projects"]).withColumnRenamed("pid", "id")
    left = cascade.cascade_delete(t, "backs", gone)
    return _stack(_rows("backs", left["backs"], "email", "id"), _rows("refunds", left["refunds"], "email", "pid"))


@query
def blocked_delete(t):
    return cascade.blocked_delete(t, "users", t["delete_list"])


@query
def blocked_delete_strict(t):
    return cascade.blocked_delete(t, "users", t["delete_list"], cascade=False)


# --- the same changes in stored tables, by file ------------------------------


def _store(t, *names: str) -> Store:
    store = Store(t.spark, working_folder(t.spark, "store"))
    store.create({name: t[name] for name in names})
    return store


@query
def write_back_requests(t):
    store = _store(t, "backs")
    write_back.update_requests(store, t["request_changes"])
    return store.read("backs")


@query
def write_back_users(t):
    store = _store(t, "users", "backers", "creators")
    write_back.delete_users(store, t["delete_list"])
    return _stack(*[_rows(name, store.read(name)) for name in ("backers", "creators", "users")])


@query
def write_back_keys(t):
    store = _store(t, "users", "backers", "creators", "projects")
    write_back.update_keys(store, "users", "email", t["email_map"], force=True)
    return _stack(
        *[_rows(name, store.read(name)) for name in ("users", "backers", "creators")],
        _rows("projects", store.read("projects"), "id", "email"),
    )


@query
def write_back_deletes(t):
    t = _pledges_held(t)
    store = _store(t, "backs", "refunds")
    gone = refunds.late_requests(t["backs"], t["projects"]).withColumnRenamed("pid", "id")
    write_back.delete_rows(store, "backs", gone)
    return _stack(_rows("backs", store.read("backs"), "email", "id"), _rows("refunds", store.read("refunds"), "email", "pid"))


# --- ingest rules ------------------------------------------------------------


@query
def rule_user_role(t):
    return rules.judge_user_roles(t["users"], t["backers"], t["creators"])


@query
def rule_pledge_min(t):
    return rules.judge_pledge_minimum(t["backs"], t["rewards"])


@query
def rule_project_reward(t):
    loads = t["project_loads"]
    levels = loads.select("id", F.explode(ingest.paired_prefix(F.col("names"), F.col("amounts"))).alias("l"))
    batch = loads.select("id", "email", "ptype", "name")
    return rules.judge_project_rewards(batch, levels.select("id", "l.name"))


@query
def rule_refund_decision(t):
    return rules.judge_refund_decisions(t["refunds"], t["backs"], t["projects"])


@query
def rule_pledge_dates(t):
    return rules.judge_pledge_dates(t["backs"], t["projects"])


@query
def rule_request_success(t):
    return rules.judge_request_changes(t["request_changes"], t["backs"], t["projects"])


@query
def rule_request_locked(t):
    return rules.judge_request_changes(
        t["request_changes"], t["backs"], t["projects"], lock_existing=True
    )


def _judged_pledges(t, pledges: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    return rules.judge_pledges(pledges, t["projects"], t["rewards"], t["backers"], stored)


@query
def ingest_pledges(t):
    return _judged_pledges(t, t["backs"])


@query
def ingest_pledges_again(t):
    """The offered pledges against a table that already holds the first ones."""
    t = _pledges_held(t)
    return _judged_pledges(t, t["offered_backs"], t["backs"])


@query
def ingest_policy(t):
    t = _pledges_held(t)
    judged = verdicts.held(_judged_pledges(t, t["backs"]))
    kept = verdicts.apply_policy(judged).accepted
    outcomes = {
        "quarantine": kept,
        "strict": verdicts.apply_policy(judged, strict=True, stored=True).accepted,
        "strict, clean batch": verdicts.apply_policy(_judged_pledges(t, kept), strict=True).accepted,
    }
    return _stack(*[_rows(policy, df, "email", "id") for policy, df in outcomes.items()])


# --- ingest and processing jobs ----------------------------------------------


@query
def register_users(t):
    new = ingest.register_users(t["registrations"], t)
    rejected = new.pop("rejected")
    return _stack(
        *[_rows(name, df, "email", None if name == "users" else "country") for name, df in new.items()],
        _rows("rejected", rejected, "email", "reason"),
    )


@query
def load_projects(t):
    new = ingest.load_projects(t["project_loads"], t)
    levels = new["rewards"].withColumn("level", F.concat_ws(" ", "name", F.col("min_amt").cast("decimal(18,2)")))
    return _stack(
        _rows("projects", new["projects"], "id", "name"),
        _rows("rewards", levels, "id", "level"),
        _rows("rejected", new["rejected"], "id", "reason"),
    )


@query
def auto_reject(t):
    return refunds.auto_reject(t["backs"], t["projects"], t["refunds"], 1, EARLY)


@query
def auto_reject_strict(t):
    return refunds.auto_reject(
        t["backs"], t["projects"], t["refunds"], 1, EARLY, strict=True
    )


@query
def refund_status(t):
    return refunds.refund_status(t["backs"], t["refunds"])


# --- analytics ---------------------------------------------------------------


@query
def project_totals(t):
    return _money(funding.project_totals(t["backs"]), "amount")


@query
def window_totals(t):
    """Pledged per project in half a year, from pledges laid out by project and month."""
    folder = working_folder(t.spark, "layout")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    laid_out = files.save_layout(t["backs"], name, folder, buckets=8, day="backing")
    return _money(funding.project_totals(files.in_window(laid_out, "backing", "1996-02-10", "1996-08-09")), "amount")


@query
def reward_counts(t):
    return funding.reward_counts(t["rewards"])


@query
def successful_projects(t):
    return _money(funding.successful_projects(t["projects"], t["backs"], EARLY), "amount")


@query
def successful_projects_rows(t):
    return funding.successful_projects_rows(t["projects"], t["backs"], EARLY)


@query
def verified_users(t):
    return backers.verified_users(t["users"], t["verifies"], EARLY)


@query
def days_to_funding(t):
    return funding.days_to_funding(t["projects"], t["backs"])


@query
def superbackers_breadth(t):
    return backers.superbackers_breadth(t, EARLY)


@query
def superbackers_amount(t):
    return backers.superbackers_amount(t, EARLY)


@query
def find_superbackers(t):
    return backers.find_superbackers(t, EARLY)


@query
def find_top_success(t):
    return _money(rankings.find_top_success(t["projects"], t["backs"], TOP_N, LATE, PTYPE), "amount")


@query
def top_success_rejoin(t):
    return _money(rankings.top_success_rejoin(t["projects"], t["backs"], TOP_N, LATE, PTYPE), "amount")


@query
def top_success_struct(t):
    whole = find_top_success(t).select(F.struct("*").alias("find_top_success"))
    return whole.select("find_top_success.*")


@query
def find_top_popular(t):
    return rankings.find_top_popular(t["projects"], t["backs"], TOP_N, LATE, PTYPE)


@query
def top_popular_funded(t):
    return rankings.top_popular_funded(t["projects"], t["backs"], TOP_N, LATE, PTYPE)


@query
def daily_funding(t):
    return _money(funding.daily_funding(t["backs"]), "amount")


@query
def funding_curve(t):
    return _money(funding.funding_curve(t["projects"], t["backs"]), "amount", "running")


def _maintained(t) -> DataFrame:
    """Funding after pledges have come in two batches, those of some backers have gone and some amounts have changed."""
    store = Store(t.spark, working_folder(t.spark, "funding-state"))
    backs = _pledges_held(t)["backs"]
    maintained.create(store, backs.filter("id % 3 <> 0"), buckets=8)
    maintained.update(store, added=backs.filter("id % 3 = 0"), tag="1")
    maintained.update(store, added=backs.filter("id % 3 = 0"), tag="1")
    maintained.update(store, removed=backs.join(t["delete_list"].select("email"), "email", "left_semi"), tag="2")
    kept = backs.join(t["delete_list"].select("email"), "email", "left_anti").filter("id % 5 = 0")
    maintained.update(store, kept.withColumn("amount", 2 * F.col("amount")), kept, tag="3")
    return maintained.daily(store)


@query
def maintained_curve(t):
    return _money(funding.funding_curve(t["projects"], _maintained(t)), "amount", "running")


@query
def maintained_success(t):
    return _money(funding.successful_projects(t["projects"], _maintained(t), EARLY), "amount")


@query
def projects_by_type(t):
    return funding.projects_by_type(t["projects"], PTYPE)


@query
def sql_successful_projects(t):
    sql_functions.register(t.spark, t)
    return _money(t.spark.sql("SELECT * FROM successful_projects(:day)", args={"day": EARLY}), "amount", "goal")


@query
def sql_verified_users(t):
    sql_functions.register(t.spark, t)
    return t.spark.sql("SELECT * FROM verified_users(:day)", args={"day": EARLY})


def _sql(t, text: str, **args) -> DataFrame:
    sql_functions.register(t.spark, t)
    return t.spark.sql(text, args=args)


@query
def sql_find_top_success(t):
    top = _sql(t, "SELECT * FROM find_top_success(:n, :day, :ptype)", n=TOP_N, day=LATE, ptype=PTYPE)
    return _money(top, "amount")


@query
def sql_find_top_popular(t):
    return _sql(t, "SELECT * FROM find_top_popular(:n, :day, :ptype)", n=TOP_N, day=LATE, ptype=PTYPE)


@query
def sql_find_superbackers(t):
    return _sql(t, "SELECT * FROM find_superbackers(:day)", day=EARLY)


@query
def sql_days_to_funding(t):
    return _sql(t, "SELECT * FROM days_to_funding()")


# --- jobs with hot keys spread --------------------------------------------------


@query
def ingest_pledges_hot(t):
    return rules.judge_pledges(t["backs"], t["projects"], t["rewards"], t["backers"], hot=t.hot(HOT_PARTS))


@query
def audit_fk_hot(t):
    hot = {
        "backs": t.hot(HOT_PARTS),
        "projects": {"email": hot_keys(t["projects"].select("email"), ["email"], HOT_PARTS)},
        "verifies": {"id": hot_keys(t["verifies"].select("id"), ["id"], HOT_PARTS)},
    }
    return audit.audit_foreign_keys(t, composite=False, hot=hot)


@query
def superbackers_hot(t):
    return backers.find_superbackers(t, EARLY, hot_ids=t.hot(HOT_PARTS)["id"])


@query
def load_delimited(t):
    """Lines of text as a dump has them: some without a key, some with a date that does not parse."""
    orders = t.source("orders")
    key = F.when(F.col("o_orderstatus") == "P", "\\N").otherwise(F.col("o_orderkey").cast("string"))
    day = F.when(F.col("o_orderpriority") == "1-URGENT", "31/12/1998").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    lines = orders.select(F.concat_ws(",", key, F.col("o_custkey").cast("string"), day).alias("value"))
    marker = t.spark.createDataFrame([("\\.",)], "value string")
    return files.parse_delimited(lines.union(marker), T.StructType([
        T.StructField("id", T.LongType(), False), T.StructField("customer", T.LongType()), T.StructField("day", T.DateType()),
    ]))


@query
def load_copy(t):
    """Text files of a dump: of each, only what stands before its end marker."""
    folder = working_folder(t.spark, "dump")
    orders = t.source("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"))
    line = F.concat_ws(",", F.col("id").cast("string"), F.col("customer").cast("string")).alias("value")
    marker = t.spark.createDataFrame([("\\.",)], "value string")
    for n in range(3):
        own = orders.filter(F.col("id") % 3 == n)
        before, behind = own.filter("customer % 4 <> 1").select(line), own.filter("customer % 4 = 1").select(line)
        before.union(marker).union(behind).coalesce(1).write.text(f"{folder}/{n}")
    loaded = files.load_delimited(t.spark, f"{folder}/*", T.StructType([
        T.StructField("id", T.LongType(), False), T.StructField("customer", T.LongType(), False),
    ]))
    return loaded.select("id", "customer", "reason")


@query
def assign_ids_ordered(t):
    """Two batches of projects, each in the order of name and id; the second goes on behind the first and is sent twice."""
    marks = working_folder(t.spark, "marks")
    batch = lambda odd: t["projects"].filter(F.col("id") % 2 == odd).select("name", F.col("id").alias("project"))
    give = lambda odd: maintenance.assign_next_ids(batch(odd), marks, f"batch {odd}", "serial", ["name", "project"])
    first, _, second = give(0), give(1), give(1)
    return first.unionByName(second)


# --- the same rules on streams -----------------------------------------------


def _replayed(t, name: str, start: Callable) -> DataFrame:
    """Store a view, stream it through a guard in several micro-batches, return the verdicts."""
    return guards.replay(t[name], name, start)


@query
def stream_pledges(t):
    return _replayed(
        t, "backs",
        lambda s, sink: guards.guard_pledges(s, sink, t["projects"], t["rewards"], t["backers"]),
    )


@query
def stream_pledges_again(t):
    """Offered pledges, of which some have a stored key."""
    t = _pledges_held(t)
    return _replayed(
        t, "offered_backs",
        lambda s, sink: guards.guard_pledges(
            s, sink, lambda: t["projects"], lambda: t["rewards"], lambda: t["backers"], lambda: t["backs"]
        ),
    )


@query
def stream_pledges_returning(t):
    """Every pledge comes a second time in a later micro-batch; accepted keys are folded into runs in between."""
    t = _pledges_held(t)
    return guards.replay(
        [t["backs"], t["backs"]], "returning",
        lambda s, sink: guards.guard_pledges(s, sink, t["projects"], t["rewards"], t["backers"], fan=2, bucket_rows=4_000),
    )


@query
def stream_refunds(t):
    t = _pledges_held(t)
    return _replayed(
        t, "refunds",
        lambda s, sink: guards.guard_refunds(
            s, sink, t["backs"], t["projects"], t["employees"]
        ),
    )


@query
def stream_request_changes(t):
    t = _pledges_held(t)
    return _replayed(
        t, "request_changes",
        lambda s, sink: guards.guard_request_changes(s, sink, t["backs"], t["projects"]),
    )


@query
def stream_registrations(t):
    return _replayed(t, "registrations", lambda s, sink: guards.guard_registrations(s, sink, t))


@query
def stream_project_loads(t):
    return _replayed(t, "project_loads", lambda s, sink: guards.guard_project_loads(s, sink, t)).select(
        "id", "email", "ptype", "reason"
    )
