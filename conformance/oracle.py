"""SQL text for each registered query, for an independent engine on the same files."""

from __future__ import annotations

from conformance import broken
from conformance.queries import EARLY, LATE, PTYPE, TOP_N

# The model's tables over the driver's tables.
VIEWS = {
    "employees": """
        SELECT s_suppkey AS id, s_name AS name, CAST(s_acctbal AS DECIMAL(18,2)) AS salary FROM supplier""",
    "users": """
        SELECT 'u' || c_custkey AS email, c_name AS name, 'cc' || (c_custkey % 7) AS cc1,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'cc' || (c_custkey % 5) END AS cc2
        FROM customer
        UNION ALL
        SELECT 's' || s_suppkey, s_name, 'cc' || (s_suppkey % 7), NULL FROM supplier""",
    "backers": """
        SELECT 'u' || c_custkey AS email, c_mktsegment AS street, CAST(c_custkey AS VARCHAR) AS num,
               CAST(c_nationkey AS VARCHAR) AS zip, n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > -900""",
    "creators": """
        SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'u' ELSE 's' END || s_suppkey AS email, n_name AS country
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "verifies": """
        SELECT 'u' || c_custkey AS email, CAST(c_nationkey AS BIGINT) AS id,
               CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS verified
        FROM customer WHERE c_acctbal > 0""",
    "project_types": "SELECT p_type AS name, min(p_partkey) % 10 AS id FROM part GROUP BY p_type",
    "projects": """
        SELECT p_partkey AS id,
               CASE WHEN p_partkey % 2 = 0 THEN 'u' ELSE 's' END || (p_partkey % 10) AS email,
               p_type AS ptype,
               CAST(DATE '1995-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS created,
               p_name AS name,
               CAST(DATE '1998-12-31' + CAST(180 * (p_size % 5) AS INTEGER) AS DATE) AS deadline,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 1600 AS DECIMAL(18,2)) AS goal
        FROM part""",
    "updates": "SELECT ts AS time, user_id % 200 AS id, event_type AS message FROM events",
    "rewards": """
        SELECT tier AS name, p_partkey AS id,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * factor AS DECIMAL(18,2)) AS min_amt
        FROM part, (VALUES ('bronze', 10), ('silver', 30), ('gold', 60)) AS tiers(tier, factor)
        WHERE p_size <> 25""",
    "backs": """
        SELECT 'u' || o_custkey AS email,
               CASE min(l_linenumber) % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS name,
               l_partkey AS id,
               CAST(min(o_orderdate) AS DATE) AS backing,
               CAST(min(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS DATE) AS request,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""",
    "refunds": """
        SELECT email, id AS pid, id % 10 AS eid, CAST(request + 7 AS DATE) AS date, id % 8 = 0 AS accepted
        FROM backs WHERE month(request) <= 6""",
    "request_changes": """
        SELECT email, id, CASE WHEN id % 10 = 6 THEN NULL ELSE CAST(backing + 1500 AS DATE) END AS new_request
        FROM backs""",
    "delete_list": "SELECT 'u' || c_custkey AS email FROM customer WHERE c_acctbal < 0",
    "project_delete_list": "SELECT id FROM projects WHERE deadline = DATE '1998-12-31'",
    "email_map": "SELECT email AS old_value, 'x' || email AS new_value FROM users WHERE cc1 = 'cc0'",
    "registrations": """
        SELECT 'r' || c_custkey AS email, c_name AS name, 'cc' || (c_custkey % 7) AS cc1,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'cc' || (c_custkey % 5) END AS cc2,
               CASE WHEN c_custkey % 30 = 0 THEN NULL ELSE c_mktsegment END AS street,
               CAST(c_custkey AS VARCHAR) AS num, CAST(c_nationkey AS VARCHAR) AS zip, n_name AS country,
               CASE c_custkey % 4 WHEN 0 THEN 'BACKER' WHEN 1 THEN 'CREATOR' WHEN 2 THEN 'BOTH'
                    ELSE 'NEITHER' END AS kind
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    # Number of names and amounts that come with a load, and the amounts by position.
    "project_loads": """
        SELECT id + 1000000 AS id, email, ptype, created, name, deadline, goal,
               CASE WHEN id % 7 = 0 THEN 0 ELSE 3 END AS n_names,
               CASE WHEN id % 3 = 1 THEN 4 WHEN id % 11 = 0 THEN 0 ELSE 3 END AS n_amounts
        FROM projects""",
    "load_levels": """
        SELECT l.id, level AS name, CAST(amount AS DECIMAL(18,2)) AS min_amt
        FROM project_loads l, (VALUES (1, 'bronze', 10), (2, 'silver', 30), (3, 'gold', 60)) AS v(pos, level, amount)
        WHERE pos <= least(n_names, n_amounts)""",
    "raw_dates": """
        SELECT id, CASE id % 50 WHEN 0 THEN 'hello' WHEN 1 THEN '' ELSE CAST(deadline AS VARCHAR) END AS raw
        FROM projects""",
    "offered_backs": """
        SELECT email, name, CASE WHEN id % 10 = 4 THEN id + 2000000 ELSE id END AS id, backing, request, amount
        FROM backs""",
    "totals": "SELECT id, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM backs GROUP BY id",
    "status": """
        SELECT b.email, b.id,
               CASE WHEN b.request IS NULL THEN NULL WHEN r.accepted IS NULL THEN 'pending'
                    WHEN r.accepted THEN 'approve' ELSE 'reject' END AS status
        FROM backs b LEFT JOIN refunds r ON r.email = b.email AND r.pid = b.id""",
    "daily": "SELECT id, backing, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM backs GROUP BY id, backing",
    "curve": """
        SELECT d.id, d.backing, d.amount, p.goal,
               CAST(sum(d.amount) OVER (PARTITION BY d.id ORDER BY d.backing) AS DECIMAL(18,2)) AS running
        FROM daily d JOIN projects p ON p.id = d.id""",
    "days": """
        SELECT p.id, CAST(min(c.backing) - any_value(p.created) AS INTEGER) AS days
        FROM projects p LEFT JOIN curve c ON c.id = p.id AND c.running >= c.goal GROUP BY p.id""",
    "late": """
        SELECT b.email, b.id AS pid FROM backs b JOIN projects p ON p.id = b.id
        WHERE b.request IS NOT NULL AND b.request - p.deadline > 90""",
}


def _successful(day: str) -> str:
    return f"""
        SELECT p.id, email AS c_email, ptype AS c_ptype, created AS c_date, name AS pname, deadline, goal, amount
        FROM projects p JOIN totals t ON t.id = p.id AND t.amount >= p.goal WHERE deadline < DATE '{day}'"""


def _verified(day: str) -> str:
    return f"SELECT * FROM users WHERE email IN (SELECT email FROM verifies WHERE verified <= DATE '{day}')"


# What is left of the pledges after the batches of the maintained totals.
VIEWS["changed_backs"] = """
    SELECT * REPLACE (CAST(CASE WHEN id % 5 = 0 THEN 2 * amount ELSE amount END AS DECIMAL(18,2)) AS amount)
    FROM backs WHERE email NOT IN (SELECT email FROM delete_list)"""
VIEWS["profile"] = f"""
    SELECT b.email, count(*) AS n_projects, count(DISTINCT s.c_ptype) AS n_types, sum(b.amount) AS pledged
    FROM backs b JOIN ({_successful(EARLY)}) s ON s.id = b.id AND s.deadline >= DATE '{EARLY}' - 30
    GROUP BY b.email"""
VIEWS["asked"] = f"SELECT DISTINCT email FROM backs WHERE request >= DATE '{EARLY}' - 30"

# Conditions on a verified user's profile.
_BROAD = "f.n_projects >= 5 AND f.n_types >= 3"
_LARGE = "f.pledged >= 1500 AND f.email NOT IN (SELECT email FROM asked)"


def _superbackers(rule: str) -> str:
    return f"""
        SELECT u.email, u.name FROM ({_verified(EARLY)}) u JOIN profile f ON f.email = u.email
        WHERE {rule} ORDER BY u.email, u.name"""


_TOP_SUCCESS = f"""
    SELECT id, pname AS name, c_email AS email, amount FROM ({_successful(LATE)}) WHERE c_ptype = '{PTYPE}'
    ORDER BY amount / goal DESC, deadline DESC, id LIMIT {TOP_N}"""


def _popular(condition: str = "TRUE") -> str:
    return f"""
        SELECT p.id, p.name, p.email, d.days FROM projects p JOIN days d ON d.id = p.id
        WHERE p.ptype = '{PTYPE}' AND p.created < DATE '{LATE}' AND {condition}
        ORDER BY d.days ASC NULLS LAST, p.id LIMIT {TOP_N}"""


# Required columns, keys, checks and references of the model.
_REQUIRED = {
    "employees": "id name salary",
    "users": "email name cc1",
    "verifies": "email id verified",
    "backers": "email street num zip country",
    "creators": "email country",
    "project_types": "name id",
    "projects": "id email ptype created name deadline goal",
    "updates": "time id message",
    "rewards": "name id min_amt",
    "backs": "email name id backing amount",
    "refunds": "email pid eid date accepted",
}
_KEYS = {
    "employees": "id", "users": "email", "verifies": "email", "backers": "email", "creators": "email",
    "project_types": "name", "projects": "id", "updates": "time id", "rewards": "name id",
    "backs": "email id", "refunds": "email pid",
}
_CHECKS = [
    ("employees", "salary > 0"),
    ("users", "cc1 <> cc2"),
    ("projects", "deadline >= created"),
    ("projects", "goal > 0"),
    ("rewards", "min_amt > 0"),
    ("backs", "amount > 0"),
]
_REFERENCES = [
    ("verifies", "email", "users", "email"),
    ("verifies", "id", "employees", "id"),
    ("backers", "email", "users", "email"),
    ("creators", "email", "users", "email"),
    ("project_types", "id", "employees", "id"),
    ("projects", "email", "creators", "email"),
    ("projects", "ptype", "project_types", "name"),
    ("updates", "id", "projects", "id"),
    ("rewards", "id", "projects", "id"),
    ("backs", "email", "backers", "email"),
    ("refunds", "eid", "employees", "id"),
    ("backs", "name id", "rewards", "name id"),
    ("refunds", "email pid", "backs", "email id"),
]


def _key_text(table: str) -> str:
    parts = [
        f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S.%f'), 'NULL')" if c == "time"
        else f"coalesce(CAST({c} AS VARCHAR), 'NULL')"
        for c in _KEYS[table].split()
    ]
    return " || '|' || ".join(parts)


def _violation(table: str, rule: str, detail: str, body: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, {_key_text(table)} AS row_key, {detail} AS detail {body}"


def _not_null() -> str:
    registered = """(SELECT * FROM backers UNION ALL
        SELECT email, street, num, zip, country FROM registrations WHERE kind IN ('BACKER', 'BOTH'))"""
    parts = []
    for table, columns in _REQUIRED.items():
        source = registered if table == "backers" else table
        parts += [
            _violation(table, "not_null", f"'{c}'", f"FROM {source} AS t WHERE {c} IS NULL") for c in columns.split()
        ]
    return "\nUNION ALL\n".join(parts)


def _unique() -> str:
    parts = []
    for table, key in _KEYS.items():
        source = "(SELECT * FROM backs UNION ALL SELECT * FROM offered_backs)" if table == "backs" else table
        columns = ", ".join(key.split())
        known = " AND ".join(f"{c} IS NOT NULL" for c in key.split())
        body = f"FROM {source} AS t WHERE {known} GROUP BY {columns} HAVING count(*) > 1"
        parts.append(_violation(table, "unique", "count(*) || ' rows'", body))
    return "\nUNION ALL\n".join(parts)


# Rows that have gone in the data of the incremental audit, by table.
_ROWS_GONE = {
    "employees": "id % 10 = 3", "users": "email LIKE '%7'", "backers": "email LIKE '%5'", "creators": "email LIKE '%4'",
    "project_types": "name = 'PROMO'", "projects": "id % 11 = 2", "rewards": "id % 13 = 5", "backs": "id % 17 = 4",
    "updates": "id % 19 = 1",
}


def _broken_rows() -> str:
    parts = []
    for table, columns in _REQUIRED.items():
        new = ", ".join(f"{e} AS {c}" for c, e in broken.replaced(table, columns.split()).items())
        source = f"(SELECT * REPLACE ({new}) FROM {table}) AS t"
        parts += [_violation(table, "not_null", f"'{c}'", f"FROM {source} WHERE {c} IS NULL") for c in columns.split()]
        parts += [
            _violation(table, "check", f"'{rule}'", f"FROM {source} WHERE NOT coalesce({rule}, TRUE)")
            for of, rule in _CHECKS
            if of == table
        ]
    return "\nUNION ALL\n".join(parts)


def _broken_keys() -> str:
    parts = []
    for table, key in _KEYS.items():
        columns = ", ".join(key.split())
        known = " AND ".join(f"{c} IS NOT NULL" for c in key.split())
        again = f"SELECT * FROM {table} WHERE {broken.NUMBER[table]} % {broken.TWICE} = 0"
        body = f"FROM (SELECT * FROM {table} UNION ALL {again}) AS t WHERE {known} GROUP BY {columns} HAVING count(*) > 1"
        parts.append(_violation(table, "unique", "count(*) || ' rows'", body))
    return "\nUNION ALL\n".join(parts)


def _foreign_keys(composite: bool | None, gone: dict[str, str] | None = None) -> str:
    parts = []
    left = lambda t: f"(SELECT * FROM {t} WHERE NOT ({gone[t]}))" if gone and t in gone else t
    for child, columns, parent, parent_columns in _REFERENCES:
        if composite is not None and (" " in columns) != composite:
            continue
        pairs = list(zip(columns.split(), parent_columns.split()))
        match = " AND ".join(f"p.{b} = c.{a}" for a, b in pairs)
        known = " AND ".join(f"c.{a} IS NOT NULL" for a, _ in pairs)
        label = f"({', '.join(columns.split())}) -> {parent}({', '.join(parent_columns.split())})"
        body = f"FROM {left(child)} AS c WHERE {known} AND NOT EXISTS (SELECT 1 FROM {left(parent)} p WHERE {match})"
        parts.append(_violation(child, "foreign_key", f"'{label}'", body))
    return "\nUNION ALL\n".join(parts)


def _stack(*parts: tuple[str, str, str, str]) -> str:
    """``(table_name, row_key, detail, body)`` rows on top of each other."""
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS row_key, CAST({detail} AS VARCHAR) AS detail {body}"
        for name, key, detail, body in parts
    )


_DATES_OK = "p.created <= b.backing AND b.backing <= p.deadline"
_REASONS = {
    "dates": "cannot back before project creation or after project deadline",
    "minimum": "Pledge amount must be greater than minimum of reward tier",
    "level": "No reward levels for project",
    "role": "User must be a Creator or a Buyer, or both!",
    "unrequested": "cannot approve or reject refund that is not requested",
    "late": "request date is 90 days after deadline, employee can only reject request",
    "unsuccessful": "no refund on unsuccessful project",
    "stored": "duplicate key in backs: already stored",
    "backer": "missing parent: backs (email) -> backers(email)",
}


def _ingest(source: str, stored: str | None = None) -> str:
    taken = f"EXISTS (SELECT 1 FROM {stored} s WHERE s.email = b.email AND s.id = b.id)" if stored else "FALSE"
    return f"""
        SELECT b.email, b.name, b.id, b.backing, b.request, b.amount,
               CASE WHEN p.id IS NULL OR NOT ({_DATES_OK}) THEN '{_REASONS["dates"]}'
                    WHEN r.min_amt IS NULL OR b.amount < r.min_amt THEN '{_REASONS["minimum"]}'
                    WHEN NOT (b.amount > 0) THEN 'check failed on backs: amount > 0'
                    WHEN {taken} THEN '{_REASONS["stored"]}'
                    WHEN k.email IS NULL THEN '{_REASONS["backer"]}' END AS reason
        FROM {source} b
        LEFT JOIN projects p ON p.id = b.id
        LEFT JOIN rewards r ON r.id = b.id AND r.name = b.name
        LEFT JOIN backers k ON k.email = b.email"""


def _decision(prefix: str = "") -> str:
    return f"""
        SELECT f.email, f.pid, f.eid, f.date, f.accepted,
               CASE WHEN b.request IS NULL THEN '{_REASONS["unrequested"]}'
                    WHEN b.request - p.deadline <= 90 OR NOT f.accepted THEN {prefix or 'NULL'}
                    ELSE '{_REASONS["late"]}' END AS reason
        FROM refunds f
        LEFT JOIN backs b ON b.email = f.email AND b.id = f.pid
        LEFT JOIN projects p ON p.id = f.pid"""


def _request_changes(lock: bool) -> str:
    locked = "WHEN b.request IS NOT NULL THEN 'refund request already set'" if lock else ""
    return f"""
        SELECT c.email, c.id, c.new_request,
               CASE WHEN b.email IS NULL THEN 'no such pledge'
                    WHEN b.request IS NULL AND c.new_request IS NOT NULL AND NOT EXISTS (
                        SELECT 1 FROM projects p JOIN totals t ON t.id = p.id
                        WHERE p.id = c.id AND p.goal <= t.amount AND p.deadline < c.new_request)
                    THEN '{_REASONS["unsuccessful"]}'
                    {locked} END AS reason
        FROM request_changes c LEFT JOIN backs b ON b.email = c.email AND b.id = c.id"""


_CARDS_EQUAL = "check failed on users: cc1 <> cc2"
_REGISTRATION_REASON = f"""
    CASE WHEN cc1 = cc2 THEN '{_CARDS_EQUAL}'
         WHEN kind NOT IN ('BACKER', 'CREATOR', 'BOTH') THEN 'Nonexistent kind --> ' || kind
         WHEN kind IN ('BACKER', 'BOTH') AND street IS NULL THEN 'null value in backers.street' END"""
_JUDGED_REGISTRATIONS = f"(SELECT *, {_REGISTRATION_REASON} AS reason FROM registrations) AS t"

_NO_CREATOR = "missing parent: projects (email) -> creators(email)"
_LOAD_REASON = f"""
    CASE WHEN NOT EXISTS (SELECT 1 FROM creators c WHERE c.email = l.email) THEN '{_NO_CREATOR}'
         WHEN least(n_names, n_amounts) = 0 THEN '{_REASONS["level"]}' END"""

_GONE = "NOT IN (SELECT email FROM delete_list)"
_USERS_LEFT = _stack(
    ("backers", "email", "NULL", f"FROM backers WHERE email {_GONE}"),
    ("creators", "email", "NULL", f"FROM creators WHERE email {_GONE}"),
    ("users", "email", "NULL", f"FROM users WHERE email {_GONE}"),
)
_KEPT_PROJECTS = "NOT IN (SELECT id FROM project_delete_list)"


def _renamed(table: str) -> str:
    return f"FROM {table} AS t LEFT JOIN email_map m ON m.old_value = t.email"


def _needed(parts: list[tuple[str, str]], given: str) -> str:
    key, label = given.split()
    return "\nUNION ALL\n".join(
        f"SELECT DISTINCT d.{key} AS {label}, '{name}' AS blocked_by FROM {body}" for name, body in parts
    )


_BLOCKED_UPDATE = _needed(
    [
        ("verifies", "email_map d JOIN verifies v ON v.email = d.old_value"),
        ("backs", "email_map d JOIN backs b ON b.email = d.old_value"),
    ],
    "old_value old_value",
)
_BLOCKED_DELETE = _needed(
    [
        ("verifies", "delete_list d JOIN users u ON u.email = d.email JOIN verifies v ON v.email = d.email"),
        ("backs", "delete_list d JOIN backers k ON k.email = d.email JOIN backs b ON b.email = d.email"),
        ("projects", "delete_list d JOIN creators c ON c.email = d.email JOIN projects p ON p.email = d.email"),
    ],
    "email row_key",
)
_BLOCKED_DELETE_STRICT = _needed(
    [
        (child, f"delete_list d JOIN users u ON u.email = d.email JOIN {child} k ON k.email = d.email")
        for child in ("verifies", "backers", "creators")
    ],
    "email row_key",
)

_QUERIES = {
    "scan_projects": "SELECT * FROM projects",
    "append_backs": "SELECT * FROM backs UNION ALL SELECT * FROM offered_backs WHERE id >= 2000000",
    "append_named": "SELECT email, name, cc1, cc2 FROM users UNION ALL SELECT email, name, cc1, NULL FROM registrations",
    "default_status": "SELECT email, id, request, 'pending' AS status FROM backs WHERE request IS NOT NULL",
    "apply_request_updates": """
        SELECT b.email, b.name, b.id, b.backing,
               CASE WHEN c.email IS NOT NULL THEN c.new_request ELSE b.request END AS request, b.amount
        FROM backs b LEFT JOIN request_changes c ON c.email = b.email AND c.id = b.id""",
    "delete_users": _USERS_LEFT,
    "assign_ids_summary": """
        SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id FROM updates""",
    "audit_not_null": _not_null(),
    "audit_check": "\nUNION ALL\n".join(
        _violation(t, "check", f"'{c}'", f"FROM {t} WHERE NOT coalesce({c}, TRUE)") for t, c in _CHECKS
    ),
    "audit_domain": """
        SELECT 'refund_status' AS table_name, 'domain' AS rule, email || '|' || id AS row_key,
               'status: unknown' AS detail FROM status WHERE id % 100 = 0""",
    "audit_unique": _unique(),
    "audit_collision": """
        SELECT 'backs' AS table_name, 'collision' AS rule, o.email || '|' || o.id AS row_key,
               'already stored' AS detail
        FROM offered_backs o WHERE EXISTS (SELECT 1 FROM backs b WHERE b.email = o.email AND b.id = o.id)""",
    "audit_fk": _foreign_keys(composite=False),
    "audit_fk_composite": _foreign_keys(composite=True),
    "audit_broken_rows": _broken_rows(),
    "audit_broken_keys": _broken_keys(),
    "audit_fk_changes": _foreign_keys(composite=None, gone=_ROWS_GONE),
    "audit_unique_digest": _unique(),
    "cast_quarantine": """
        SELECT id, raw, TRY_CAST(raw AS DATE) AS value, raw IS NOT NULL AND TRY_CAST(raw AS DATE) IS NULL AS is_bad
        FROM raw_dates""",
    "cascade_key_update": _stack(
        *[(t, "coalesce(m.new_value, t.email)", "NULL", _renamed(t)) for t in ("users", "backers", "creators")],
        ("projects", "t.id", "coalesce(m.new_value, t.email)", _renamed("projects")),
    ),
    "cascade_type_rename": _stack(
        ("project_types", "'new ' || name", "NULL", "FROM project_types"),
        ("projects", "id", "'new ' || ptype", "FROM projects"),
    ),
    "cascade_project_ids": _stack(
        ("projects", "id + 5000000", "name", "FROM projects"),
        *[
            (t, "CASE WHEN id IN (SELECT id FROM projects) THEN id + 5000000 ELSE id END", detail, f"FROM {t}")
            for t, detail in (("updates", "message"), ("rewards", "name"))
        ],
    ),
    "blocked_key_update": _BLOCKED_UPDATE,
    "cascade_delete": _USERS_LEFT,
    "cascade_delete_projects": _stack(
        ("projects", "id", "name", f"FROM projects WHERE id {_KEPT_PROJECTS}"),
        ("updates", "id", "message", f"FROM updates WHERE id {_KEPT_PROJECTS}"),
        ("rewards", "id", "name", f"FROM rewards WHERE id {_KEPT_PROJECTS}"),
    ),
    "cascade_delete_pledges": _stack(
        ("backs", "email", "id", "FROM backs WHERE (email, id) NOT IN (SELECT email, pid FROM late)"),
        ("refunds", "email", "pid", "FROM refunds WHERE (email, pid) NOT IN (SELECT email, pid FROM late)"),
    ),
    "blocked_delete": _BLOCKED_DELETE,
    "blocked_delete_strict": _BLOCKED_DELETE_STRICT,
    "rule_user_role": f"""
        SELECT *, CASE WHEN email NOT IN (SELECT email FROM backers) AND email NOT IN (SELECT email FROM creators)
                       THEN '{_REASONS["role"]}' END AS reason FROM users""",
    "rule_pledge_min": f"""
        SELECT b.*, CASE WHEN coalesce(b.amount >= r.min_amt, FALSE) THEN NULL
                         ELSE '{_REASONS["minimum"]}' END AS reason
        FROM backs b LEFT JOIN rewards r ON r.id = b.id AND r.name = b.name""",
    "rule_project_reward": f"""
        SELECT id, email, ptype, name,
               CASE WHEN least(n_names, n_amounts) = 0 THEN '{_REASONS["level"]}' END AS reason FROM project_loads""",
    "rule_refund_decision": _decision(),
    "rule_pledge_dates": f"""
        SELECT b.*, CASE WHEN coalesce({_DATES_OK}, FALSE) THEN NULL ELSE '{_REASONS["dates"]}' END AS reason
        FROM backs b LEFT JOIN projects p ON p.id = b.id""",
    "rule_request_success": _request_changes(lock=False),
    "rule_request_locked": _request_changes(lock=True),
    "ingest_pledges": _ingest("backs"),
    "ingest_pledges_again": _ingest("offered_backs", "backs"),
    "ingest_policy": _stack(
        *[
            (policy, "email", "id", f"FROM ({_ingest('backs')}) WHERE reason IS NULL")
            for policy in ("quarantine", "strict, clean batch")
        ]
    ),
    "register_users": _stack(
        ("users", "email", "NULL", f"FROM {_JUDGED_REGISTRATIONS} WHERE reason IS NULL"),
        ("backers", "email", "country", f"FROM {_JUDGED_REGISTRATIONS} WHERE reason IS NULL AND kind IN ('BACKER', 'BOTH')"),
        ("creators", "email", "country", f"FROM {_JUDGED_REGISTRATIONS} WHERE reason IS NULL AND kind IN ('CREATOR', 'BOTH')"),
        ("rejected", "email", "reason", f"FROM {_JUDGED_REGISTRATIONS} WHERE reason IS NOT NULL"),
    ),
    "load_projects": _stack(
        ("projects", "id", "name", f"FROM project_loads l WHERE {_LOAD_REASON} IS NULL"),
        (
            "rewards", "v.id", "v.name || ' ' || CAST(v.min_amt AS VARCHAR)",
            f"FROM load_levels v JOIN project_loads l ON l.id = v.id WHERE {_LOAD_REASON} IS NULL",
        ),
        ("rejected", "id", _LOAD_REASON, f"FROM project_loads l WHERE {_LOAD_REASON} IS NOT NULL"),
    ),
    "auto_reject": f"""
        SELECT email, pid, CAST(1 AS BIGINT) AS eid, DATE '{EARLY}' AS date, FALSE AS accepted FROM late l
        WHERE NOT EXISTS (SELECT 1 FROM refunds r WHERE r.email = l.email AND r.pid = l.pid)""",
    "auto_reject_strict": f"""
        SELECT email, pid, CAST(1 AS BIGINT) AS eid, DATE '{EARLY}' AS date, FALSE AS accepted,
               CASE WHEN EXISTS (SELECT 1 FROM refunds r WHERE r.email = l.email AND r.pid = l.pid)
                    THEN 'duplicate key in refunds: already stored' END AS reason FROM late l""",
    "refund_status": "SELECT * FROM status",
    "project_totals": "SELECT * FROM totals",
    "window_totals": """
        SELECT id, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM backs
        WHERE backing BETWEEN DATE '1996-02-10' AND DATE '1996-08-09' GROUP BY id""",
    "reward_counts": "SELECT id, count(name) AS levels FROM rewards GROUP BY id",
    "successful_projects": _successful(EARLY),
    "successful_projects_rows": f"SELECT * FROM projects WHERE id IN (SELECT id FROM ({_successful(EARLY)}))",
    "verified_users": _verified(EARLY),
    "days_to_funding": "SELECT * FROM days",
    "superbackers_breadth": _superbackers(_BROAD),
    "superbackers_amount": _superbackers(_LARGE),
    "find_superbackers": _superbackers(f"({_BROAD}) OR ({_LARGE})"),
    "find_top_success": _TOP_SUCCESS,
    "top_success_rejoin": _TOP_SUCCESS,
    "top_success_struct": _TOP_SUCCESS,
    "find_top_popular": _popular(),
    "top_popular_funded": _popular("d.days IS NOT NULL"),
    "daily_funding": "SELECT * FROM daily",
    "funding_curve": "SELECT * FROM curve",
    "maintained_curve": """
        SELECT d.id, d.backing, d.amount, p.goal,
               CAST(sum(d.amount) OVER (PARTITION BY d.id ORDER BY d.backing) AS DECIMAL(18,2)) AS running
        FROM (SELECT id, backing, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM changed_backs GROUP BY id, backing) d
        JOIN projects p ON p.id = d.id""",
    "maintained_success": f"""
        SELECT p.id, email AS c_email, ptype AS c_ptype, created AS c_date, name AS pname, deadline, goal, amount
        FROM projects p JOIN (SELECT id, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM changed_backs GROUP BY id) t
            ON t.id = p.id AND t.amount >= p.goal WHERE deadline < DATE '{EARLY}'""",
    "projects_by_type": f"SELECT * FROM projects WHERE ptype = '{PTYPE}'",
    "sql_successful_projects": _successful(EARLY),
    "sql_verified_users": _verified(EARLY),
    "sql_find_top_success": _TOP_SUCCESS,
    "sql_find_top_popular": _popular(),
    "sql_find_superbackers": _superbackers(f"({_BROAD}) OR ({_LARGE})"),
    "sql_days_to_funding": "SELECT * FROM days",
    "ingest_pledges_hot": _ingest("backs"),
    "audit_fk_hot": _foreign_keys(composite=False),
    "superbackers_hot": _superbackers(f"({_BROAD}) OR ({_LARGE})"),
    "load_copy": """
        SELECT o_orderkey AS id, o_custkey AS customer, CAST(NULL AS VARCHAR) AS reason FROM orders WHERE o_custkey % 4 <> 1""",
    "assign_ids_ordered": """
        SELECT row_number() OVER (ORDER BY id % 2, name, id) AS serial, name, id AS project FROM projects""",
    "load_delimited": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS id, o_custkey AS customer,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
               CASE WHEN o_orderstatus = 'P' THEN chr(92) || 'N' ELSE CAST(o_orderkey AS VARCHAR) END || ',' || o_custkey
               || ',' || CASE WHEN o_orderpriority = '1-URGENT' THEN '31/12/1998'
                              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS line,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'malformed line'
                    WHEN o_orderstatus = 'P' THEN 'null value in column id' END AS reason
        FROM orders""",
    "stream_pledges": _ingest("backs"),
    "stream_pledges_again": _ingest("offered_backs", "backs"),
    "stream_pledges_returning": f"""
        SELECT * FROM ({_ingest("backs")}) UNION ALL
        SELECT * REPLACE (coalesce(reason, '{_REASONS["stored"]}') AS reason) FROM ({_ingest("backs")})""",
    "stream_refunds": _decision("""
        CASE WHEN NOT EXISTS (SELECT 1 FROM employees e WHERE e.id = f.eid)
             THEN 'missing parent: refunds (eid) -> employees(id)' END"""),
    "stream_request_changes": _request_changes(lock=False),
    "stream_registrations": f"SELECT * FROM {_JUDGED_REGISTRATIONS}",
    "stream_project_loads": f"SELECT id, email, ptype, {_LOAD_REASON} AS reason FROM project_loads l",
}


_QUERIES.update(
    write_back_requests=_QUERIES["apply_request_updates"],
    write_back_users=_QUERIES["delete_users"],
    write_back_keys=_QUERIES["cascade_key_update"],
    write_back_deletes=_QUERIES["cascade_delete_pledges"],
)


def _mentions(sql: str) -> list[str]:
    words = set("".join(c if c.isalnum() or c == "_" else " " for c in sql).split())
    return [name for name in VIEWS if name in words]


def _with_views(sql: str) -> str:
    """The query behind the views it needs, in order of definition."""
    needed: set[str] = set()
    todo = _mentions(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _mentions(VIEWS[name])
    ordered = [f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed]
    return "WITH " + ",\n".join(ordered) + f"\n{sql.strip()}" if ordered else sql


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(sql) for name, sql in _QUERIES.items()}
