"""Run every registered query and its SQL on one folder and compare the rows.

    python -m conformance.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from conformance.oracle import oracle_sql
from conformance.queries import QUERIES

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in DRIVER_TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


# Names the two engines give to one type.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def difference(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str | None]:
    """Row count of the Spark result, and a text if the SQL result differs."""
    got_columns, got = _bag(df.columns, df.collect())
    answer = db.execute(sql)
    want_columns, want = _bag([d[0] for d in answer.description], answer.fetchall())
    if got_columns != want_columns:
        return got.total(), f"columns {got_columns} / {want_columns}"
    types = {c: SAME_TYPE.get(t, t.upper()) for c, t in df.dtypes}
    other = {d[0]: str(d[1]) for d in answer.description}
    if types != other:
        return got.total(), f"types {sorted(set(types.items()) ^ set(other.items()))}"
    if got != want:
        return got.total(), (
            f"rows {got.total()} / {want.total()}; only here {list((got - want).items())[:3]}; "
            f"only there {list((want - got).items())[:3]}"
        )
    return got.total(), None


def main() -> None:
    from pledgeflow.session import local_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark, db, oracle = local_session(), connect(folder), oracle_sql()
    bad = 0
    for name in only or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, folder)
            rows, problem = difference(df, db, oracle[name]) if name in oracle else (df.count(), None)
        except Exception as error:  # report and go on with the next query
            rows, problem = -1, str(error)[:300]
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {rows:8} {time.time() - started:6.1f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(only or QUERIES)} differ")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
