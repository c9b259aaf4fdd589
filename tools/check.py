"""Compare registered queries with their SQL twins: python tools/check.py SF [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rolefit.plans.catalog import QUERIES  # noqa: E402
from rolefit.plans.oracle import ORACLE  # noqa: E402
from rolefit.plans.oracle_base import TABLES  # noqa: E402
from rolefit.session import local_session  # noqa: E402


def canon(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def difference(spark_rows: list[dict], sql_rows: list[dict]) -> str:
    """Empty when both sides hold the same rows under the same column names."""
    if spark_rows and sql_rows and sorted(spark_rows[0]) != sorted(sql_rows[0]):
        return f"columns {sorted(spark_rows[0])} vs {sorted(sql_rows[0])}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} vs {len(sql_rows)}"
    a = sorted(tuple(canon(r[c]) for c in sorted(r)) for r in spark_rows)
    b = sorted(tuple(canon(r[c]) for c in sorted(r)) for r in sql_rows)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def compare(spark, db, sf_dir: str, name: str) -> tuple[str, int, float, float]:
    start = time.time()
    found = [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]
    middle = time.time()
    if name not in ORACLE:
        return "", len(found), middle - start, 0.0
    cursor = db.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    expected = [dict(zip(names, row)) for row in cursor.fetchall()]
    return difference(found, expected), len(found), middle - start, time.time() - middle


if __name__ == "__main__":
    folder = f"/root/testdata/sf{sys.argv[1]}"
    session, database = local_session(), connect(folder)
    bad = 0
    for query in sys.argv[2:] or QUERIES:
        try:
            diff, rows, spark_s, sql_s = compare(session, database, folder, query)
        except Exception as error:  # noqa: BLE001
            diff, rows, spark_s, sql_s = f"{type(error).__name__} {str(error)[:500]}", -1, 0.0, 0.0
        bad += bool(diff)
        kind = "ROWS " if query not in ORACLE and not diff else ("DIFF " if diff else "SAME ")
        print(kind, query, rows, f"spark {spark_s:.1f}s sql {sql_s:.1f}s", diff[:600].replace("\n", " "), flush=True)
    print("differences:", bad)
