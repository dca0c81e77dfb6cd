"""Compare registered queries with their SQL, run by DuckDB on the same tables.

As a script: ``python tests/oracle.py SF_DIR [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    if hasattr(value, "as_tuple"):
        return repr(float(value)) if value.as_tuple().exponent < 0 else str(int(value))
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(normal(row[i])) for i in order) for row in data)


def compare(spark, connection, function, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = function(spark, sf_dir)
    expected = connection.execute(sql)
    expected_columns = [d[0] for d in expected.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} vs {sorted(expected_columns)}"
    left, right = rows(df.columns, df.collect()), rows(expected_columns, expected.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} of {len(left)} rows differ, first {different[0]}" if different else None


def main() -> int:
    from orebelt.session import build_session
    from suite import ORACLE, QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(sf_dir), 0
    for name, function in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        begin = time.time()
        try:
            if name in ORACLE:
                problem = compare(spark, connection, function, ORACLE[name], sf_dir)
                n = "oracle"
            else:
                n, problem = f"{function(spark, sf_dir).count()} rows", None
        except Exception as error:  # noqa: BLE001
            n, problem = "error", str(error)[:1500]
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:32} {time.time() - begin:6.2f}s {n} {problem or ''}", flush=True)
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(main())
