"""Compare queries with their SQL: python tests/check_oracles.py [sf or folder] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
}


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}") + 0.0
    return value


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty when names, types, row count and values agree."""
    problems = []
    result = connection.sql(sql)
    expected_types = dict(zip(result.columns, map(str, result.types)))
    actual_types = {name: KINDS.get(kind, kind) for name, kind in spark_df.dtypes}
    if expected_types != actual_types:
        problems.append(f"types differ: {set(expected_types.items()) ^ set(actual_types.items())}")
        if set(expected_types) != set(actual_types):
            return problems
    names = sorted(actual_types)
    order = [result.columns.index(n) for n in names]
    expected = Counter(tuple(normal(row[i]) for i in order) for row in result.fetchall())
    actual = Counter(tuple(normal(v) for v in row) for row in spark_df.select(*[f"`{n}`" for n in names]).collect())
    if expected != actual:
        problems.append(f"{actual.total()} rows against {expected.total()}")
        problems.append(f"columns {names}")
        problems.append(f"only Spark: {list((actual - expected).items())[:3]}")
        problems.append(f"only SQL:   {list((expected - actual).items())[:3]}")
    return problems


def main(scale: str, names: list[str]) -> int:
    import __spark_entry__ as contract
    from tellerframe.session import build_session

    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    folder = scale if "/" in scale else f"/root/testdata/sf{scale}"
    connection = connect(folder)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = []
    for name in names or queries:
        started = time.time()
        try:
            problems = differences(queries[name](spark, folder), connection, oracles[name]) if name in oracles else ["no SQL"]
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - started:.1f}s", flush=True)
        for problem in problems:
            print("    ", problem, flush=True)
        bad += [name] * bool(problems)
    print(f"{len(bad)} bad: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:]))
