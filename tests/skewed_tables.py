"""A variant of the test tables: one customer holds a third of all orders, one
part and order line a third of all lines, and every nullable column has nulls."""

from __future__ import annotations

import shutil
from pathlib import Path

CHANGES = {
    "orders": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 71 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 67 <> 1 THEN o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 61 <> 1 THEN o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 59 <> 1 THEN o_orderdate END AS o_orderdate,
        CASE WHEN o_orderkey % 53 <> 1 THEN o_orderpriority END AS o_orderpriority FROM t""",
    "customer": """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN 1 WHEN c_custkey % 11 = 1 THEN 999 ELSE c_nationkey END AS c_nationkey,
        CASE WHEN c_custkey % 13 <> 1 THEN c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey % 17 <> 1 THEN c_mktsegment END AS c_mktsegment FROM t""",
    "lineitem": """SELECT CASE WHEN rn % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey, CASE WHEN rn % 3 = 0 THEN 9 ELSE l_partkey END AS l_partkey,
        l_suppkey, CASE WHEN rn % 3 = 0 THEN 1 ELSE l_linenumber END AS l_linenumber,
        CASE WHEN rn % 41 <> 1 THEN l_quantity END AS l_quantity, CASE WHEN rn % 43 <> 1 THEN l_extendedprice END AS l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus, CASE WHEN rn % 47 <> 1 THEN l_shipdate END AS l_shipdate
        FROM (SELECT *, ROW_NUMBER() OVER () AS rn FROM t)""",
}


def write_skewed(source: str, target: Path) -> str:
    import duckdb

    target.mkdir(parents=True, exist_ok=True)
    for file in Path(source).glob("*.parquet"):
        change = CHANGES.get(file.stem)
        if change is None:
            shutil.copyfile(file, target / file.name)
        else:
            connection = duckdb.connect()
            connection.execute(f"CREATE VIEW t AS SELECT * FROM '{file}'")
            connection.execute(f"COPY ({change}) TO '{target / file.name}' (FORMAT parquet)")
    return str(target)


if __name__ == "__main__":
    import sys

    print(write_skewed(sys.argv[1], Path(sys.argv[2])))
