"""Run registered queries in Spark and DuckDB and compare rows exactly.

Usage: python tools/check_oracle.py [data folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fleetlake.plans.registry import all_queries  # noqa: E402
from fleetlake.session import build_session  # noqa: E402
from oracle import oracle_queries  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(normal(row[i]) for i in order) for row in rows])


def duck(root):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return connection


def compare(spark, connection, root, name, query, sql):
    """(status, seconds, detail) of one query."""
    began = time.time()
    frame = query(spark, root)
    rows = [tuple(r) for r in frame.collect()]
    took = time.time() - began
    if sql is None:
        return "rows", took, f"{len(rows)} rows"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return "SCHEMA", took, f"{sorted(frame.columns)} vs {sorted(names)}"
    kinds = {d[0]: str(d[1]).lower() for d in result.description}
    same = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean",
            "timestamp_ntz": "timestamp", "timestamp": "timestamp", "date": "date"}
    odd = [f"{f.name}:{f.dataType.simpleString()}/{kinds[f.name]}" for f in frame.schema if same.get(f.dataType.simpleString()) != kinds[f.name]]
    mine, theirs = rows_of(frame.columns, rows), rows_of(names, expected)
    if mine != theirs:
        only_mine, only_theirs = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
        detail = f"{len(mine)} vs {len(theirs)} rows; {len(only_mine)} / {len(only_theirs)} differ\n  columns {sorted(names)}\n  spark {only_mine[:2]}\n  duck  {only_theirs[:2]}"
        return "DIFF", took, detail
    return "ok", took, f"{len(mine)} rows" + (f" TYPES {odd}" if odd else "")


def main():
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(root)
    sqls = oracle_queries()
    bad = 0
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        try:
            status, took, detail = compare(spark, connection, root, name, query, sqls.get(name))
        except Exception as error:
            status, took, detail = "ERROR", 0.0, "".join(traceback.format_exception_only(error))[:1500]
        bad += status not in ("ok", "rows")
        print(f"{status:7} {name:32} {took:6.1f}s {detail}", flush=True)
    unknown = set(sqls) - set(all_queries())
    print(f"failures: {bad}; SQL without query: {sorted(unknown)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
