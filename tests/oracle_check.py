"""Run registered queries next to their oracle SQL and compare rows, names and types.

usage: python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

TYPES = {"long": "BIGINT", "integer": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BLOB"}


SIZES: dict[str, int] = {}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _bag(rows):
    return sorted(tuple(map(_cell, r)) for r in rows)


def compare(spark, con, folder: str, name: str, fn, sql: str | None) -> str:
    """'' when equal, else what differs."""
    df = fn(spark, folder)
    names = sorted(df.columns)
    mine = _bag(df.select(*[f"`{c}`" for c in names]).collect())
    if sql is None:
        return "" if mine else "no rows"
    SIZES[name] = len(mine)
    cur = con.execute(sql)
    theirs_names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    if sorted(theirs_names) != names:
        return f"columns {names} != {sorted(theirs_names)}"
    order = [theirs_names.index(c) for c in names]
    theirs = _bag([tuple(r[i] for i in order) for r in cur.fetchall()])
    bad = [(c, df.schema[c].dataType.typeName(), kinds[c]) for c in names
           if TYPES.get(df.schema[c].dataType.typeName()) != kinds[c]]
    if bad:
        return f"types {bad}"
    if mine != theirs:
        a, b = set(mine) - set(theirs), set(theirs) - set(mine)
        return f"rows {len(mine)} vs {len(theirs)}; only spark {sorted(a)[:2]}; only oracle {sorted(b)[:2]}"
    return ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import get_spark
    args = sys.argv[1:]
    folder = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    wanted = [a for a in args if "/" not in a]
    spark, con = get_spark("oracle-check", 8, shuffle_partitions=8), connect(folder)
    failed, sqls = [], oracle_sql()
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, fn, sqls.get(name))
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name:14s} {'ok  ' if not problem else 'FAIL'} {'' if name in sqls else '(rows only) '}"
              f"{time.time() - start:6.2f}s {SIZES.get(name, '')} {problem}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
