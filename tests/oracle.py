"""Compare registered queries with their SQL twins, strictly: columns, types, every value.

``python tests/oracle.py [name ...]`` checks at sf0.01 (or ORACLE_DIR) and prints what differs.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# Spark type -> DuckDB type
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "tinyint": "TINYINT", "smallint": "SMALLINT", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, float):
        return repr(v + 0.0)
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL; empty when they agree."""
    rel = con.sql(sql)
    problems = []
    theirs = dict(zip(rel.columns, map(str, rel.types), strict=True))
    ours = dict(df.dtypes)
    if sorted(ours) != sorted(theirs):
        return [f"columns: {sorted(ours)} against {sorted(theirs)}"]
    for c, kind in ours.items():
        if TYPES.get(kind, kind) != theirs[c]:
            problems.append(f"type of {c}: {kind} against {theirs[c]}")
    names = sorted(ours)
    a = Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    quoted = ", ".join(f'"{n}"' for n in names)
    b = Counter(tuple(_plain(v) for v in row) for row in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    if sum(a.values()) != sum(b.values()):
        problems.append(f"rows: {sum(a.values())} against {sum(b.values())}")
    if a != b:
        only_a, only_b = a - b, b - a
        problems.append(f"values: {sum(only_a.values())} only here, {sum(only_b.values())} only there ({names})")
        problems += [f"  here  {r}" for r in sorted(only_a, key=str)[:3]] + [f"  there {r}" for r in sorted(only_b, key=str)[:3]]
    return problems


def main() -> int:
    from tarnwork.queries import ORACLES, QUERIES
    from tarnwork.session import build_session

    folder = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in sys.argv[1:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            found = compare(df, con, ORACLES[name]) if name in ORACLES else ([] if df.count() else ["no rows"])
        except Exception as err:  # noqa: BLE001
            found = [f"{type(err).__name__}: {str(err)[:700]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s{'' if name in ORACLES else ' (no SQL)'}", flush=True)
        for line in found:
            print("     ", line[:700])
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
