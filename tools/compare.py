"""Run registered queries beside their SQL in DuckDB and compare rows, column names and types.

    python tools/compare.py [--dir FOLDER] [--conf KEY=VALUE ...] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from feira.queries import oracle_sql, queries  # noqa: E402
from feira.session import build_session  # noqa: E402

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(con, name: str, frame, sql: str) -> str:
    """Empty text if both sides agree, else what differs."""
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, map(str, relation.types)))
    got_types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                 for f in frame.schema.fields}
    names = sorted(got_types)
    if names != sorted(want_types):
        return f"columns {names} vs {sorted(want_types)}"
    kinds = [f"{n}: {got_types[n]} vs {want_types[n]}" for n in names if got_types[n] != want_types[n]]
    got = Counter(tuple(str(row[n]) for n in names) for row in frame.collect())
    at = [relation.columns.index(n) for n in names]
    want = Counter(tuple(str(row[i]) for i in at) for row in relation.limit(10**9).fetchall())
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(want.values())}\n   spark only {extra}\n   sql only {missing}"
    return "types " + "; ".join(kinds) if kinds else ("empty result" if not got else "")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--dir", default="/root/testdata/sf0.01")
    parser.add_argument("--conf", action="append", default=[], help="Spark setting, e.g. no broadcasts at all")
    parser.add_argument("prefix", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                  "spark.driver.memory": "8g",
                                  "spark.ui.showConsoleProgress": "false",
                                  **dict(c.split("=", 1) for c in args.conf)})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad, slow = duck(args.dir), oracle_sql(), 0, []
    chosen = {n: q for n, q in queries().items()
              if not args.prefix or any(n.startswith(p) for p in args.prefix)}
    for name, run in chosen.items():
        start = time.time()
        try:
            frame = run(spark, args.dir)
            result = compare(con, name, frame, sql[name]) if name in sql else f"no sql, {frame.count()} rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        took = time.time() - start
        slow.append((took, name))
        bad += bool(result) and not result.startswith("no sql")
        print(f"{'ok ' if not result else '-- '}{name} {took:.1f}s {result}", flush=True)
    print(f"{len(chosen)} queries, {bad} to look at; slowest {sorted(slow, reverse=True)[:6]}")
    spark.stop()
    return bad > 0


if __name__ == "__main__":
    sys.exit(main())
