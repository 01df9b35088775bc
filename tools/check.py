"""Run registered queries on Spark and their SQL twins on DuckDB and compare.

usage: python tools/check.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from casework import plans  # noqa: E402
from casework.session import build_session  # noqa: E402
from casework.sources.files import TABLES  # noqa: E402

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, repr(float(v) + 0.0))
    return (3, str(v))


def compare(df, con, sql: str) -> tuple[list[tuple], list[str]]:
    """Rows of the Spark result and a list of differences from the SQL result."""
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return rows, [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    problems = [f"type {c}: {t} vs {kinds[c]}" for c, t in df.dtypes if TYPES.get(t) != kinds[c]]
    order = [names.index(c) for c in df.columns]
    got = sorted(tuple(norm(v) for v in r) for r in rows)
    expected = sorted(tuple(norm(r[i]) for i in order) for r in want)
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} vs {len(expected)}")
    if got != expected:
        show = lambda a, b: str([[x[1] for x in r] for r in a if r not in set(b)][:2])[:900]
        problems.append(f"values\n   spark {show(got, expected)}\n   duck  {show(expected, got)}")
    return rows, problems


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--cpus", default="8")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        master=f"local[{args.cpus}]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), plans.oracle_sql(), 0
    for name, run in plans.queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                rows, problems = compare(df, con, sql[name])
            else:
                rows, problems = df.collect(), []
            problems += [] if rows else ["empty"]
            state = "FAIL" if problems else ("OK  " if name in sql else "ROWS")
            print(f"{state} {name}: {len(rows)} rows {time.time() - start:.1f}s {'; '.join(problems)}", flush=True)
            bad += bool(problems)
        except Exception as e:  # reported, the run goes on
            bad += 1
            print(f"ERR  {name}: {type(e).__name__} {str(e)[:700]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
