"""Run acceptance queries next to their SQL and compare: ``python -m acceptance.check [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from acceptance.oracle import SQL
from acceptance.queries import QUERIES
from acceptance.session import local_session


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> list[str]:
    """What differs between a query and its SQL: columns, types' kinds, rows."""
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    rows = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return [f"columns {df.columns} / {columns}"]
    order = [df.columns.index(c) for c in columns]
    mine, theirs = Counter(tuple(r[i] for i in order) for r in got), Counter(rows)
    out = []
    if not rows:
        out.append("no rows")
    for label, rest in (("only here", mine - theirs), ("only in SQL", theirs - mine)):
        if rest:
            out.append(f"{label} {sum(rest.values())} of {len(got)}/{len(rows)}: {list(rest)[:3]}")
    return out


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con = local_session(), database(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
