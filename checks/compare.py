"""Run queries next to their SQL and compare the results as multisets of rows.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from replaystats.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """Values in a form in which both engines agree: numbers by value, not by type."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str, inspect=None) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    if inspect:
        inspect(df)
    ours = bag(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return True, f"rows={sum(ours.values())} (no SQL)"
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    theirs = bag(columns, cursor.fetchall())
    if ours == theirs:
        return True, f"rows={sum(ours.values())}"
    only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
    return False, (
        f"rows={sum(ours.values())}/{sum(theirs.values())} differ={len(only_ours)}/{len(only_theirs)} "
        f"columns={sorted(columns)} ours={only_ours[:3]} sql={only_theirs[:3]}"
    )


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        start = time.perf_counter()
        try:
            good, text = compare(spark, con, name, sf_dir)
        except Exception as error:  # a broken query must not hide the others
            good, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if good else 'FAIL'} {name:24s} {time.perf_counter() - start:6.2f}s {text}", flush=True)
        if not good:
            failed.append(name)
    print(f"{len(names) - len(failed)}/{len(names)} agree; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
