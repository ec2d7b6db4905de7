"""Runs registered queries next to their SQL twins and compares the rows.

``python tests/check_oracles.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        repr(tuple(row[i] for i in order)) for row in rows
    )


def compare(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None when rows agree, else what differs."""
    df = run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}"
    off = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(off)} rows differ, first {off[0]}" if off else None


def main() -> None:
    import __spark_entry__ as entry
    from conftest import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, oracles = session(), connect(sf_dir), entry.oracle_sql()
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, run, oracles[name], sf_dir) or "ok"
            else:
                verdict = f"{run(spark, sf_dir).count()} rows, no SQL twin"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main()
