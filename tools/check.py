"""Compare every named query with its SQL twin: ``python tools/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from gaugeworks.catalogue.oracles import SQL  # noqa: E402
from gaugeworks.catalogue.queries import QUERIES  # noqa: E402
from gaugeworks.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def rows(columns, data):
    """Rows with columns by name, values as text, in a stable order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in data)


def compare(spark, con, name, sf_dir):
    """(rows, differing rows, column names equal) of one query against its twin."""
    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    want = rows(names, cursor.fetchall())
    same_names = sorted(names) == sorted(df.columns)
    differing = abs(len(got) - len(want)) + sum(a != b for a, b in zip(got, want))
    return len(got), differing, same_names, [(a, b) for a, b in zip(got, want) if a != b][:2]


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session(8), connect(sf_dir), 0
    for name in names:
        start = time.time()
        if name not in SQL:
            print(f"{name:26s} no twin: {QUERIES[name](spark, sf_dir).count()} rows", flush=True)
            continue
        try:
            n, differing, same_names, sample = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            print(f"{name:26s} ERROR {str(error)[:600]}", flush=True)
            bad += 1
            continue
        ok = same_names and not differing
        bad += not ok
        print(f"{name:26s} {'ok ' if ok else 'BAD'} rows={n} differing={differing} names={same_names} "
              f"{time.time() - start:.1f}s", *([] if ok else sample), flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
