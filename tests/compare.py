"""Run registered queries against their SQL on one scale folder and report differences.

    python tests/compare.py [--sf sf0.01] [name-prefix …]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

DATA = pathlib.Path("/root/testdata")
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: pathlib.Path):
    import duckdb

    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{folder}/{n}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def differences(spark_df, con, sql: str) -> str | None:
    got_cols = spark_df.columns
    got = rows_of(got_cols, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    if sorted(got_cols) != sorted(cols):
        return f"columns {sorted(got_cols)} <> {sorted(cols)}"
    if len(got) != len(want):
        a, b = set(got), set(want)
        return f"rows {len(got)} <> {len(want)}; only spark {sorted(a - b, key=_key)[:3]} only sql {sorted(b - a, key=_key)[:3]}"
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            if a != b and not (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)):
                return f"{sorted(cols)}: {g} <> {w}"
    return None if got else "empty"


def main():
    args = sys.argv[1:]
    sf = "sf0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    from tessella.session import local_session

    import __spark_entry__ as e

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(DATA / sf)
    q, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name in q:
        if args and not any(name.startswith(a) for a in args):
            continue
        t0 = time.time()
        try:
            df = q[name](spark, str(DATA / sf))
            if name in sqls:
                res = differences(df, con, sqls[name])
            else:
                n = df.count()
                res = None if n else "empty"
                name += f" [rows only: {n}]"
        except Exception as exc:  # noqa: BLE001
            res = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += res is not None
        print(f"{'ok  ' if res is None else 'FAIL'} {name} {time.time() - t0:.1f}s {res or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
