"""Run registered queries next to their oracle SQL and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return repr(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, make, sql):
    """None when equal, else what differs."""
    df = make(spark, sf_dir)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got[1] else "no rows"
    cur = con.execute(sql)
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if got[1] != want[1]:
        g, w = set(got[1]), set(want[1])
        return (f"{len(got[1])} / {len(want[1])} rows; only spark {sorted(g - w)[:3]}; only sql {sorted(w - g)[:3]}")
    if not want[1]:
        return "equal, but no rows"
    return None


def main(sf_dir: str, pattern: str = ""):
    from bench import session
    import __spark_entry__ as entry
    spark, con = session("check"), connect(sf_dir)
    oracle, bad, weak = entry.oracle_sql(), 0, 0
    for name, make in entry.queries().items():
        if not any(name.startswith(p) for p in pattern.split(",")):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, make, oracle.get(name))
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1200]}"
        bad += problem is not None
        weak += name not in oracle
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {'' if name in oracle else '(rows only) '}{problem or ''}", flush=True)
    print("failed:", bad, "rows only:", weak)


if __name__ == "__main__":
    main(*sys.argv[1:])
