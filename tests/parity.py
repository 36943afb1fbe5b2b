"""Compare a query with its SQL, value by value and regardless of order."""

from __future__ import annotations

import decimal
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v else "0"
    if isinstance(v, float):
        return repr(v)
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf):
    df = fn(spark, sf)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = canonical(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = sorted(set(got[1]) - set(want[1]))[:3]
        missing = sorted(set(want[1]) - set(got[1]))[:3]
        return f"rows {len(got[1])} vs {len(want[1])}\n   spark only {extra}\n   sql only   {missing}\n   {got[0]}"
    return None


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    from tidemark.session import get_spark

    sf = "/root/testdata/sf0.01"
    spark = get_spark("parity", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if name in entry.LLM_QUERIES:
            continue
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, fn, oracles[name], sf) if name in oracles else "no sql"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
