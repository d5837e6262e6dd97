"""Run every query and its SQL counterpart on one scale factor and compare."""

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(normal(r[i]) for i in order)) for r in data)


def difference(spark_df, con, sql):
    """'' if both give the same rows, else what differs."""
    mine = rows(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    theirs = rows([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if mine[1] == theirs[1]:
        return ""
    a, b = set(mine[1]), set(theirs[1])
    return f"rows {len(mine[1])} vs {len(theirs[1])}; only spark {sorted(a - b)[:2]}; only sql {sorted(b - a)[:2]}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
    import __spark_entry__ as entry
    from conftest import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con, oracle = session(), connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            said = difference(df, con, oracle[name]) if name in oracle else f"no SQL, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(said)
        print(f"{'ok ' if not said else 'BAD'} {name} {time.time() - start:.2f}s {said[:900]}", flush=True)
    print("bad:", bad)
