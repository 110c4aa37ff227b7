"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(name: str = "stationlab", **more):
    from pyspark.sql import SparkSession

    builder = SparkSession.builder
    for k, v in more.items():
        builder = builder.config(k, v)
    spark = (
        builder.master("local[8]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


LAST: dict[str, float] = {}


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(cell(r[c]) for c in cols) for r in (x.asDict() for x in df.collect()))


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_gaps(df, con, sql):
    """Columns whose types differ between the two engines."""
    duck_types = {c[0]: str(c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, duck_types.get(c)) for c, t in df.dtypes if SAME_TYPE.get(t) != duck_types.get(c)}


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted(tuple(cell(r[i]) for i in at) for r in cur.fetchall())


def check(spark, con, fn, sql, sf_dir):
    """None when equal, else a short text."""
    t = time.time()
    df = fn(spark, sf_dir)
    cols, rows = spark_rows(df)
    LAST["spark"] = time.time() - t
    if not rows:
        return "no rows"
    if sql is None:
        return None
    dcols, drows = duck_rows(con, sql)
    if cols != dcols:
        return f"columns {cols} != {dcols}"
    if len(rows) != len(drows):
        return f"rows {len(rows)} != {len(drows)}"
    if gaps := type_gaps(df, con, sql):
        return f"types differ: {gaps}"
    bad = [(a, b) for a, b in zip(rows, drows) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ: {cols}\n   spark {bad[0][0]}\n   duck  {bad[0][1]}"
    return None


def main(argv):
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = argv[1:]
    q, o = entry.queries(), entry.oracle_sql()
    more = dict(kv.split("=", 1) for kv in os.environ.get("COMPARE_CONF", "").split(",") if kv)
    spark, con = session(**more), duck(sf_dir)
    failed = []
    for name in q:
        if only and not any(name == x or (x.endswith("*") and name.startswith(x[:-1])) for x in only):
            continue
        t = time.time()
        try:
            msg = check(spark, con, q[name], o.get(name), sf_dir)
        except Exception as e:  # report and go on
            msg = "ERROR " + "".join(traceback.format_exception_only(e))[:1500]
        print(f"{'ok  ' if msg is None else 'FAIL'} {name:28s} {time.time() - t:6.2f}s spark {LAST.get('spark', 0):6.2f}s {'' if name in o else '(rows only) '}{msg or ''}", flush=True)
        if msg:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
