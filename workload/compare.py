"""Compare registered queries with their check SQL: ``python -m workload.compare [sf_dir] [names]``."""

import glob
import os
import sys
import tempfile
import time

import duckdb

from imageset_spark.session import build_session

from .oracles import ORACLES
from .queries import QUERIES


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((value is None, str(type(value).__name__), str(value)) for value in row)


def _exact(value):
    if isinstance(value, float) and value != value:
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_exact(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=_key)


def differences(spark, con, name, sf_dir):
    """Empty text if the Spark result and the check SQL agree exactly."""
    df = QUERIES[name](spark, sf_dir)
    left = normalised(df.columns, df.collect())
    if name not in ORACLES:
        return "" if left[1] else "no rows"
    cur = con.execute(ORACLES[name])
    right = normalised([d[0] for d in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"first difference {a} / {b}"
    return ""


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                            "spark.ui.showConsoleProgress": "false",
                            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:300]}"
        bad += bool(found)
        state = "rows-only" if name not in ORACLES and not found else "ok"
        print(f"{name:28s} {time.time() - start:6.2f}s  {found or state}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
