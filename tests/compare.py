"""Compare every registered query with its SQL; also a command: python tests/compare.py sf0.01 [name ...]"""

import glob
import math
import os
import sys
import time

import duckdb


def connection(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(int(value)) if value == int(value) and abs(value) < 1e15 else repr(value)
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql):
    """None if both give the same rows, else a description."""
    expected = con.execute(sql)
    columns = [d[0] for d in expected.description]
    expected_rows = expected.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    want = normal(columns, expected_rows)
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"{len(got)} rows, {len(want)} wanted; {len(only_got)} only here {str(only_got[:3])[:600]}; {len(only_want)} missing {str(only_want[:3])[:600]}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    folder = f"/root/testdata/{sys.argv[1]}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    wanted = sys.argv[2:] or list(e.queries())
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            result = difference(e.queries()[name](spark, folder), con, e.oracle_sql()[name])
        except Exception as error:  # report and go on
            result = f"{type(error).__name__}: {str(error)[:900]}"
        bad += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
