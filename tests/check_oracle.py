"""Run queries and their SQL side by side: ``check_oracle.py SF_DIR [name ...]``."""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(data, key=repr)


def compare(spark, con, sf_dir, query, sql):
    started = time.time()
    frame = query(spark, sf_dir)
    got = normal(frame.columns, [tuple(row) for row in frame.collect()])
    seconds = time.time() - started
    if sql is None:
        return None, len(got[1]), seconds
    result = con.execute(sql)
    want = normal([d[0] for d in result.description], result.fetchall())
    if got == want:
        return None, len(got[1]), seconds
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}", len(got[1]), seconds
    extra = [row for row in got[1] if row not in set(want[1])][:3]
    missing = [row for row in want[1] if row not in set(got[1])][:3]
    text = f"{len(got[1])} / {len(want[1])} rows, only here {extra}, only SQL {missing}"
    return text[:3000], len(got[1]), seconds


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    from skillgauge.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:]
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        try:
            problem, rows, seconds = compare(spark, con, sf_dir, query, sqls.get(name))
        except Exception as error:
            problem, rows, seconds = f"{type(error).__name__} {str(error)[:1500]}", 0, 0
        print(f"{name}: {problem or 'ok'} ({rows} rows, {seconds:.2f} s)", flush=True)


if __name__ == "__main__":
    main()
