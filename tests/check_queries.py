"""Compare every registered query with its SQL on the given tables: ``check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


SAME_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "SMALLINT": "smallint",
}


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, (int, float)):
        return (2, float("-inf") if isinstance(value, float) and math.isnan(value) else value)
    if isinstance(value, (dt.date, dt.datetime)):
        return (3, str(value))
    return (4, str(value))


def rows_of(rows, order):
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: [_key(v) for v in r])


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    types = [str(d[1]) for d in relation.description]
    expected = relation.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    mine = dict(spark_df.dtypes)
    for n, t in zip(names, types):
        if SAME_TYPES.get(t) != mine[n]:
            return f"column {n}: {mine[n]} against {t}"
    got = [tuple(r) for r in spark_df.collect()]
    columns = sorted(names)
    a = rows_of(got, [spark_df.columns.index(c) for c in columns])
    b = rows_of(expected, [names.index(c) for c in columns])
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{columns}: {x} against {y}"
    return None


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("CHECK_PARTITIONS", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    wrong = 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                verdict = "ok" if problem is None else f"DIFFERS {problem[:600]}"
            else:
                verdict = f"rows only ({df.count()})"
        except Exception as error:
            verdict = "FAILS " + "".join(traceback.format_exception_only(type(error), error))[:700]
        wrong += verdict[0] in "DF"
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{wrong} of {len(argv[1:] or queries)} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
