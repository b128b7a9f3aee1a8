"""Compare registered queries with their SQL: python tests/oracle_check.py [folder] [name...]"""

import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)):
        return round(float(x), 6)
    return str(x)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def oracle(folder, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = con.execute(sql)
    return _bag([d[0] for d in found.description], found.fetchall())


def compare(spark, folder, name):
    """None when the query and its SQL agree, else a short description of the difference."""
    df = entry.queries()[name](spark, folder)
    columns, got = _bag(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    wanted_columns, wanted = oracle(folder, sql)
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    if got != wanted:
        extra, lost = got - wanted, wanted - got
        return (
            f"{sum(got.values())} rows, wanted {sum(wanted.values())}; extra {list(extra.items())[:3]}, "
            f"missing {list(lost.items())[:3]}"
        )
    return None if got else "no rows"


if __name__ == "__main__":
    from conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = make_session()
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, folder, name)
        except Exception:
            problem = traceback.format_exc()[-1500:]
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.2f}s", problem or "", flush=True)
