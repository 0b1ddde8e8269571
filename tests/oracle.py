"""Runs registered queries against their SQL in DuckDB, rows compared as multisets with columns sorted by name."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], Counter(tuple(plain(r[k]) for k in order) for r in rows)


def compare(spark, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    a = multiset(df.columns, [tuple(r) for r in df.collect()])
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = c.sql(sql)
    b = multiset(found.columns, found.fetchall())
    if a[0] != b[0]:
        return f"columns {a[0]} and {b[0]}"
    if a[1] != b[1]:
        return f"{sum(a[1].values())} and {sum(b[1].values())} rows; only here {list((a[1] - b[1]).items())[:2]}; only there {list((b[1] - a[1]).items())[:2]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from millrace.plans import ORACLES, QUERIES
    from millrace.session import local_session

    spark = local_session(cpus=int(sys.argv[2]) if len(sys.argv) > 2 else 4, shuffle_partitions=4, memory="4g")
    spark.sparkContext.setLogLevel("OFF")
    bad = 0
    for name, query in QUERIES.items():
        if len(sys.argv) > 3 and not any(x in name for x in sys.argv[3:]):
            continue
        try:
            why = compare(spark, name, query, ORACLES[name], f"/root/testdata/{sys.argv[1]}") if name in ORACLES else (query(spark, f"/root/testdata/{sys.argv[1]}").collect() and None)
        except Exception as e:  # noqa: BLE001
            why = "ERROR " + str(e).strip()[:420]
        if why:
            bad += 1
            print(f"{name}: {why}\n", flush=True)
    print("bad:", bad, "of", len(QUERIES))
