"""Compare queries with their SQL, row by row.

Run as a script for a report: python tests/compare.py [folder] [query ...] [setting=value ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import pathlib
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = pathlib.Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, Counter(tuple(plain(row[n]) for n in names) for row in frame.collect())


def sql_rows(con, sql):
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    names = sorted(columns)
    places = [columns.index(n) for n in names]
    return names, Counter(tuple(plain(row[p]) for p in places) for row in found.fetchall())


def differences(frame, con, sql) -> str | None:
    """What differs between a DataFrame and the result of SQL, or None."""
    names, ours = spark_rows(frame)
    their_names, theirs = sql_rows(con, sql)
    if names != their_names:
        return f"columns {set(names) ^ set(their_names)}"
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
    text = f"{sum(ours.values())} rows against {sum(theirs.values())}; {len(extra)} extra, {len(missing)} missing"
    if extra and missing:
        key = sorted(extra)[0][0] if all(None not in e[0] for e in extra) else extra[0][0]
        near = max(missing, key=lambda m: sum(a == b for a, b in zip(m[0], key)))[0]
        text += "; " + str([(n, a, b) for n, a, b in zip(names, key, near) if a != b][:6])
    elif extra or missing:
        text += f"; {(extra or missing)[0]}"
    return text


def main(sf_dir, *words):
    only = [word for word in words if "=" not in word]
    changed = dict(word.split("=") for word in words if "=" in word)
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from floodmark.session import build_session

    spark = build_session(
        "compare",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            **changed,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    queries = {name: query for name, query in entry.queries().items() if name in oracles}
    print("queries", len(queries), "without SQL", sorted(set(queries) - set(oracles)),
          "without query", sorted(set(oracles) - set(queries)))
    for name in only or queries:
        start = time.time()
        try:
            found = differences(queries[name](spark, sf_dir), con, oracles[name])
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)


if __name__ == "__main__":
    main(*(sys.argv[1:] or ["/root/testdata/sf0.001"]))
