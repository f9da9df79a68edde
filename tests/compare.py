"""Run queries beside their SQL in DuckDB and compare the rows.

As a script: ``python tests/compare.py /root/testdata/sf0.01 [name ...]``.
"""

import datetime
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN"}


def difference(df, sql, connection):
    """None if equal, else what differs."""
    answer = connection.execute(sql)
    columns = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    expected = _rows(columns, answer.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    wrong = [
        (f.name, f.dataType.simpleString(), kinds[f.name])
        for f in df.schema.fields
        if kinds[f.name] != _KINDS.get(f.dataType.simpleString(), "?")
        and kinds[f.name] not in ("NUMBER", "STRING", "DATETIME")
    ]
    got = _rows(df.columns, df.collect())
    if got != expected:
        only_got = list((got - expected).items())[:3]
        only_expected = list((expected - got).items())[:3]
        return (
            f"{sum(got.values())} rows, expected {sum(expected.values())}; sorted columns "
            f"{sorted(columns)}; only here {only_got}; only in SQL {only_expected}"
        )
    if not expected:
        return "no rows at all"
    if wrong:
        return f"types {wrong}"
    return None


def main():
    from __spark_entry__ import oracle_sql, queries
    from parcelhouse.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, connection, sql = local_session(), duck(sf_dir), oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                found = difference(df, sql[name], connection)
            else:
                found = None if df.count() else "no rows at all"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{name:28} {time.time() - began:6.2f}s {'ok' if found is None else found}", flush=True)
    print("failed:", bad)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
