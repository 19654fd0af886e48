"""Compare registered queries with their SQL, by columns, row counts and values."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        if os.path.exists(f"{sf_dir}/{table}.parquet"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def difference(frame, connection, sql: str) -> str:
    """Empty where both sides agree, else what differs."""
    names = sorted(frame.columns)
    expected = connection.execute(f'SELECT {", ".join(chr(34) + n + chr(34) for n in names)} FROM ({sql})')
    columns = sorted(c[0] for c in connection.execute(f"DESCRIBE ({sql})").fetchall())
    if columns != names:
        return f"columns {names} vs {columns}"
    expected = Counter(connection.execute(f'SELECT {", ".join(chr(34) + n + chr(34) for n in names)} FROM ({sql})').fetchall())
    actual = Counter(tuple(row) for row in frame.select(*names).collect())
    if actual == expected:
        return ""
    return f"{sum(actual.values())} vs {sum(expected.values())} rows; ours only {list((actual - expected))[:2]}; theirs only {list((expected - actual))[:2]}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from changefold.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        result = difference(query(spark, sf_dir), connection, contract.oracle_sql()[name])
        print(f"{name:34s} {time.time() - start:6.2f}s  {result or 'ok'}", flush=True)
