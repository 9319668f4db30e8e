"""Runs registered queries next to their SQL and compares rows. Also a command:

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# SQL types that have one counterpart.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "HUGEINT": "a wide integer", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def open_tables(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def difference(df, connection, sql: str) -> str | None:
    """None when the rows are equal, else what differs."""
    names = sorted(df.columns)
    got = sorted((tuple(_plain(r[n]) for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    cursor = connection.execute(sql)
    found = [d[0] for d in cursor.description]
    if sorted(found) != names:
        return f"columns {names} != {sorted(found)}"
    order = [found.index(n) for n in names]
    kinds = {d[0]: str(d[1]).upper() for d in cursor.description}
    for name, kind in df.dtypes:
        if TYPES.get(kinds[name], kind) != kind:
            return f"column {name} is {kind} here and {kinds[name]} in SQL"
    want = sorted((tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            count = sum(a != b for a, b in zip(got, want))
            return f"{count} of {len(got)} rows differ, first {dict(zip(names, mine))} != {dict(zip(names, theirs))}"
    return None


def main(folder: str, names: list[str]) -> None:
    import __spark_entry__ as entry
    from keeprate.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_tables(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            df = query(spark, folder)
            result = difference(df, connection, sql[name]) if name in sql else f"-- {len(df.collect())} rows only"
        except Exception as error:  # noqa: BLE001 - reported per query
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += bool(result) and not str(result).startswith("--")
        print(f"{time.time() - started:6.1f}s {name}: {result or 'equal'}", flush=True)
    print(f"{bad} differing or failing")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
