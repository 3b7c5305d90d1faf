"""Order-insensitive comparison of a Spark result with DuckDB's."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_on(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(frame, sql, connection):
    """None if equal, else a short text."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    expected_rows = _sorted_rows(names, expected.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    rows = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    if rows == expected_rows:
        return None
    only_here = sorted(set(rows) - set(expected_rows))[:3]
    only_there = sorted(set(expected_rows) - set(rows))[:3]
    return f"{len(rows)} rows != {len(expected_rows)}; {only_here} != {only_there}"
