"""Compare a DataFrame with what DuckDB computes on the same Parquet files."""

import datetime
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(df, connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = rows_of(columns, result.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"{sum(missing.values())} rows missing, e.g. {next(iter(missing), None)};"
        f" {sum(extra.values())} rows too many, e.g. {next(iter(extra), None)}"
    )
    assert sum(actual.values()) > 0
