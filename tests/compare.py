"""Compare a Spark result with a DuckDB statement, row for row, without rounding."""

from collections import Counter

import duckdb

TABLES = ("lineitem", "part")


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    columns, ours = as_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    expected_columns, expected = as_rows(names, cursor.fetchall())
    assert columns == expected_columns
    missing, extra = expected - ours, ours - expected
    assert not missing and not extra, (
        f"{sum(expected.values())} expected, {sum(ours.values())} found; "
        f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
    )
    return sum(ours.values())
