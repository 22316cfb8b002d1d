"""A query's rows beside those of its SQL, as sets of values by column name."""

from collections import Counter

import duckdb

from changelake.plans.queries import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark, con, query, sql, sf_dir):
    """Differences in words; an empty list if there are none."""
    df = query(spark, sf_dir)
    got_columns, got = df.columns, df.collect()
    result = con.execute(sql)
    want_columns, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return [f"columns {sorted(got_columns)} instead of {sorted(want_columns)}"]
    left, right = rows_of(got_columns, map(tuple, got)), rows_of(want_columns, want)
    out = [f"{len(got)} rows instead of {len(want)}"] if len(got) != len(want) else []
    for name, these in (("only Spark", left - right), ("only SQL", right - left)):
        out += [f"{name} ({these.total()}): {sorted(these, key=str)[:3]}"] if these else []
    return out
