"""Compare a query with its oracle: same columns, same rows as a multiset."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description of what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    wide = [n for n, k in kinds.items() if "HUGEINT" in k or "DECIMAL" in k]
    if wide:
        return f"oracle types too wide: {wide}"
    got = rows_of(df.columns, df.collect())
    if got == expected:
        return None
    return (
        f"rows {sum(got.values())} vs {sum(expected.values())}; "
        f"only in spark: {list((got - expected))[:2]}; only in oracle: {list((expected - got))[:2]}"
    )
