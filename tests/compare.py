"""Compare a query's rows with those of its SQL, the way the driver does: columns by name, rows as a bag."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def differences(spark_df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    out = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind, kind) != types[name]:
            out.append(f"type of {name}: {kind} != {types[name]}")
    order = sorted(names)
    got = Counter(tuple(plain(r[c]) for c in order) for r in spark_df.collect())
    at = [names.index(c) for c in order]
    want = Counter(tuple(plain(r[i]) for i in at) for r in rows)
    if got != want:
        extra, lacking = got - want, want - got
        out.append(
            f"{sum(got.values())} rows, {sum(want.values())} expected; extra {sum(extra.values())} e.g. {list(extra)[:3]}; "
            f"lacking {sum(lacking.values())} e.g. {list(lacking)[:3]} (columns {order})"
        )
    return out
