"""Compare a Spark query with its SQL on the same tables."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_value(r[i]) for i in order) for r in rows),
        key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t),
    )


def compare(df, con, sql: str, times: dict | None = None) -> str:
    """'' if equal, else what differs; `times` takes the seconds of both sides."""
    times = {} if times is None else times
    start = time.time()
    rel = con.execute(sql)
    duck_cols = [d[0] for d in rel.description]
    duck_types = {d[0]: str(d[1]) for d in rel.description}
    theirs = rel.fetchall()
    times["sql"] = time.time() - start
    times["rows"] = len(theirs)
    start = time.time()
    spark_types = dict(df.dtypes)
    if sorted(df.columns) != sorted(duck_cols):
        return f"columns {sorted(df.columns)} != {sorted(duck_cols)}"
    same = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    odd = {c: (spark_types[c], duck_types[c]) for c in df.columns if same.get(spark_types[c]) != duck_types[c]}
    pdf = df.toPandas()
    times["spark"] = time.time() - start
    ours = _rows(list(pdf.columns), [tuple(None if v is None else (v.item() if hasattr(v, "item") else v) for v in r) for r in pdf.itertuples(index=False)])
    theirs = _rows(duck_cols, theirs)
    note = f" types {odd}" if odd else ""
    if len(ours) != len(theirs):
        a, b = set(ours), set(theirs)
        return f"rows {len(ours)} != {len(theirs)}; only spark {list(a - b)[:2]}; only sql {list(b - a)[:2]}{note}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ, e.g. {bad[0]}{note}"
    return note
