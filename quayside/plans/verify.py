"""Order-insensitive result comparison between Spark and DuckDB."""

from __future__ import annotations

import datetime as dt
import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(data_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


# Spark type -> the DuckDB type the oracle must produce for it.
SPARK_TO_DUCK = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
                 "boolean": "BOOLEAN", "int": "INTEGER", "date": "DATE"}


def compare(df, con, sql: str):
    """Return (ok, message) for a Spark DataFrame vs a DuckDB query:
    same column names, matching column types, same multiset of rows."""
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    drows = rel.fetchall()
    if sorted(df.columns) != sorted(dcols):
        return False, f"columns differ: spark={sorted(df.columns)} duck={sorted(dcols)}"
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    bad = [(c, stypes[c], t) for c, t in zip(dcols, dtypes) if SPARK_TO_DUCK.get(stypes[c], stypes[c]) != t]
    if bad:
        return False, f"column types differ: {bad}"
    a, b = canonical(df.columns, srows), canonical(dcols, drows)
    if a == b:
        return True, f"rows={len(a)}"
    sa, sb = set(a), set(b)
    return False, (f"spark={len(a)} duck={len(b)} only_spark={sorted(sa - sb)[:2]} "
                   f"only_duck={sorted(sb - sa)[:2]}")
