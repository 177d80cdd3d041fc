"""Compare a Spark result with an oracle result, order-insensitively."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, _plain(x)) for k, x in sorted(v.items()))
    return v


def _sort_key(row):
    # Floats last and coarse, so that a last-digit difference does not reorder rows.
    coarse = tuple("\0" if v is None else (f"{v:.6e}" if isinstance(v, float) else str(v)) for v in row)
    solid = tuple("\0" if v is None else str(v) for v in row if not isinstance(v, float))
    return solid, coarse


def compare(spark_df, con, sql: str) -> tuple[str, int]:
    """("exact" | "close" | reason, number of rows)."""
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_types = {d[0]: str(d[1]) for d in cur.description}
    o_rows = cur.fetchall()
    s_cols = spark_df.columns
    if sorted(s_cols) != sorted(o_cols):
        return f"columns differ: only spark {sorted(set(s_cols) - set(o_cols))}, only oracle {sorted(set(o_cols) - set(s_cols))}", 0
    cols = sorted(s_cols)
    s_types = dict(spark_df.dtypes)
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    odd = [f"{c}:{s_types[c]}/{o_types[c]}" for c in cols if s_types[c] in same and same[s_types[c]] != o_types[c]]
    s_rows = [tuple(_plain(r[c]) for c in cols) for r in spark_df.collect()]
    pos = [o_cols.index(c) for c in cols]
    o_rows = [tuple(_plain(r[i]) for i in pos) for r in o_rows]
    if len(s_rows) != len(o_rows):
        return f"row counts differ: spark {len(s_rows)} oracle {len(o_rows)} {odd[:4]}", len(s_rows)
    s_rows.sort(key=_sort_key)
    o_rows.sort(key=_sort_key)
    status = "exact"
    for a, b in zip(s_rows, o_rows, strict=True):
        if a == b:
            continue
        for c, x, y in zip(cols, a, b, strict=True):
            if x == y:
                continue
            if isinstance(x, (int, float)) and isinstance(y, (int, float)) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                status = f"close in {c}: {x!r} {y!r}"
                continue
            return f"values differ in {c}: spark {x!r} oracle {y!r}; row {dict(zip(cols, a))} vs {dict(zip(cols, b))}"[:1500], len(s_rows)
    return (status if not odd else f"{status}, types {odd[:6]}"), len(s_rows)
