"""Compare a registered query against its SQL equivalent run by DuckDB on the
same parquet files: row count, column names and an order-insensitive hash of
the values (columns sorted by name)."""

from __future__ import annotations

import hashlib
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def frame_digest(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), h


def duckdb_rows(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    rel = con.sql(sql)
    cols = list(rel.columns)
    rows = rel.fetchall()
    con.close()
    return cols, rows


def spark_rows(df):
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    return cols, rows


def compare(spark, key: str, sf_dir: str, queries: dict, oracle: dict) -> dict:
    s_cols, s_rows = spark_rows(queries[key](spark, sf_dir))
    out = {"key": key, "spark_rows": len(s_rows), "spark_cols": sorted(s_cols)}
    if key not in oracle:
        out["status"] = "rows-only"
        return out
    o_cols, o_rows = duckdb_rows(oracle[key], sf_dir)
    out["oracle_rows"] = len(o_rows)
    out["oracle_cols"] = sorted(o_cols)
    same_cols = sorted(s_cols) == sorted(o_cols)
    same_hash = frame_digest(s_cols, s_rows) == frame_digest(o_cols, o_rows)
    out["status"] = "match" if (same_cols and same_hash) else "MISMATCH"
    if not same_hash and same_cols:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_o = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
        a = sorted("|".join(_norm(r[i]) for i in order_s) for r in s_rows)
        b = sorted("|".join(_norm(r[i]) for i in order_o) for r in o_rows)
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:5]
        out["only_oracle"] = sorted(sb - sa)[:5]
    return out
