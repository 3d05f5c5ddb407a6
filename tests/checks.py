"""Result comparison with the DuckDB oracle and physical-plan checks."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, Decimal):
        return v.normalize() if v == v else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _sort_key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def compare(spark_df: DataFrame, con, sql: str) -> dict:
    """Row count, column names and order-insensitive values of a Spark result
    against a DuckDB statement."""
    rel = con.sql(sql)
    o_cols = list(rel.columns)
    o_rows = rel.fetchall()
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    out = {"spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": sorted(s_cols) == sorted(o_cols)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
        out["match"] = False
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    o_idx = {c: i for i, c in enumerate(o_cols)}
    s_set = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_sort_key)
    o_set = sorted((tuple(_norm(r[o_idx[s_cols[i]]]) for i in order) for r in o_rows), key=_sort_key)
    out["match"] = s_set == o_set
    if not out["match"]:
        diff_s = [r for r in s_set if r not in set(o_set)][:3]
        diff_o = [r for r in o_set if r not in set(s_set)][:3]
        out["only_spark"], out["only_oracle"] = diff_s, diff_o
        out["cols_sorted"] = [s_cols[i] for i in order]
    return out


def physical_plan(df: DataFrame) -> str:
    """The formatted physical plan as text (for plan-shape checks)."""
    return df._jdf.queryExecution().executedPlan().toString()


def single_partition_exchanges(df: DataFrame) -> int:
    """Number of ``Exchange SinglePartition`` nodes in the physical plan."""
    return physical_plan(df).count("SinglePartition")
