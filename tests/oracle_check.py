"""Compare a Spark query with its DuckDB oracle: row count, column names, type families, and
values (as a multiset, order-insensitive, exact)."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and v == 0.0:
        return 0.0
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


# type families that must agree between the engines (names differ, e.g. string / VARCHAR)
_FAMILY = {"string": "text", "varchar": "text", "double": "float64", "bigint": "int64", "int": "int32",
           "integer": "int32", "boolean": "bool"}


def _family(t: str) -> str:
    return _FAMILY.get(t.lower(), t.lower())


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_types = {f.name: _family(f.dataType.simpleString()) for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    o_cols = list(rel.columns)
    o_rows = rel.fetchall()
    o_types = {c: _family(str(t)) for c, t in zip(o_cols, rel.types)}
    out = {"spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": sorted(s_cols) == sorted(o_cols),
           "types_match": s_types == o_types}
    if out["columns_match"]:
        a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
        out["values_match"] = a == b
        if a != b:
            out["only_spark"] = list((a - b).items())[:3]
            out["only_oracle"] = list((b - a).items())[:3]
    else:
        out["values_match"] = False
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
    if not out["types_match"]:
        out["types"] = {c: (s_types.get(c), o_types.get(c)) for c in s_types if s_types.get(c) != o_types.get(c)}
    out["ok"] = out["values_match"] and out["types_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
