"""Run a query in Spark and its oracle SQL in DuckDB; compare the results.

Usable from tests and from the command line:
``python tests/oracle_check.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from heldout.sources import TABLES  # noqa: E402


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(f"{sf_dir}/{t}.parquet")
        if not path.exists():
            continue
        # A table written by Spark is a folder of part files.
        source = f"{path}/*.parquet" if path.is_dir() else str(path)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{source}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.10g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


_SPARK_TO_DUCK = {
    "IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
    "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "FloatType": "FLOAT",
    "ShortType": "SMALLINT", "ByteType": "TINYINT", "DateType": "DATE",
}


def _duck_type(spark_type) -> str:
    name = type(spark_type).__name__
    if name == "DecimalType":
        return f"DECIMAL({spark_type.precision},{spark_type.scale})"
    return _SPARK_TO_DUCK.get(name, name)


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    # as a view, which is how another checker may run it
    con.execute(f'CREATE OR REPLACE VIEW "oracle_{name}" AS {sql}')
    rel = con.sql(f'SELECT * FROM "oracle_{name}"')
    d_cols = rel.columns
    s_types = {f.name: _duck_type(f.dataType) for f in sdf.schema.fields}
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
        "types_match": s_types == d_types,
    }
    if not out["types_match"]:
        out["type_differences"] = {c: (s_types.get(c), d_types.get(c))
                                   for c in set(s_types) | set(d_types)
                                   if s_types.get(c) != d_types.get(c)}
    out["values_match"] = out["columns_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    if not out["values_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_differences"] = diff
    return out


if __name__ == "__main__":
    import json

    from heldout.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry_mod

    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    names = sys.argv[2:] or list(qs)
    spark = build_session("local[8]", 8)
    con = duck_connection(sf)
    ok = True
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf)
            print(json.dumps({"name": n, "rows": df.count(), "oracle": None}))
            continue
        res = compare(spark, sf, n, qs[n], sqls[n], con)
        ok &= res["values_match"] and res["types_match"] and res["spark_rows"] == res["oracle_rows"]
        print(json.dumps(res, default=str))
    sys.exit(0 if ok else 1)
