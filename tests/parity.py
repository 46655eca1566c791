"""Compare the sample queries with their SQL counterparts.

``python tests/parity.py SF_DIR [query …]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Arrow type names under which both engines should return a column.
SAME = {"large_string": "string", "string_view": "string"}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def _shape(table: pa.Table) -> tuple[list[tuple[str, str]], list[tuple]]:
    names = sorted(table.column_names)
    types = [(n, SAME.get(str(table.schema.field(n).type), str(table.schema.field(n).type))) for n in names]
    rows = list(zip(*[table.column(n).to_pylist() for n in names])) if names else []
    return types, sorted(rows, key=repr)


def difference(spark_table: pa.Table, sql_table: pa.Table) -> str:
    """Empty if both tables hold the same columns, types and rows in any order."""
    (left_types, left), (right_types, right) = _shape(spark_table), _shape(sql_table)
    if left_types != right_types:
        return f"columns {left_types} against {right_types}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract
    from starlane.session import build_session

    spark = build_session("parity", "local[8]", spark__driver__memory="12g", spark__ui__enabled="false", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = oracle_connection(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        got = query(spark, sf_dir).toArrow()
        spent = time.time() - start
        wrong = difference(got, con.sql(oracle[name]).to_arrow_table()) if name in oracle else "no SQL"
        failed += bool(wrong)
        print(f"{name:28} {got.num_rows:8} rows {spent:6.2f} s  {wrong or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
