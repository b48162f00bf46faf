"""Compare registered queries with their SQL on DuckDB.

    python tests/compare.py [sf_dir] [name ...]
"""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, float):
        return repr(value) if value != int(value) else str(int(value))
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10] if len(value.isoformat()) <= 19 else value.isoformat()
    return str(value)


def as_rows(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    columns, rows = as_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_columns, want = as_rows([c[0] for c in cursor.description], cursor.fetchall())
    if columns != want_columns:
        return f"columns {columns} <> {want_columns}"
    if len(rows) != len(want):
        return f"{len(rows)} rows <> {len(want)}"
    for got, expected in zip(rows, want):
        if got != expected:
            return f"{columns}\n  spark {got}\n  sql   {expected}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as e
    from dockflow.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            text = difference(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            text = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += text is not None and not text.startswith("rows only")
        print(f"{'ok  ' if text is None else 'DIFF'} {name} {time.time() - start:.2f}s", text or "",
              flush=True)
    print("differences:", bad)
