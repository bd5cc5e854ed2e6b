"""Compare registered queries with their SQL in DuckDB.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

NAMES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _rows(table: pd.DataFrame) -> list[str]:
    columns = sorted(table.columns)
    plain = table[columns].astype(object).where(table[columns].notna(), None)
    return sorted(repr(tuple(str(v) for v in row)) for row in plain.itertuples(index=False))


def _kinds(ours: DataFrame, columns: list) -> list[str]:
    """Columns whose types differ, apart from the spelling of the type names."""
    spelled = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    kinds = {name: spelled.get(kind, kind.upper()) for name, kind in ours.dtypes}
    return [
        f"{name}: {kinds[name]} and {kind}"
        for name, kind in columns
        if str(kind).replace(" ", "") != kinds[name]
    ]


def difference(ours: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and rows; otherwise what differs."""
    # Types are compared through text, after whole columns became objects.
    left = pd.DataFrame([row.asDict() for row in ours.collect()], columns=ours.columns, dtype=object)
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    right = pd.DataFrame(result.fetchall(), columns=names, dtype=object)
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} and {sorted(right.columns)}"
    kinds = _kinds(ours, [(column[0], column[1]) for column in result.description])
    if kinds:
        return f"types {kinds}"
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    if _rows(left) == _rows(right):
        return None
    pairs = [(a, b) for a, b in zip(_rows(left), _rows(right)) if a != b]
    return f"{len(pairs)} rows differ, first {pairs[0]}"


def main() -> None:
    import __spark_entry__ as driver
    from verdure import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    statements = driver.oracle_sql()
    for name, query in driver.queries().items():
        if name not in statements or wanted and name not in wanted:
            continue
        start = time.time()
        try:
            result = difference(query(spark, folder), connection, statements[name])
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {str(error)[:1500]}"
        print(f"{name:32s} {time.time() - start:6.2f}s  {result or 'same'}", flush=True)


if __name__ == "__main__":
    main()
