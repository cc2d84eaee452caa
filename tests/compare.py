"""Run registered queries against their SQL: ``python tests/compare.py <folder> [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row)


def normal(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def sorted_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    table = [tuple(normal(row[k]) for k in order) for row in rows]
    return [columns[k] for k in order], sorted(table, key=_key)


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_result(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    return sorted_rows([d[0] for d in result.description], result.fetchall())


def difference(left: tuple, right: tuple) -> str | None:
    """A description of the first difference, or None."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if not wrong:
        return None
    a, b = wrong[0]
    cells = [(c, x, y) for c, x, y in zip(left[0], a, b) if x != y]
    return f"{len(wrong)} rows differ, first {a[:3]}..: {cells[:4]}"


def main(folder: str, names: list[str]) -> int:
    from tickloom.registry.queries import callables, statements
    from tickloom.session import build_session

    spark = build_session(
        "compare", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, failed = connect(folder), statements(), 0
    for name, run in callables().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            got = spark_result(run(spark, folder))
            spark_seconds, started = time.time() - started, time.time()
            if name not in sql:
                print(f"{name:24} rows only: {len(got[1])}  {spark_seconds:.1f}s", flush=True)
                continue
            problem = difference(got, sql_result(db, sql[name]))
            sql_seconds = time.time() - started
        except Exception as error:  # noqa: BLE001
            failed += 1
            print(f"{name:24} ERROR {type(error).__name__} {str(error)[:600]}", flush=True)
            continue
        failed += problem is not None
        print(f"{name:24} {problem or 'ok'}  rows={len(got[1])} spark={spark_seconds:.1f}s "
              f"sql={sql_seconds:.1f}s", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
