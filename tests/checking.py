"""Runs a registered query and its SQL twin and compares them cell by cell."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, decimal.Decimal):
        return "decimal"
    if isinstance(value, datetime.datetime):
        return "timestamp"
    return type(value).__name__


def table_of(columns, rows):
    """Columns by name, rows in any order; values with their type, so 1 and 1.0 differ."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    cells = [tuple((kind(r[i]), r[i]) if r[i] is not None else ("", "") for i in order) for r in rows]
    return names, sorted(cells, key=repr)


def compare(spark_df, db, sql) -> str | None:
    """None when equal, else what differs."""
    names, mine = table_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = db.execute(sql)
    other_names, theirs = table_of([d[0] for d in result.description], result.fetchall())
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    if not mine:
        return "no rows on either side"
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            cells = [(n, x[1], y[1]) for n, x, y in zip(names, a, b, strict=True) if x != y]
            return f"first difference {cells[:4]}"
    return None


def main():
    """Check queries by name prefix: python tests/checking.py [sf] [prefix...]"""
    from __spark_entry__ import oracle_sql, queries
    from lakeworks.runtime import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "checking", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, oracles, bad = database(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = compare(df, db, oracles[name])
                state = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                rows = df.collect()
                state = f"rows {len(rows)} {rows[:1]}"
        except Exception as error:  # noqa: BLE001
            state = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += state.startswith(("DIFFERS", "FAILED"))
        print(f"{name:42s} {time.time() - start:6.1f}s {state}", flush=True)
    print(f"{bad} bad", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
