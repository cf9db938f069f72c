"""Run every query and its SQL side by side: ``python tests/check_oracle.py [sf_dir] [name part]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver
from cladeflow.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> tuple[bool, str]:
    frame = driver.queries()[name](spark, sf_dir)
    columns, rows = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    cursor = connection.execute(driver.oracle_sql()[name])
    expected_columns, expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if columns != expected_columns:
        return False, f"columns {columns} / {expected_columns}"
    if rows != expected:
        missing, extra = sorted(set(expected) - set(rows)), sorted(set(rows) - set(expected))
        return False, f"{len(rows)}/{len(expected)} rows, missing {missing[:3]}, extra {extra[:3]}"
    return True, f"{len(rows)} rows"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    part = sys.argv[2] if len(sys.argv) > 2 else ""
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                 "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    connection = connect(sf_dir)
    failed = []
    for name in driver.queries():
        if part not in name:
            continue
        start = time.time()
        try:
            good, note = compare(spark, connection, sf_dir, name)
        except Exception as error:
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if good else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
