"""Run registered queries and their SQL side by side and compare all rows.

    python tests/compare.py [name ...] [--sf DIR]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(t[i]) for i in order) for t in tuples]
    return [columns[i] for i in order], sorted(rows, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(spark_result, sql_result) -> str | None:
    """None when equal, else a short description of the first differences."""
    (names, rows), (sql_names, expected) = spark_result, sql_result
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    wrong = [(r, e) for r, e in zip(rows, expected) if repr(r) != repr(e)]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, e.g.\n  {names}\n  {wrong[0][0]}\n  {wrong[0][1]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from matchforge.session import build_session, staged_run

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf_dir = args[at + 1]
        del args[at:at + 2]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if args and name not in args:
            continue
        started = time.time()
        try:
            with staged_run(spark):
                result = spark_rows(query(spark, sf_dir))
            took = time.time() - started
            note = difference(result, sql_rows(con, oracle[name])) if name in oracle else None
        except Exception as error:  # report and go on with the next query
            note, took, result = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - started, ((), ())
        bad += note is not None
        kind = "" if name in oracle else " (no SQL)"
        print(f"{'ok  ' if note is None else 'DIFF'} {name:32s} {len(result[1]):7d} rows {took:6.2f}s{kind}"
              + (f"\n     {note}" if note else ""), flush=True)
    print(f"{bad} differ")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
