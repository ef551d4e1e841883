"""Run registered queries next to their SQL: python tests/compare.py <sf_dir> [name ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() and abs(value) < 1e15 else repr(value)
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cooked = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cooked, key=repr)


def differences(spark, con, sf_dir: str, name: str, limit: int = 3) -> list[str]:
    from riskloom.catalog import ENTRIES

    e = ENTRIES[name]
    df = e.query(spark, sf_dir)
    columns, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if not e.oracle:
        return [] if rows else ["no rows"]
    result = con.execute(e.oracle)
    expected_columns, expected = rows_of([d[0] for d in result.description], result.fetchall())
    found = []
    if columns != expected_columns:
        found.append(f"columns {columns} != {expected_columns}")
    if len(rows) != len(expected):
        found.append(f"rows {len(rows)} != {len(expected)}")
    for a, b in zip(rows, expected):
        if a != b and len(found) < limit:
            found.append(f"{a}\n     != {b}")
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from tests.conftest import make_session

    from riskloom.catalog import ENTRIES

    spark = make_session()
    con = duck(sf_dir)
    bad = 0
    for name in names or ENTRIES:
        start = time.time()
        try:
            found = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        took = time.time() - start
        kind = "sql" if ENTRIES[name].oracle else "rows"
        print(f"{'FAIL' if found else 'ok  '} {name} [{kind}] {took:.2f}s", flush=True)
        for line in found:
            print("    ", line)
        bad += bool(found)
    print(f"{bad} of {len(names or ENTRIES)} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]) > 0)
