"""Run registered queries against their check SQL: python tests/check_all.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("orders", "events")


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def _same(a, b):
    if type(a) is not type(b):
        return False
    if isinstance(a, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def compare(df, con, sql) -> str | None:
    """None where equal, else a short description of the first difference."""
    got_columns, got = _rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    want_columns, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {set(got_columns) ^ set(want_columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for left, right in zip(got, want):
        for name, a, b in zip(got_columns, left, right):
            if not _same(a, b):
                return f"{name}: {a!r} != {b!r} in {left} / {right}"[:600]
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con, sqls = build_session(), duck(sf_dir), entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"no SQL, {len(df.collect())} rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
