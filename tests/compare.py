"""Compare a query with its check SQL, value by value and without regard to row order."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

from fleetlens.plans.model import SOURCES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in SOURCES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, (float, decimal.Decimal)):
        return f"f{float(value)!r}"
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return f"date {value.isoformat()}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_plain(r[i]) for i in order) for r in rows])


def compare(df, con, sql: str) -> tuple[list[str], int]:
    """Problems (empty when equal) and the row count."""
    cols, got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    problems = []
    if cols != want_cols:
        problems.append(f"columns: only here {set(cols) - set(want_cols)}, only there {set(want_cols) - set(cols)}")
    elif len(got) != len(want):
        problems.append(f"rows: {len(got)} here, {len(want)} there")
    elif got != want:
        for g, w in zip(got, want):
            if g != w:
                diff = [(c, a, b) for c, a, b in zip(cols, g, w) if a != b]
                problems.append(f"values: {diff[:4]}")
                break
    return problems, len(got)


def main(argv):
    from fleetlens.plans.catalog import oracle_sql, queries
    from fleetlens.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    checks = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in checks:
                problems, n = compare(df, con, checks[name])
            else:
                problems, n = [], df.count()
        except Exception as e:  # noqa: BLE001
            problems, n = [f"{type(e).__name__}: {str(e)[:900]}"], -1
        took = time.time() - start
        note = "" if name in checks else " (rows only)"
        empty = " EMPTY" if n == 0 else ""
        print(f"{'ok ' if not problems else 'BAD'} {name} rows={n} {took:.2f}s{note}{empty} {problems or ''}", flush=True)
        bad += bool(problems)
    print(f"bad={bad} in {sf_dir}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
