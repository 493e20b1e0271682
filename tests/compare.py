"""Compare every bound query with its SQL, side by side."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


SEEN: list[int] = []


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return ("", "")
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, float):
        return ("n", "nan" if math.isnan(value) else f"{value:.9g}")
    if isinstance(value, int):
        return ("n", f"{float(value):.9g}" if abs(value) < 1 << 53 else str(value))
    return ("s", str(value))


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None when equal, else what differs first."""
    rows = [tuple(r) for r in df.collect()]
    SEEN[:] = [len(rows)]
    left = table(df.columns, rows)
    con.execute(sql)
    right = table([d[0] for d in con.description], con.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"row {a} / {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from tests.conftest import session

    sf_dir = sys.argv[1]
    only = set(sys.argv[2:])
    spark, con = session(), connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            n = df.count() if name not in sql else None
            problem = f"no SQL, {n} rows" if name not in sql else difference(df, con, sql[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28} {time.time() - start:6.2f}s {SEEN} {problem or 'ok'}", flush=True)
    print("different:", bad)
