"""Run registered queries next to their SQL and compare the rows.

Usage: python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value: object) -> str:
    if isinstance(value, float):
        return repr(round(value, 9))
    return repr(value)


def normal(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str:
    """Empty when rows, columns and types agree, else what differs."""
    rows = [tuple(r) for r in spark_df.collect()]
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    wanted = found.fetchall()
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    a, b = normal(rows, spark_df.columns), normal(wanted, names)
    for x, y in zip(a, b):
        if x != y:
            return f"row {x} != {y}"
    types = {n: str(t) for n, t in zip(names, [d[1] for d in found.description])}
    simple = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for name, dtype in spark_df.dtypes:
        if simple.get(dtype) != types[name]:
            return f"type of {name}: {dtype} != {types[name]}"
    return ""


def main() -> None:
    from knotwork.session import local_session
    from workload import ORACLES, QUERIES

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session(8)
    con = connect(folder)
    bad = 0
    for name in names:
        at = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in ORACLES:
                difference = compare(frame, con, ORACLES[name])
                size = ""
            else:
                size = f"rows {len(frame.collect())}"
                difference = ""
        except Exception as error:  # report and go on with the next query
            difference, size = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += bool(difference)
        print(f"{'FAIL' if difference else 'ok  '} {name:28s} {time.time() - at:6.2f}s {size}{difference}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
