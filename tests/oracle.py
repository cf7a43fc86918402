"""Runs a registered query and its SQL side by side and compares every value."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(spark, con, folder: str, query, sql: str) -> list[str]:
    """What differs; empty when schema and values are the same."""
    got = query(spark, folder)
    rows = [tuple(r) for r in got.collect()]
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    problems = []
    mine = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in got.schema.fields}
    if mine != kinds:
        problems.append(f"schema {sorted(mine.items())} != {sorted(kinds.items())}")
    if len(rows) != len(expected):
        problems.append(f"{len(rows)} rows != {len(expected)}")
    a, b = _sorted_rows(got.columns, rows), _sorted_rows(list(kinds), expected)
    if a != b and not problems:
        diff = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
        problems.append(f"{len(diff)} rows differ, first {str(diff[:2])[:600]}")
    return problems


def main() -> None:
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as registry

    from simsearch.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(registry.queries())
    folder = str(DATA / f"sf{sf}")
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracle = registry.queries(), registry.oracle_sql()
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                problems = compare(spark, con, folder, queries[name], oracle[name])
                word = "ok" if not problems else "DIFF " + "; ".join(problems)
            else:
                word = f"rows only: {len(queries[name](spark, folder).collect())}"
        except Exception as e:
            word = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {word}", flush=True)


if __name__ == "__main__":
    main()
