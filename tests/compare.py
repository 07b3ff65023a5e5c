"""Runs registered queries in Spark and their SQL in DuckDB on the same tables and compares all values."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None."""
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    want = rows_of(names, expected.fetchall())
    got = rows_of(spark_df.columns, spark_df.collect())
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            bad = sum(1 for a, b in zip(got, want) if a != b)
            return f"{bad} of {len(got)} rows differ; {sorted(names)}: spark {g} sql {w}"
    return None


def main() -> None:
    from motefield.queries import REGISTRY
    from motefield.session import build_session

    sf_dir = os.environ.get("COMPARE_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    wanted = sys.argv[1:]
    failed = []
    for name, query in REGISTRY.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = query.frame(spark, sf_dir)
            verdict = difference(df, con, query.oracle()) if query.sql else f"no sql, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - a failing query is a result of this tool
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        if verdict and not verdict.startswith("no sql"):
            failed.append(name)
        print(f"{name} {'ok' if verdict is None else verdict} {time.time() - start:.1f}s", flush=True)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main()
