"""Run registered queries against their SQL twins on the generated tables: ``python -m tests.check [sf_dir] [name…]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = [None if v is None or v is pd.NA or v != v else v for v in df[c].astype(object)]
        df[c] = [str(int(v)) if isinstance(v, float) and v.is_integer() else str(v) for v in df[c]]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when the results agree, otherwise what differs first."""
    have = {n: _TYPES.get(t, t) for n, t in spark_df.dtypes}
    twin = con.sql(sql)
    need = {n: str(t) for n, t in zip(twin.columns, twin.types)}
    if have != need:
        return f"types {sorted(set(have.items()) ^ set(need.items()))}"
    got, want = _canonical(spark_df.toPandas()), _canonical(con.sql(sql).df())
    if list(got.columns) != list(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    for c in got.columns:
        off = got[c] != want[c]
        if off.any():
            i = off.idxmax()
            return f"{c}: {off.sum()} differ, first {got[c][i]!r} vs {want[c][i]!r}"
    return ""


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from sluice.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "check",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    names = argv[1:] or list(entry.queries())
    for name in names:
        start = time.time()
        try:
            result = entry.queries()[name](spark, sf_dir)
            verdict = difference(result, con, oracles[name]) if name in oracles else f"no oracle, {result.count()} rows"
        except Exception as exc:  # noqa: BLE001 - report and go on
            verdict = f"ERROR {str(exc).splitlines()[0][:300]}"
        failed = verdict and not verdict.startswith("no oracle")
        bad += bool(failed)
        print(f"{'FAIL' if failed else 'ok':5}{name:36}{time.time() - start:7.1f}s  {verdict}", flush=True)
    print(f"{len(names)} queries, {bad} differ; without oracle: {sorted(set(entry.queries()) - set(oracles))}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
