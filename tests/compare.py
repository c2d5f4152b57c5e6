"""Run registered queries next to their SQL in DuckDB and compare all values.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v) + 0.0)
        return str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))


def difference(got: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(got.columns) != sorted(wanted.columns):
        return f"columns {sorted(got.columns)} != {sorted(wanted.columns)}"
    a, b = _canonical(got), _canonical(wanted)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


_SAME = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_difference(spark_types: list[tuple[str, str]], con, sql: str) -> str | None:
    """Columns whose type in the other engine is not the plain counterpart."""
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    odd = [f"{n}: {t} / {theirs.get(n)}" for n, t in spark_types if _SAME.get(t) != theirs.get(n)]
    return ", ".join(odd) or None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from ledgerlark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                                   "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            got = df.toPandas()
            took = time.time() - start
            if name in sql:
                verdict = difference(got, con.execute(sql[name]).df()) or type_difference(df.dtypes, con, sql[name])
            else:
                verdict = f"no SQL, {len(got)} rows"
        except Exception as failure:  # report and go on with the next query
            took, verdict = time.time() - start, f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += bool(verdict and name in sql)
        print(f"{'ok ' if not verdict else '-- '}{name} {took:.2f}s {verdict or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
