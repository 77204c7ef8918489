"""Compare registered queries with their oracle SQL: ``python -m checks.compare SF [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)

    def text(v) -> str:
        if v is None:
            return "null"
        return f"{float(v):.6f}" if isinstance(v, float) else str(v)

    frame = frame.map(text)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def differences(spark, con, sf_dir: str, name: str) -> str:
    """Empty when both engines agree on columns, row count and every value."""
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLES[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _canonical(got), _canonical(want)
    unlike = (a != b).any(axis=1)
    if unlike.any():
        at = unlike[unlike].index[:3]
        return f"{unlike.sum()} rows differ:\n{a.loc[at].to_dict('records')}\n{b.loc[at].to_dict('records')}"
    return ""


def main() -> int:
    from checks.local import local_session

    sf_dir, names = f"/root/testdata/{sys.argv[1]}", sys.argv[2:] or list(QUERIES)
    spark, con, failed = local_session(), oracle_connection(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name}: {problem or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
