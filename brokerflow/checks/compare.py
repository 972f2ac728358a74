"""Run registered queries next to their DuckDB equivalents: python -m brokerflow.checks.compare DIR [QUERY ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import pandas as pd

from brokerflow.checks.oracles import ORACLES
from brokerflow.checks.queries import QUERIES


def _value(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return repr(v)


def _rows(frame: pd.DataFrame) -> Counter:
    names = sorted(frame.columns)
    return Counter(tuple(_value(v) for v in row) for row in frame[names].itertuples(index=False, name=None))


def difference(got: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    """What differs between two results, order aside; None when nothing does."""
    if sorted(got.columns) != sorted(wanted.columns):
        return f"columns {sorted(got.columns)} against {sorted(wanted.columns)}"
    a, b = _rows(got), _rows(wanted)
    if a == b:
        return None
    return f"rows {len(got)} against {len(wanted)}; only Spark {list((a - b).items())[:2]}; only SQL {list((b - a).items())[:2]}"


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def main() -> int:
    from brokerflow.checks.session import make_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, connection, failed = make_session(), duck(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - started
            verdict = difference(got, connection.sql(ORACLES[name]).df()) if name in ORACLES else "no SQL"
        except Exception as error:  # report every query, then fail
            took, verdict = time.time() - started, f"{type(error).__name__}: {str(error)[:400]}"
        ok = verdict in (None, "no SQL")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {took:6.2f}s {verdict or ''}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
