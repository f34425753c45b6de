"""Run the registered queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.registry import QUERIES
from footfall.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as comparable tuples, columns by name, order ignored."""
    frame = frame[sorted(frame.columns)].astype(object).where(frame[sorted(frame.columns)].notna(), None)

    def plain(value):
        if value is None or value is pd.NaT:
            return ""
        if isinstance(value, pd.Timestamp):
            return str(value.date())
        if isinstance(value, float) and value.is_integer():
            return str(int(value))
        return str(value)

    return sorted(tuple(plain(v) for v in row) for row in frame.itertuples(index=False))


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} <> {sorted(theirs.columns)}"
    a, b = canonical(ours), canonical(theirs)
    if a == b:
        return ""
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return f"rows {len(a)} <> {len(b)}; only ours {sorted(only_a)[:2]}; only oracle {sorted(only_b)[:2]}"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                    "spark.driver.memory": "8g",
                                                    "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            ours = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - started
            problem = difference(ours, con.execute(ORACLES[name]).df())
        except Exception as error:  # report and go on with the next query
            took, ours, problem = time.time() - started, [], f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {len(ours):7d} rows {took:6.2f} s {problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
