"""Runs the registered queries beside their SQL and reports where they differ."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from tabwright.checks.oracle import ORACLE
from tabwright.checks.queries import QUERIES
from tabwright.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _kind(arrow_type) -> str:
    return str(arrow_type).replace("large_string", "string")


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted((repr(row) for row in zip(*columns)))


def difference(name: str, spark, connection, sf_dir: str) -> str | None:
    """None if both sides agree, otherwise what differs."""
    ours = QUERIES[name](spark, sf_dir).toArrow()
    if name not in ORACLE:
        return None if ours.num_rows else "no rows"
    theirs = connection.execute(ORACLE[name]).to_arrow_table()
    our_types = {f.name: _kind(f.type) for f in ours.schema}
    their_types = {f.name: _kind(f.type) for f in theirs.schema}
    if our_types != their_types:
        apart = {k: (our_types.get(k), their_types.get(k)) for k in our_types | their_types
                 if our_types.get(k) != their_types.get(k)}
        return f"columns differ: {apart}"
    if ours.num_rows != theirs.num_rows:
        return f"{ours.num_rows} rows, not {theirs.num_rows}"
    a, b = _rows(ours), _rows(theirs)
    apart = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(apart)} rows differ, first {apart[0]}" if apart else None


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = difference(name, spark, connection, sf_dir)
        except Exception as error:  # reported, and the next query goes on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "exact" if name in ORACLE else "rows"
        print(f"{name} [{kind}] {time.time() - start:.1f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
