"""Runs registered queries as stages and tells how far a run is.

    python -m siltworks list
    python -m siltworks run-stage QUERY TABLES RUN
    python -m siltworks run TABLES RUN QUERY...
    python -m siltworks status RUN
    python -m siltworks estimate TABLES

RUN is a shared folder: results go to RUN/results/QUERY, the state of the stages to RUN/state. A stage that is complete is not
run again; one that failed or broke off is.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from siltworks.operators.state import RunState
from siltworks.plans import catalog
from siltworks.session import build_session, ship

Query = Callable[[SparkSession, str], DataFrame]


def run_stage(spark: SparkSession, state: RunState, name: str, query: Query, tables: str, results: str) -> bool:
    """Runs a stage unless it is complete; whether it ran. Its result is published before the stage counts as complete."""
    if state.is_complete(name):
        return False
    state.stage(name, "started")
    try:
        query(spark, tables).write.mode("overwrite").option("compression", "zstd").parquet(f"{results}/{name}")
    except Exception as e:
        state.stage(name, "failed", str(e)[:200])
        raise
    state.stage(name, "complete")
    return True


def estimate(spark: SparkSession, tables: str, names: Sequence[str] = ("prompts", "clustered_prompts", "responses", "documents")) -> DataFrame:
    """(table, rows) of the tables that a run would read."""
    return spark.createDataFrame([(n, spark.read.parquet(f"{tables}/{n}.parquet").count()) for n in names], "table string, rows long")


def main(argv: Sequence[str], spark: SparkSession | None = None, queries: Mapping[str, Query] | None = None) -> int:
    p = argparse.ArgumentParser(prog="siltworks")
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    for name, *args in (("run-stage", "query", "tables", "run"), ("run", "tables", "run", "queries"), ("status", "run"), ("estimate", "tables")):
        c = commands.add_parser(name)
        for a in args:
            c.add_argument(a, nargs="+" if a == "queries" else None)
    a = p.parse_args(argv)
    known = catalog.queries() if queries is None else dict(queries)
    if a.command == "list":
        print("\n".join(sorted(known)))
        return 0
    spark = spark or build_session()
    ship(spark)
    if a.command == "estimate":
        estimate(spark, a.tables).show(truncate=False)
        return 0
    state = RunState(spark, f"{a.run}/state")
    if a.command == "status":
        state.stages().show(1000, truncate=False)
        return 0
    wanted = [a.query] if a.command == "run-stage" else a.queries
    if unknown := [q for q in wanted if q not in known]:
        print(f"no such query: {', '.join(unknown)}", file=sys.stderr)
        return 2
    for q in wanted:
        print(q, "ran" if run_stage(spark, state, q, known[q], a.tables, f"{a.run}/results") else "was complete")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
