"""Thin command line over the queries: list them, or run one and write its rows."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import queries


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lexmill")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of the queries")
    run = commands.add_parser("run", help="runs one query over a folder of tables")
    run.add_argument("query", choices=sorted(queries.QUERIES))
    run.add_argument("tables")
    run.add_argument("--out", help="folder for the rows as Parquet; shown otherwise")
    given = parser.parse_args(arguments)
    if given.command == "list":
        print("\n".join(sorted(queries.QUERIES)))
        return
    rows = queries.QUERIES[given.query](SparkSession.builder.getOrCreate(), given.tables)
    if given.out:
        rows.write.mode("overwrite").parquet(given.out)
    else:
        rows.show(50, truncate=80)


if __name__ == "__main__":
    main()
