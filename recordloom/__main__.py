"""python -m recordloom QUERY DATA [--out PATH] [--format parquet|json|csv] [--limit N]: runs a registered query."""

from __future__ import annotations

import argparse


def positive(text: str) -> int:
    value = int(text)
    if value < 1:
        raise argparse.ArgumentTypeError("a positive number")
    return value


def parser(names: list[str]) -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="recordloom")
    out.add_argument("query", choices=names, metavar="QUERY", help=", ".join(names))
    out.add_argument("data", help="folder of the tables' parquet files")
    out.add_argument("--out", help="where to write; without it rows are shown")
    out.add_argument("--format", choices=("parquet", "json", "csv"), default="parquet")
    out.add_argument("--limit", type=positive, default=20, help="rows shown")
    return out


def main() -> None:
    from pyspark.sql import SparkSession

    from .queries import queries
    from .sources.sinks import csv_ready

    found = queries()
    options = parser(sorted(found)).parse_args()
    rows = found[options.query](SparkSession.builder.appName("recordloom").getOrCreate(), options.data)
    if options.out:
        (csv_ready(rows) if options.format == "csv" else rows).write.mode("overwrite").format(options.format).save(options.out)
    else:
        rows.show(options.limit, truncate=False)


if __name__ == "__main__":
    main()
