"""Command line: ``run`` the whole batch, ``append`` (or correct) a batch of reviews, ``withdraw`` one."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from reviewtide.operators.categories import MIN_REVIEWS
from reviewtide.plans.run import Warehouse, run, run_increment, run_withdrawal


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="reviewtide", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    whole = commands.add_parser("run")
    whole.add_argument("places", help="dirty JSON lines")
    whole.add_argument("reviews", help="dirty JSON lines")
    whole.add_argument("population", help="CSV with a header")
    more = commands.add_parser("append")
    more.add_argument("reviews", help="dirty JSON lines of this batch")
    more.add_argument("batch", help="name of the batch, such as its date")
    less = commands.add_parser("withdraw")
    less.add_argument("batch", help="name of a batch that was appended")
    for command in (whole, more, less):
        command.add_argument("out", help="folder of the lake and the prepared data")
        command.add_argument("category", help="text that categories of the star contain")
        command.add_argument("--database", default="default", help="where the star tables go")
        command.add_argument("--scale", type=int, default=0, help="of the decimal measures")
        command.add_argument(
            "--buckets", help="lay the star out for local joins: a number, or auto for one by size"
        )
        command.add_argument("--parts", type=int, help="of each star table; by default by size")
        command.add_argument("--min-reviews", type=int, default=MIN_REVIEWS)
        if command is not less:
            command.add_argument("--repair", choices=("blind", "token"), default="blind")
    return top


def main(arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("reviewtide").getOrCreate()
    buckets = int(given.buckets) if (given.buckets or "").isdigit() else given.buckets
    warehouse = Warehouse(given.category, given.database, given.scale, buckets, given.parts)
    rest = (given.out, warehouse, given.min_reviews)
    if given.command == "run":
        raw = (given.places, given.reviews, given.population)
        published = run(spark, *raw, *rest, given.repair)
    elif given.command == "append":
        published = run_increment(spark, given.reviews, given.batch, *rest, given.repair)
    else:
        published = run_withdrawal(spark, given.batch, *rest)
    for name, counts in published.parsed.items():
        print(f"{name}: {counts['records']} records, {counts['dropped']} dropped as malformed")
    for row in published.report:
        print(row.asDict())


if __name__ == "__main__":
    main()
