"""Jobs for spark-submit: clean extracts, extract landed pages, describe listings.

    python -m lotwise clean --portal_a in/a.csv --portal_b in/b.csv --out tables
    python -m lotwise extract --pages landed --dataset sold --out rows
    python -m lotwise stats --listings tables/all_listings --out stats
"""

from __future__ import annotations

import argparse

from lotwise import schemas
from lotwise.plans import pipelines
from lotwise.session import builder
from lotwise.sources.files import write_extract, write_table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lotwise")
    jobs = parser.add_subparsers(dest="job", required=True)
    clean = jobs.add_parser("clean")
    for dataset in pipelines.CLEANERS:
        clean.add_argument(f"--{dataset}")
    extract = jobs.add_parser("extract")
    extract.add_argument("--pages", required=True)
    extract.add_argument("--dataset", choices=list(pipelines.EXTRACTORS), required=True)
    stats = jobs.add_parser("stats")
    stats.add_argument("--listings", required=True)
    stats.add_argument("--approximate", action="store_true")
    for job in (clean, extract, stats):
        job.add_argument("--out", required=True)
    chosen = parser.parse_args(argv)

    spark = builder().getOrCreate()
    if chosen.job == "clean":
        paths = {d: getattr(chosen, d) for d in pipelines.CLEANERS if getattr(chosen, d)}
        pipelines.clean_extracts(spark, paths, chosen.out)
    elif chosen.job == "extract":
        pages = spark.read.schema(schemas.PAGES).parquet(chosen.pages)
        write_table(pipelines.extract_listings(pages, chosen.dataset), chosen.out)
    else:
        # One row per province and county: small enough for a single extract.
        listings = spark.read.parquet(chosen.listings)
        table = pipelines.regional_stats(listings, exact=not chosen.approximate)
        write_extract(table.orderBy("Province", "County"), chosen.out)


if __name__ == "__main__":
    main()
