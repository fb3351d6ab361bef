"""`python -m gleanspark CONFIG PAGES [SITEMAP] [--robots ROBOTS]`: scrapes recorded pages into the run's folder."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from gleanspark import runlog
from gleanspark.config import load_config
from gleanspark.plans.scrape import build_pipeline
from gleanspark.sources import snapshots


def main(arguments: list[str] | None = None) -> str:
    """Runs the scrape and returns the folder of its rows."""
    parser = argparse.ArgumentParser(prog="gleanspark", description=__doc__)
    parser.add_argument("config")
    parser.add_argument("pages", help="Parquet of url, html and, if there are, status and content_type")
    parser.add_argument("sitemap", nargs="?", help="Parquet of domain, sm_pos, url")
    parser.add_argument("--robots", help="Parquet of domain, status, robots_txt")
    given = parser.parse_args(arguments)
    settings, began = load_config(given.config), time.time()
    spark = SparkSession.builder.appName("gleanspark").getOrCreate()
    logger = runlog.start(settings.output, settings.input.url_offset)
    pipeline, seeds, folder = build_pipeline(spark, settings)
    runlog.begun(logger, pipeline.crawler.keywords, pipeline.useragent)
    read = lambda path: spark.read.parquet(path) if path else None
    pages, robots = snapshots.pages_of(read(given.pages)), read(given.robots)
    sitemap = read(given.sitemap)
    trace = pipeline.crawler.trace(seeds, pipeline.visible(pages, robots)) if settings.crawl.max_visits > 0 else None
    # Seeds are one slice of a list, url_max at most.
    for row in runlog.visited(seeds, trace).toLocalIterator():
        runlog.trying(logger, row.base_url)
        if trace is not None:
            runlog.visits(logger, row.visits, settings.crawl.max_visits)
    pipeline.write(pipeline.run(seeds, pages, sitemap, robots, trace), folder)
    logger.info("Done in %s minutes, rows in %s", round((time.time() - began) / 60), folder)
    return folder


if __name__ == "__main__":
    main()
