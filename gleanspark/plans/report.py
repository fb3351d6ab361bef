"""Figures on finished runs: from scraped rows and from logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pages_per_site(scraped: DataFrame) -> DataFrame:
    """(base_url, n_pages); rows without a site do not count, nor do null urls."""
    return scraped.where("base_url IS NOT NULL").groupBy("base_url").agg(F.count("url").alias("n_pages"))


def pages_histogram(scraped: DataFrame) -> DataFrame:
    """(pages, counts): how many sites have how many pages."""
    return pages_per_site(scraped).groupBy(F.col("n_pages").alias("pages")).agg(F.count(F.lit(1)).alias("counts"))


def orphan_visits(by_url: DataFrame, seeds: DataFrame) -> DataFrame:
    """Urls with logged visits that were never tried; only the empty one can be."""
    tried = by_url.where("tried").select("base_url")
    return by_url.select("base_url", "visits_max_logged").join(tried, "base_url", "left_anti")


def run_summary(scraped: DataFrame, by_url: DataFrame, seeds: DataFrame) -> DataFrame:
    """One row: sites given and tried, tried without and with visits, sites and pages scraped, sites with one page, most pages."""
    tried = by_url.where("tried").agg(
        F.count(F.lit(1)).alias("urls_tried"), F.count_if(F.col("visits_max_logged") == 0).alias("without_visits"), F.count_if(F.col("visits_max_logged") > 0).alias("with_visits")
    )
    # One pass over the rows: by site first, null sites too; those count as pages, but are no site.
    site = F.col("base_url").isNotNull()
    per_site = scraped.groupBy("base_url").agg(F.count("url").alias("n_pages"), F.count(F.lit(1)).alias("n_rows")).agg(
        F.count_if(site).alias("sites_scraped"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("pages_scraped"),
        F.count_if(site & (F.col("n_pages") == 1)).alias("sites_with_one_page"), F.coalesce(F.max(F.when(site, F.col("n_pages"))), F.lit(0)).alias("most_pages"),
    )
    given = seeds.agg(F.count(F.lit(1)).alias("urls_given"))
    # Three relations of one row each.
    key = F.lit(1).alias("_one")
    out = given.select("*", key)
    for other in (tried, per_site):
        out = out.join(other.select("*", key), "_one")
    return out.drop("_one")


def preview(scraped: DataFrame, rows: int = 2, characters: int = 100) -> DataFrame:
    """The first rows by site and url, with the beginning of their text."""
    return scraped.orderBy("base_url", "url").limit(rows).withColumn("content", F.left("content", F.lit(characters)))


def write_counts(histogram: DataFrame, path: str) -> None:
    """The histogram as one CSV file with a header: a row for each number of pages that occurs."""
    histogram.coalesce(1).sortWithinPartitions("pages").write.mode("overwrite").option("header", True).csv(path)
