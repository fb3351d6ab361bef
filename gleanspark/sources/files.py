"""Seed and keyword lists, result folders and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanspark import model
from gleanspark.functions import texts, urls


def _stripped(line: Column) -> Column:
    """Without white space at the end, as Python's rstrip() has it."""
    return F.regexp_replace(line, r"[\s\x1C-\x1F\x85\p{Z}]+$", "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, line) of a text file; blank lines count, a newline at the end opens no line; any newline style."""
    whole = spark.read.text(path, wholetext=True)
    parts = F.split("value", r"\r\n|\r|\n", -1)
    kept = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return whole.select(F.posexplode(kept).alias("pos", "line"))


def slice_of(lines: DataFrame, offset: int, limit: int | None) -> DataFrame:
    """The lines from `offset` on, `limit` at most, by position."""
    end = F.lit(True) if limit is None else F.col("pos") < offset + limit
    return lines.where((F.col("pos") >= offset) & end)


def seeds_of(lines: DataFrame, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Seeds from (pos, line); positions count from the slice's first line."""
    base = _stripped(F.col("line"))
    rows = slice_of(lines, offset, limit).select((F.col("pos") - offset).cast("long").alias("seed_pos"), base.alias("base_url"))
    rows = rows.withColumn("start_url", urls.with_scheme(F.col("base_url")))
    return rows.withColumn("start_domain", urls.netloc(F.col("start_url")))


def read_keywords(spark: SparkSession, path: str) -> list[str]:
    """The patterns in order; blank lines stay and match everywhere."""
    return [r["line"] for r in read_lines(spark, path).select("pos", _stripped(F.col("line")).alias("line")).orderBy("pos").collect()]


def read_results(spark: SparkSession, path: str, valid_only: bool = True) -> DataFrame:
    """All result rows below a folder, of all runs; the batch number is left out."""
    rows = spark.read.schema("base_url string, url string, first_keyword_hit string, content string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)
    return rows.where(texts.is_valid(F.col("content"))) if valid_only else rows


def write_results(rows: DataFrame, path: str) -> None:
    """Appends rows as snappy Parquet in one folder for each batch; many batches share a task, and a batch one."""
    rows.repartition("batch").sortWithinPartitions("batch").write.mode("append").option("compression", "snappy").partitionBy("batch").parquet(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of all *.log files below a folder; only newlines end lines."""
    whole = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.log").text(path, lineSep="\n")
    lines = whole.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    # A file's blocks are read in one task each, lines in order.
    order = Window.partitionBy("file").orderBy("block", "id")
    return lines.select("file", (F.row_number().over(order) - 1).cast("long").alias("line_no"), "line")


def empty(spark: SparkSession, schema: str = model.SCRAPED) -> DataFrame:
    return spark.createDataFrame([], schema)
