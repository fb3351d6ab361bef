"""Run logs: lines put to the site that was tried last, and the figures they name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The two messages that count.
TRYING = "Trying to crawl base url: "
VISITS = " visits out of maximum "


def sessions(logs: DataFrame) -> DataFrame:
    """The marked lines (file, line_no, kind, base_url, visits); visits go to the url tried last, in any earlier file too.

    A visits line closes the url, so that another one falls to ''. The number is the one after the
    marker, up to the first point; null if it is not a number.
    """
    line = F.col("line")
    after = lambda mark: F.split_part(line, F.lit(mark), F.lit(2))
    tried = line.contains(TRYING)
    marked = logs.where(tried | line.contains(VISITS)).select(
        "file", "line_no",
        F.when(tried, "try").otherwise("visits").alias("kind"),
        F.when(tried, F.split_part(after(TRYING), F.lit("\n"), F.lit(1))).alias("url"),
        F.when(~tried, F.trim(F.split_part(after(VISITS), F.lit("."), F.lit(1))).try_cast("int")).alias("visits"),
    )
    state = F.coalesce("url", F.lit(""))
    within = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumn("own", F.last(state).over(within))
    # One row a file: what its last marked line leaves to the next one.
    left = marked.groupBy("file").agg(F.max_by(state, "line_no").alias("left"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    left = left.select("file", F.last("left").over(earlier).alias("given"))
    open_url = F.coalesce("own", "given", F.lit(""))
    return marked.join(left, "file").select("file", "line_no", "kind", F.when(F.col("kind") == "try", F.col("url")).otherwise(open_url).alias("base_url"), "visits")


def visits_by_url(sessions: DataFrame) -> DataFrame:
    """(base_url, tried, visits_max_logged): the last number logged for each url, 0 if there is none."""
    named = F.col("visits").isNotNull()
    last = F.max_by("visits", F.when(named, F.struct("file", "line_no")))
    return sessions.groupBy("base_url").agg(F.bool_or(F.col("kind") == "try").alias("tried"), F.coalesce(last, F.lit(0)).alias("visits_max_logged"))
