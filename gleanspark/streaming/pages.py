"""Page snapshots that keep arriving: parsed as they come, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gleanspark import model
from gleanspark.functions.markup import parse_pages
from gleanspark.operators.fetch import fetched


def arriving_contents(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of (url, content, hrefs) of the Parquet pages that land in a folder."""
    pages = spark.readStream.schema(model.PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return parse_pages(fetched(pages))


def store(contents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what there is and stops; the next start goes on from the checkpoint."""
    return contents.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
