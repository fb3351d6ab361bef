"""The log of a run: one file for each, in a format that the report reads."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.config import Output
from gleanspark.operators.logs import TRYING, VISITS

# Fixed value: the format of a line that the report reads.
FORMAT = "%(levelname)s %(asctime)s %(processName)s %(message)s"


def start(output: Output, offset: int, now: datetime | None = None) -> logging.Logger:
    """A logger that writes at level INFO to `{output_dir}/{logs}/{time}_offset{offset}.log`."""
    folder = Path(output.output_dir) / output.logs
    folder.mkdir(parents=True, exist_ok=True)
    handler = logging.FileHandler(folder / f"{(now or datetime.now()):%Y%m%d_%H%M%S}_offset{offset}.log", encoding="utf-8")
    handler.setFormatter(logging.Formatter(FORMAT))
    logger = logging.getLogger("gleanspark")
    for old in logger.handlers[:]:
        logger.removeHandler(old)
        old.close()
    logger.addHandler(handler)
    logger.setLevel(logging.INFO)
    return logger


def trying(logger: logging.Logger, base_url: str) -> None:
    logger.info("%s%s", TRYING, base_url)


def visits(logger: logging.Logger, done: int, most: int) -> None:
    """What a crawl did; it belongs to the url that was tried last."""
    logger.info("Crawl did %d%s%d.", done, VISITS, most)


def visited(seeds: DataFrame, trace: DataFrame | None) -> DataFrame:
    """(base_url, visits) of every seed, in order."""
    if trace is None:
        return seeds.select("base_url", F.lit(0).alias("visits"), "seed_pos").orderBy("seed_pos")
    done = trace.where("kind = 'visit'").groupBy("seed_pos").agg(F.count(F.lit(1)).alias("visits"))
    return seeds.join(done, "seed_pos", "left").select("base_url", F.coalesce("visits", F.lit(0)).alias("visits"), "seed_pos").orderBy("seed_pos")


def begun(logger: logging.Logger, keywords: Sequence[str], useragent: str) -> None:
    """What the run looks for, in order, and under which name."""
    logger.info("Keywords: %s; agent: %s", ", ".join(keywords), useragent)
