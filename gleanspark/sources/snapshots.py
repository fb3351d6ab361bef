"""Web pages, robots files and sitemaps as relations: recorded ones, constant ones, and live ones."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gleanspark import model
from gleanspark.config import Requests

# Fixed value: the page that stands in for any other.
CONSTANT_PAGE = "\n<!doctype html>\n<html>\n<body>Hello</body>\n</html>"


def pages_of(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (url, html, and status and content_type if there are) as the page relation, with the rows' columns `keep`."""
    have = rows.columns
    status = F.col("status").cast("int") if "status" in have else F.lit(200)
    kind = F.col("content_type") if "content_type" in have else F.lit("text/html")
    return rows.select("url", status.alias("status"), kind.alias("content_type"), "html", *keep)


def constant_pages(urls: DataFrame, html: str = CONSTANT_PAGE) -> DataFrame:
    """The same page under every url, for tests of what comes after."""
    return pages_of(urls.select("url", F.lit(html).alias("html")))


def robots_by_domain(robots: DataFrame) -> DataFrame:
    """One robots file for each domain: should there be several, a successful answer before others, any answer before none, then the one that sorts first."""
    worth = F.when(F.col("status").between(200, 299), 0).when(F.col("status").isNotNull(), 1).otherwise(2)
    first = F.min(F.struct(worth.alias("worth"), "status", "robots_txt")).alias("r")
    return robots.groupBy("domain").agg(first).select("domain", "r.status", "r.robots_txt")


def sitemap_of(pages: DataFrame, domain: str = "domain", order: str = "page_id", keep: Sequence[str] = ()) -> DataFrame:
    """A sitemap from known pages: the urls of each domain, numbered in the given order, with the pages' columns `keep`."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(domain).orderBy(order)) - 1
    return pages.select(F.col(domain).alias("domain"), place.cast("long").alias("sm_pos"), "url", *keep)


def declared_sitemaps(robots: DataFrame) -> DataFrame:
    """(domain, pos, file_url): what robots files name as sitemaps, in order."""
    named = F.regexp_extract_all("robots_txt", F.lit(r"(?im)^[ \t]*sitemap[ \t]*:[ \t]*(\S+)"), F.lit(1))
    return robots.where("status = 200").select("domain", F.posexplode(named).alias("pos", "file_url"))


def _read_sitemap(xml: str | None) -> tuple[bool, list[str]]:
    """(whether it is an index of sitemaps, the urls it lists); broken files list nothing."""
    from xml.etree import ElementTree

    try:
        root = ElementTree.fromstring(xml or "")
    except (ElementTree.ParseError, ValueError):
        return False, []
    bare = lambda tag: tag.rpartition("}")[2] if isinstance(tag, str) else ""
    urls = [(e.text or "").strip() for entry in root for e in entry if bare(e.tag) == "loc"]
    return bare(root.tag) == "sitemapindex", [u for u in urls if u]


def sitemap_from_files(robots: DataFrame, files: DataFrame) -> DataFrame:
    """The sitemap relation from recorded sitemap files (file_url, xml): the declared ones and those that indexes lead to, however deep.

    Files that were not recorded or are broken list nothing; an index that leads to a file above it is not followed
    there again. Urls are numbered in the order of the tree.
    """
    from pyspark.sql import Window

    from gleanspark.checkpoints import with_checkpoints

    def parse(batches):
        for batch in batches:
            read = [_read_sitemap(x) for x in batch.column("xml").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("file_url"), pa.array([i for i, _ in read], pa.bool_()), pa.array([u for _, u in read], pa.list_(pa.string()))], names=["file_url", "is_index", "urls"])

    with_checkpoints(robots.sparkSession)
    parsed = files.select("file_url", "xml").mapInArrow(parse, "file_url string, is_index boolean, urls array<string>").checkpoint()
    asked, found = declared_sitemaps(robots).select("domain", "file_url", F.array("pos").alias("rank"), F.array("file_url").alias("above")), None
    while True:
        listed = asked.join(parsed, "file_url").select("domain", "rank", "above", "is_index", F.posexplode("urls").alias("i", "url"))
        listed = listed.select("domain", "above", "is_index", "url", F.concat("rank", F.array("i")).alias("rank")).checkpoint()
        pages = listed.where("not is_index").select("domain", "rank", "url")
        found = pages if found is None else found.unionAll(pages)
        asked = listed.where("is_index and not array_contains(above, url)").select("domain", F.col("url").alias("file_url"), "rank", F.concat("above", F.array("url")).alias("above"))
        if asked.isEmpty():
            break
    place = F.row_number().over(Window.partitionBy("domain").orderBy("rank")) - 1
    return found.select("domain", place.cast("long").alias("sm_pos"), "url")


class _Domain(InputPartition):
    def __init__(self, domain: str, urls: list[str]):
        self.domain, self.urls = domain, urls


class LivePages(DataSource):
    """`spark.read.format("live_pages")`: fetches urls, one partition for each domain, with pauses and retries.

    Options: urls (newline-separated), useragent, timeout_connect, timeout_read, max_retries, delay.
    Each try is a row (url, attempt, status, content_type, html); failures have a null status.
    """

    @classmethod
    def name(cls) -> str:
        return "live_pages"

    def schema(self) -> str:
        return model.ATTEMPTS

    def reader(self, schema):
        return _LiveReader(self.options)


class _LiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        from urllib.parse import urlparse

        by: dict[str, list[str]] = {}
        for url in self.options.get("urls", "").split("\n"):
            if url:
                by.setdefault(urlparse(url).netloc, []).append(url)
        return [_Domain(d, u) for d, u in by.items()] or [_Domain("", [])]

    def read(self, partition: _Domain) -> Iterator[tuple]:
        get = self.options.get
        settings = Requests(get("useragent", Requests.useragent), float(get("timeout_connect", Requests.timeout_connect)), float(get("timeout_read", Requests.timeout_read)), int(get("max_retries", Requests.max_retries)))
        yield from requested(partition.urls, settings, float(get("delay", DELAY)))


#: Seconds between two urls of one domain.
DELAY = 2.0


def requested(urls: Iterable[str], settings: Requests, delay: float) -> Iterator[tuple]:
    """(url, attempt, status, content_type, html) of every try, one url after another; failures have a null status."""
    import random
    import time
    import urllib.error
    import urllib.request

    headers = {"User-Agent": settings.useragent, "Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8", "Accept-Language": "en;q=0.9,*;q=0.5", "Accept-Encoding": "identity"}
    for i, url in enumerate(urls):
        if i:
            time.sleep(delay)
        for attempt in range(1 + settings.max_retries):
            if attempt:
                time.sleep(random.uniform(1, 5))
            try:
                with _opened(urllib.request.Request(url, headers=headers), settings) as got:
                    kind = got.headers.get("Content-Type", "")
                    body = got.read().decode(got.headers.get_content_charset() or "utf-8", "replace") if "text/html" in kind else None
                    yield url, attempt, got.status, kind, body
                    break
            except urllib.error.HTTPError as error:
                yield url, attempt, error.code, error.headers.get("Content-Type", ""), None
                break
            except (OSError, ValueError):
                yield url, attempt, None, None, None


def _opened(request, settings: Requests):
    """The answer to a request: connecting may take one time, each read another."""
    import http.client
    import urllib.request

    def patient(kind):
        class Connection(kind):
            def connect(self):
                super().connect()
                self.sock.settimeout(settings.timeout_read)

        return Connection

    class Http(urllib.request.HTTPHandler):
        def http_open(self, req):
            return self.do_open(patient(http.client.HTTPConnection), req)

    class Https(urllib.request.HTTPSHandler):
        def https_open(self, req):
            return self.do_open(patient(http.client.HTTPSConnection), req, context=self._context)

    return urllib.request.build_opener(Http, Https).open(request, timeout=settings.timeout_connect)


def live_attempts(urls: DataFrame, settings: Requests, delay: float = DELAY) -> DataFrame:
    """Fetches (url) rows as they are on the web: every try as a row. A domain's urls are fetched one after another, in one task."""
    from gleanspark.functions.urls import netloc

    names = ["url", "attempt", "status", "content_type", "html"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]

    def run(batches):
        for batch in batches:
            for row in requested(batch.column("url").to_pylist(), settings, delay):
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    dealt = urls.select("url", netloc(F.col("url")).alias("_domain")).where("url is not null").repartition("_domain")
    return dealt.sortWithinPartitions("_domain", "url").select("url").mapInArrow(run, model.ATTEMPTS)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LivePages)
