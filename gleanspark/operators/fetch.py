"""Fetching against recorded pages: which answers count, retries, robots rules, links."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote
from urllib.robotparser import RobotFileParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions import urls
from gleanspark.functions.keywords import first_hit
from gleanspark.functions.markup import parse_pages


def is_page(status: Column, content_type: Column) -> Column:
    """Whether an answer is a page: status 200 and a content type that names text/html, in this case."""
    return F.coalesce(status == 200, F.lit(False)) & F.coalesce(content_type, F.lit("")).contains("text/html")


def fetched(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(url, html) of the answers that are pages, and their columns `keep`."""
    return pages.where(is_page(F.col("status"), F.col("content_type")) & F.col("html").isNotNull()).select("url", "html", *keep)


def resolve_attempts(attempts: DataFrame, max_retries: int = 3, key: Sequence[str] = ("url",)) -> DataFrame:
    """The answer of each url: its first attempt that got any status, within the retries; else none.

    `key` tells apart what was asked for by itself, should one url be asked for several times.
    """
    within = attempts.where(F.col("attempt") <= max_retries)
    answered = F.struct(F.col("status").isNull().alias("failed"), "attempt", "status", "content_type", "html")
    best = within.groupBy(*key).agg(F.min(answered).alias("a"))
    page = is_page(F.col("a.status"), F.col("a.content_type"))
    return best.select(*key, F.col("a.attempt").alias("attempt"), F.col("a.status").alias("status"), F.when(page, F.col("a.html")).alias("html"))


#: Rules of one host for one agent: (whether it allows, beginning of the path), in order; the last one has every path.
RULES = "array<struct<allows: boolean, path: string>>"
#: Urls whose path and query robots rules compare as they are written.
_PLAIN_URL = r"^https?://[A-Za-z0-9.\-:]*(?:/(?!/)[A-Za-z0-9_.~/\-]*)?(?:\?[A-Za-z0-9_.~/\-=&]+)?$"
_PLAIN_PATH = re.compile(r"(?:/|%3F|%3D|%26|[A-Za-z0-9_.~\-])*")


def _rules(status: int | None, text: str | None) -> RobotFileParser:
    parser = RobotFileParser()
    if status is not None and 200 <= status < 300:
        parser.parse((text or "").splitlines())
        parser.modified()
    elif status in (401, 403):
        parser.disallow_all = True
    elif status is not None and 400 <= status < 500:
        parser.allow_all = True
    else:  # unreachable
        parser.disallow_all = True
    return parser


def _plain_rules(parser: RobotFileParser, useragent: str) -> list[tuple[bool, str]] | None:
    """The agent's rules as beginnings of raw paths, the last for all the rest; None if they need decoding."""
    if parser.allow_all or parser.disallow_all:
        return [(parser.allow_all, "")]
    entry = next((e for e in parser.entries if e.applies_to(useragent)), parser.default_entry)
    made = []
    for rule in entry.rulelines if entry else ():
        if not _PLAIN_PATH.fullmatch(rule.path):
            return None
        if not rule.path:  # has every path, and always allows
            break
        made.append((rule.allowance, unquote(rule.path)))
    return [*made, (True, "")]


def robots_rules(robots: DataFrame, useragent: str) -> DataFrame:
    """(domain, rules, status, robots_txt): each file parsed once; text is kept only for those whose rules need decoding."""

    def run(batches):
        for batch in batches:
            rows = zip(batch.column("status").to_pylist(), batch.column("robots_txt").to_pylist(), strict=True)
            rules = [_plain_rules(_rules(s, t), useragent) for s, t in rows]
            text = [t if r is None else None for r, t in zip(rules, batch.column("robots_txt").to_pylist(), strict=True)]
            made = pa.array([None if r is None else [{"allows": a, "path": p} for a, p in r] for r in rules], pa.list_(pa.struct([("allows", pa.bool_()), ("path", pa.string())])))
            yield pa.RecordBatch.from_arrays([batch.column("domain"), made, batch.column("status"), pa.array(text, pa.string())], names=["domain", "rules", "status", "robots_txt"])

    return robots.select("domain", F.col("status").cast("int").alias("status"), "robots_txt").mapInArrow(run, f"domain string, rules {RULES}, status int, robots_txt string")


def allowed(useragent: str):
    """A column function (url, status, robots_txt) that tells whether the robots rules let the agent fetch the url; null for a null url."""

    @F.pandas_udf("boolean")
    def check(url: pd.Series, status: pd.Series, text: pd.Series) -> pd.Series:
        known: dict = {}
        made = []
        for u, s, t in zip(url, status, text, strict=True):
            if u is None:
                made.append(None)
                continue
            key = (None if pd.isna(s) else int(s), t if isinstance(t, str) else None)
            if key not in known:
                known[key] = _rules(*key)
            made.append(known[key].can_fetch(useragent, u))
        return pd.Series(made, dtype=object)

    return check


def with_robots(rows: DataFrame, robots: DataFrame, useragent: str, url: str = "url", domain: str = "domain") -> DataFrame:
    """Adds `allowed`; a domain without a recorded robots file allows everything.

    Rules are prefixes, compared in columns; only urls or rules with characters that need decoding go through Python, with
    the text of their host's file.
    """
    rules = robots_rules(robots, useragent).select(F.col("domain").alias(domain), F.struct("rules", "status", "robots_txt").alias("_robots"))
    joined = rows.join(rules, domain, "left")
    known, rules = F.col("_robots").isNotNull(), F.col("_robots.rules")
    plain = rules.isNotNull() & (F.col(url).rlike(_PLAIN_URL) | (F.size(rules) == 1))
    path = F.regexp_replace(url, r"^[^:]*://[^/?#]*", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    first = F.get(F.filter(rules, lambda r: F.startswith(path, r["path"])), 0)["allows"]
    asked = known & ~F.coalesce(plain, F.lit(False))
    status, text = F.when(rules.isNull(), F.col("_robots.status")).otherwise(F.lit(200)), F.when(rules.isNull(), F.col("_robots.robots_txt")).otherwise(_text_of(rules))
    by_text = allowed(useragent)(*(F.when(asked, x) for x in (F.col(url), status, text)))
    return joined.withColumn("allowed", F.when(~known, F.lit(True)).when(asked, by_text).otherwise(first)).drop("_robots")


def _text_of(rules: Column) -> Column:
    """A robots file that says the same as plain rules; the last one goes without saying."""
    lines = F.transform(F.filter(rules, lambda r: r["path"] != ""), lambda r: F.concat(F.when(r["allows"], F.lit("Allow: ")).otherwise(F.lit("Disallow: ")), r["path"]))
    return F.concat(F.lit("User-agent: *\n"), F.array_join(lines, "\n"))


def without_disallowed(pages: DataFrame, robots: DataFrame, useragent: str) -> DataFrame:
    """The page rows that robots rules let the agent fetch; urls that cannot be parsed have no host, so nothing forbids them."""
    domain = fresh_name("domain", pages.columns)
    return with_robots(pages.withColumn(domain, urls.netloc(F.col("url"))), robots, useragent, domain=domain).where("allowed").select(*pages.columns)


def fresh_name(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name


def page_links(pages: DataFrame, keywords: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Every link of every page (url, html) with all that does not depend on the order of a crawl.

    (page_url, link_pos, url, domain, hit, unsupported), and the page's columns `keep`; references that cannot be parsed are left out.
    """
    parsed = parse_pages(pages.where(F.col("html") != "").select("url", *keep, "html"), keep=["url", *keep])
    links = parsed.select(F.col("url").alias("page_url"), *keep, F.posexplode("hrefs").alias("link_pos", "href"))
    links = links.select("page_url", *keep, "link_pos", urls.absolute(F.col("page_url"), F.col("href")).alias("url")).where("url IS NOT NULL")
    return with_target(links, keywords).select("page_url", *keep, "link_pos", "url", "domain", "hit", urls.is_unsupported(F.col("url")).alias("unsupported"))


def with_target(rows: DataFrame, keywords: Sequence[str], url: str = "url") -> DataFrame:
    """Adds domain and hit (empty for a miss)."""
    rows = rows.withColumn("domain", urls.netloc(F.col(url)))
    return rows.withColumn("hit", first_hit(F.col("domain"), urls.path(F.col(url)), keywords))


class FetchCache:
    """Pages that have been fetched, and urls in vain: written out, and asked before anything is fetched again."""

    def __init__(self, fetch_pages: Callable[[DataFrame], DataFrame]):
        """`fetch_pages` takes (url) rows and gives (url, html) of those that are pages."""
        self.fetch_pages = fetch_pages
        self.tables: list[DataFrame] = []

    def ask(self, wanted: DataFrame) -> DataFrame:
        """(url, html) of the wanted urls (url) that are pages; only what is new is fetched."""
        wanted = wanted.select("url").distinct()
        new = wanted
        for table in self.tables:
            new = new.join(table.select("url"), "url", "left_anti")
        self.tables.append(new.join(self.fetch_pages(new).dropDuplicates(["url"]), "url", "left").select("url", "html").checkpoint())
        return self.pages().join(wanted, "url", "left_semi")

    def pages(self) -> DataFrame:
        """All pages that have been fetched since the start or the last reset; none before the first."""
        return reduce(DataFrame.unionAll, self.tables).where("html is not null")

    def reset(self) -> None:
        """Forgets what has been fetched."""
        self.tables = []
