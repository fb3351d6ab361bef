"""The focused crawl: an ordered best-first traversal for each seed, on recorded pages.

Which urls a crawl visits depends on the order in which it finds them, so the walk of one seed is a loop.
The loop runs in rounds over all seeds at once. In a round, each seed's walk is replayed on the pages
fetched for it so far; when it needs a page that is not there yet, it asks for the AHEAD best of its
queue, and all that is asked is joined to the links by url before the next round. A seed thus holds the
links of the pages its visits need, never a whole site, and a round settles one visit at least, AHEAD at best.

Pages are parsed once: their links are written out first, one row a page and dealt by url, so that rounds join
them as they lie. Each round writes only the pages that are new to a seed, and the trace is written once for all its readers.
"""

from __future__ import annotations

import heapq
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark import model
from gleanspark.checkpoints import with_checkpoints
from gleanspark.functions import urls
from gleanspark.operators.fetch import FetchCache, page_links, with_target

AHEAD = 32
TRACE = "seed_pos long, kind string, pos long, url string, domain string, parent_url string, depth int, is_deadend boolean, hit string, fetched boolean"


LINKS = "array<struct<link_pos: int, url: string, domain: string, hit: string, unsupported: boolean>>"


class Walk:
    """One seed's traversal over `links` {page url: [(url, domain, hit, unsupported)]}; a page known to be missing has None."""

    def __init__(self, start_url: str, start_domain: str, max_depth: int, max_visits: int):
        self.start_domain, self.max_depth, self.max_visits = start_domain, max_depth, max_visits
        # url: (domain, parent, depth, dead end); the depth of an unsupported url is None.
        self.seen = {start_url: (start_domain, None, 0, False), start_domain: (start_domain, None, 0, False)}
        self.queue = [(0, 0, start_url)]
        self.visits: list[tuple[str, bool]] = []
        self.results: list[tuple[str, str]] = []
        self._visited: set[str] = set()
        self._pushed = 1

    def run(self, links: dict) -> list[str]:
        """Walks as far as the links reach; returns the urls that come next, none if it is done."""
        while self.queue and len(self._visited) < self.max_visits:
            url = self.queue[0][2]
            # A visited url is known by its own spelling, a new one is looked up without its slashes.
            if url.rstrip("/") in self._visited:
                heapq.heappop(self.queue)
                continue
            if url not in links:
                return [u for _, _, u in heapq.nsmallest(AHEAD, self.queue) if u not in links]
            heapq.heappop(self.queue)
            self._visited.add(url)
            self.visits.append((url, links[url] is not None))
            for link in links[url] or ():
                self._meet(url, *link)
        return []

    def _meet(self, parent: str, url: str, domain: str | None, hit: str, unsupported: bool) -> None:
        if url in self.seen:
            return
        if unsupported:
            self.seen[url] = (None, parent, None, True)
            return
        from_domain, _, from_depth, _ = self.seen[parent]
        if self.start_domain not in (domain, from_domain) and domain != from_domain:
            return  # a second hop, which another parent may still make
        depth = 0 if hit else from_depth + 1
        self.seen[url] = (domain, parent, depth, False)
        if hit:
            self.results.append((url, hit))
        if depth <= self.max_depth:
            heapq.heappush(self.queue, (depth, self._pushed, url))
            self._pushed += 1


def _replayed(seed, fetched: pd.DataFrame, max_depth: int, max_visits: int) -> tuple[Walk, list[str]]:
    links = {url: None if there is None else [(x["url"], x["domain"], x["hit"], x["unsupported"]) for x in there] for url, there in zip(fetched["page_url"], fetched["links"], strict=True)}
    walk = Walk(seed.start_url, seed.start_domain, max_depth, max_visits)
    return walk, walk.run(links)


def _asked(max_depth, max_visits):
    def ask(seeds: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        rows = [(s.seed_pos, u) for s in seeds.itertuples(index=False) for u in _replayed(s, fetched, max_depth, max_visits)[1]]
        return pd.DataFrame(rows, columns=["seed_pos", "page_url"])

    return ask


def _traced(max_depth, max_visits):
    def rows_of(seed, walk: Walk) -> Iterator[tuple]:
        for i, (url, fetched) in enumerate(walk.visits):
            yield seed.seed_pos, "visit", i, url, None, None, None, None, None, fetched
        for i, (url, (domain, parent, depth, deadend)) in enumerate(walk.seen.items()):
            yield seed.seed_pos, "seen", i, url, domain, parent, depth, deadend, None, None
        for i, (url, hit) in enumerate(walk.results):
            yield seed.seed_pos, "result", i, url, None, None, None, None, hit, None

    def trace(seeds: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        rows = [r for s in seeds.itertuples(index=False) for r in rows_of(s, _replayed(s, fetched, max_depth, max_visits)[0])]
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in TRACE.split(", ")], dtype=object)
        return frame.astype({"depth": "Int32", "is_deadend": "boolean", "fetched": "boolean"})

    return trace


def links_by_page(links: DataFrame, pages: DataFrame) -> DataFrame:
    """(page_url, links) of every page that can be fetched, its links in order; written out, dealt by url."""
    with_checkpoints(pages.sparkSession)
    found = F.sort_array(F.collect_list(F.struct("link_pos", "url", "domain", "hit", "unsupported")))
    grouped = links.groupBy("page_url").agg(found.alias("links"))
    there = pages.select(F.col("url").alias("page_url")).distinct()
    none = F.array().cast(grouped.schema["links"].dataType)
    return there.join(grouped, "page_url", "left").select("page_url", F.coalesce("links", none).alias("links")).repartition("page_url").checkpoint()


def crawl(seeds: DataFrame, links: DataFrame, pages: DataFrame, max_depth: int = 2, max_visits: int = 200) -> DataFrame:
    """Trace rows of every seed's crawl: its visits, the urls it has seen and its results, each numbered in order; written out.

    `links` are those of `page_links`, `pages` (url) the urls that can be fetched at all. Seeds walk alone:
    a seed listed twice walks twice.
    """
    known = links_by_page(links, pages)
    return _walked(seeds, known.limit(0), lambda asked: asked.join(known, "page_url", "left").select("seed_pos", "page_url", "links"), max_depth, max_visits)


def crawl_live(seeds: DataFrame, keywords: Sequence[str], cache: FetchCache, max_depth: int = 2, max_visits: int = 200, max_duration: float | None = None) -> DataFrame:
    """The trace as `crawl` gives it, of pages that the cache fetches as they are asked for, each once for all seeds.

    After `max_duration` seconds no further round is begun, and walks end with what they have.
    """
    with_checkpoints(seeds.sparkSession)

    def answer(asked: DataFrame) -> DataFrame:
        known = cache.ask(asked.select(F.col("page_url").alias("url")))
        return asked.join(links_by_page(page_links(known, keywords), known), "page_url", "left").select("seed_pos", "page_url", "links")

    nothing = seeds.sparkSession.createDataFrame([], f"page_url string, links {LINKS}")
    return _walked(seeds, nothing, answer, max_depth, max_visits, None if max_duration is None else time.monotonic() + max_duration)


def _walked(seeds: DataFrame, nothing: DataFrame, answer: Callable[[DataFrame], DataFrame], max_depth: int, max_visits: int, deadline: float | None = None) -> DataFrame:
    """Rounds until no walk asks for more; `answer` gives (seed_pos, page_url, links) of what is asked, null links for pages that cannot be had."""
    seeds = seeds.select("seed_pos", "start_url", "start_domain").checkpoint()
    fetched = nothing.select(F.lit(0).cast("long").alias("seed_pos"), "page_url", "links")
    ask, trace = _asked(max_depth, max_visits), _traced(max_depth, max_visits)
    while True:
        grouped = seeds.groupBy("seed_pos").cogroup(fetched.groupBy("seed_pos"))
        asked = grouped.applyInPandas(ask, "seed_pos long, page_url string").checkpoint()
        if asked.isEmpty() or (deadline is not None and time.monotonic() > deadline):
            return grouped.applyInPandas(trace, TRACE).checkpoint()
        fetched = fetched.unionAll(answer(asked).checkpoint())


def results_of(trace: DataFrame) -> DataFrame:
    """The crawl's results as records."""
    rows = trace.where("kind = 'result'")
    return rows.select("seed_pos", F.col("pos").alias("result_pos"), "url", F.lit(model.RESULT_SOURCE).alias("source"), F.lit(True).alias("targeted"), F.col("hit").alias("first_keyword_hit"))


def without_crawl(seeds: DataFrame) -> DataFrame:
    """The start url alone as the result of each seed."""
    return seeds.select(
        "seed_pos", F.lit(0).cast("long").alias("result_pos"), F.col("start_url").alias("url"), F.lit(model.RESULT_SOURCE).alias("source"),
        F.lit(None).cast("boolean").alias("targeted"), F.lit(None).cast("string").alias("first_keyword_hit"),
    )


def sitemap_results(seeds: DataFrame, sitemap: DataFrame, keywords: list[str], seen: DataFrame | None = None, record: Sequence[str] = ()) -> DataFrame:
    """What a seed's sitemap adds: (seed_pos, sm_pos, url, hit) of its targeted urls that the crawl has not seen.

    Sitemap urls hang on the domain itself, are spelled as they are, may be on any domain and are never
    queued; of a url listed twice the first place counts. Where the sitemap has columns `record` that tell pages of
    one url apart, each of them counts by itself, and the columns are kept.
    """
    listed = seeds.select("seed_pos", "start_url", F.col("start_domain").alias("domain")).join(sitemap, "domain")
    listed = listed.where(~urls.is_unsupported(F.col("url")) & (F.col("url") != F.col("start_url")) & (F.col("url") != F.col("domain")))
    listed = with_target(listed.select("seed_pos", "sm_pos", "url", *record), keywords).where("hit <> ''")
    listed = listed.groupBy("seed_pos", "url", "hit", *record).agg(F.min("sm_pos").alias("sm_pos"))
    return listed if seen is None else listed.join(seen.select("seed_pos", "url"), ["seed_pos", "url"], "left_anti")
