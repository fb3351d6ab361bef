import random

import pytest
from pyspark.sql import functions as F

from gleanspark.operators import crawl, fetch

GRAPH = {
    "https://s.nl": ["/a", "/job/1", "/b/", "#top", "/a", "mailto:x@s.nl", "https://p.nl/x", "/f.pdf"],
    "https://s.nl/a": ["/x", "/c"],
    "https://s.nl/job/1": ["/x", "https://q.nl/job/2"],
    "https://p.nl/x": ["https://r.nl/y", "https://s.nl/z"],
}
S = "https://s.nl"


def crawled(spark, graph, max_depth, max_visits, start=S, domain="s.nl", words=("job",)):
    pages = spark.createDataFrame([(u, "".join(f'<a href="{x}">l</a>' for x in links) or "<p>no links</p>") for u, links in graph.items()], "url string, html string")
    seeds = spark.createDataFrame([(0, start, domain)], "seed_pos long, start_url string, start_domain string")
    rows = crawl.crawl(seeds, fetch.page_links(pages, list(words)), pages, max_depth, max_visits).collect()
    kind = lambda k: [r for r in sorted(rows, key=lambda r: r.pos) if r.kind == k]
    return [r.url for r in kind("visit")], [r.url for r in kind("result")], {r.url: r for r in kind("seen")}


@pytest.mark.parametrize(
    ("depth", "budget", "visits", "results", "seen"),
    [
        (2, 0, [], [], 1),  # no budget, not even for the start
        (-1, 9, [S], ["/job/1"], 8),  # nothing may be queued
        (2, 1, [S], ["/job/1"], 8),
        (1, 3, [S, "/job/1", "https://q.nl/job/2"], ["/job/1", "https://q.nl/job/2"], 10),  # targeted ones first
        (0, 200, [S, "/job/1", "https://q.nl/job/2"], ["/job/1", "https://q.nl/job/2"], 10),
        (1, 200, [S, "/job/1", "https://q.nl/job/2", "/a", "/b", "#top", "mailto:x@s.nl", "https://p.nl/x", "/x"], ["/job/1", "https://q.nl/job/2"], 12),
        (2, 200, [S, "/job/1", "https://q.nl/job/2", "/a", "/b", "#top", "mailto:x@s.nl", "https://p.nl/x", "/x", "/c", "/z"], ["/job/1", "https://q.nl/job/2"], 12),
    ],
)
def test_small_web(spark, depth, budget, visits, results, seen):
    whole = lambda xs: [S + x if x[0] in "/#" else x for x in xs]
    got = crawled(spark, GRAPH, depth, budget)
    assert got[0] == whole(visits) and got[1] == whole(results)
    assert len(got[2]) - 1 == seen  # without the bare domain
    if seen == 12:
        assert got[2][S + "/x"].depth == 1 and got[2][S + "/x"].parent_url == S + "/job/1"
        assert got[2][S + "/f.pdf"].depth is None and got[2][S + "/f.pdf"].is_deadend
        assert "https://r.nl/y" not in got[2]


def test_first_finder_sets_the_depth(spark):
    """X is found first from A, too deep to be queued; that T, a target, leads to it later does not help."""
    graph = {S: ["/A"], S + "/A": ["/X", "/T"], S + "/T": ["/X"], S + "/X": []}
    visits, results, seen = crawled(spark, graph, 1, 200, words=("T$",))
    assert visits == [S, S + "/A", S + "/T"] and seen[S + "/X"].depth == 2 and results == [S + "/T"]


def test_start_with_a_slash_is_fetched_twice(spark):
    graph = {"https://s.nl/": ["https://s.nl/"], "https://s.nl": ["/a"]}
    visits, _, _ = crawled(spark, graph, 2, 200, start="https://s.nl/")
    assert visits == ["https://s.nl/", "https://s.nl", "https://s.nl/a"]


def plain(links, start, start_domain, max_depth, max_visits):
    """A crawl as a plain loop with a list that is sorted after each page."""
    seen = {start: (start_domain, 0), start_domain: (start_domain, 0)}
    queue, visited, results = [start], [], []
    while queue and len(visited) < max_visits:
        url = queue.pop(0)
        if url.rstrip("/") in visited:
            continue
        visited.append(url)
        for to, domain, hit, bad in links.get(url, []):
            if to in seen:
                continue
            if bad:
                seen[to] = (None, float("inf"))
                continue
            if domain != start_domain and domain != seen[url][0] and seen[url][0] != start_domain:
                continue
            depth = 0 if hit else seen[url][1] + 1
            seen[to] = (domain, depth)
            if hit:
                results.append(to)
            if depth <= max_depth:
                queue.append(to)
        queue.sort(key=lambda u: seen[u][1])
    return visited, results, set(seen)


def test_random_webs_equal_a_plain_loop(monkeypatch):
    rng = random.Random(6)
    for ahead in (1, 3, 32):
        monkeypatch.setattr(crawl, "AHEAD", ahead)
        for _ in range(200):
            n = rng.randint(2, 12)
            domain = [f"d{rng.randrange(3)}" for _ in range(n)]
            links = {str(i): [(str(j := rng.randrange(n)), domain[j], "t" if j % 4 == 1 else "", j % 7 == 6) for _ in range(rng.randint(0, 4))] for i in range(n) if rng.random() < 0.8}
            depth, budget = rng.randint(-1, 3), rng.randint(0, 14)
            known, rounds = {}, 0
            while True:
                walk = crawl.Walk("0", domain[0], depth, budget)
                asked = walk.run(known)
                if not asked:
                    break
                known |= {u: links.get(u) for u in asked}
                rounds += 1
                assert rounds < 40
            want = plain(links, "0", domain[0], depth, budget)
            assert ([v for v, _ in walk.visits], [u for u, _ in walk.results], set(walk.seen)) == want
            assert len(known) <= budget + ahead * rounds


def test_seeds_walk_alone(spark):
    pages = spark.createDataFrame([(S, '<a href="/job">x</a>')], "url string, html string")
    seeds = spark.createDataFrame([(0, S, "s.nl"), (1, S, "s.nl"), (2, "https://gone.nl", "gone.nl")], "seed_pos long, start_url string, start_domain string")
    trace = crawl.crawl(seeds, fetch.page_links(pages, ["job"]), pages)
    results = sorted(tuple(r) for r in crawl.results_of(trace).collect())
    assert results == [(p, 0, S + "/job", "NoCrawler", True, "job") for p in (0, 1)]
    assert sorted((r.seed_pos, r.url, r.fetched) for r in trace.where("kind = 'visit'").collect()) == [(0, S, True), (0, S + "/job", False), (1, S, True), (1, S + "/job", False), (2, "https://gone.nl", False)]


def test_sitemap(spark):
    seeds = spark.createDataFrame([(0, S, "s.nl")], "seed_pos long, start_url string, start_domain string")
    listed = ["https://s.nl/job/1/", "https://other.nl/job", "https://s.nl/job.pdf", "https://s.nl/none", S, "https://s.nl/job/1/", "https://s.nl/job/2"]
    sitemap = spark.createDataFrame([("s.nl", i, u) for i, u in enumerate(listed)], "domain string, sm_pos long, url string")
    seen = spark.createDataFrame([(0, "https://s.nl/job/2")], "seed_pos long, url string")
    got = crawl.sitemap_results(seeds, sitemap, ["job"], seen)
    assert sorted((r.sm_pos, r.url) for r in got.collect()) == [(0, "https://s.nl/job/1/"), (1, "https://other.nl/job")]


def test_robots(spark):
    rows = spark.createDataFrame([(d, f"https://{d}/{p}") for d in "abcdef" for p in ("x", "private/y")], "domain string, url string")
    txt = "User-agent: Glean\nDisallow: /private\n\nUser-agent: *\nDisallow: /"
    robots = spark.createDataFrame([("a", 200, txt), ("b", 404, None), ("c", 403, None), ("d", 500, None), ("e", None, None)], "domain string, status int, robots_txt string")
    got = {r.url: r.allowed for r in fetch.with_robots(rows, robots, "glean/1.0").collect()}
    assert [got[f"https://{d}/x"] for d in "abcdef"] == [True, True, False, False, False, True]
    assert [got[f"https://{d}/private/y"] for d in "abcdef"] == [False, True, False, False, False, True]
    other = {r.url: r.allowed for r in fetch.with_robots(rows, robots, "else").collect()}
    assert other["https://a/x"] is False


def test_answers_that_count(spark):
    rows = [("a", 200, "text/html", "x"), ("b", 404, "text/html", "x"), ("c", 200, "TEXT/HTML", "x"), ("d", 200, None, "x"), ("e", None, "text/html", "x"), ("f", 200, "text/html;charset=x", ""), ("g", 200, "text/html", None)]
    df = spark.createDataFrame(rows, "url string, status int, content_type string, html string")
    assert sorted(r.url for r in fetch.fetched(df).collect()) == ["a", "f"]
    tries = [("u", 0, None, None), ("u", 1, 200, "x"), ("u", 2, 200, "y"), ("v", 0, 500, None), ("v", 1, 200, "x"), ("w", 4, 200, "late"), ("w", 0, None, None)]
    df = spark.createDataFrame([(u, a, s, "text/html", h) for u, a, s, h in tries], "url string, attempt int, status int, content_type string, html string")
    assert sorted((r.url, r.attempt, r.html) for r in fetch.resolve_attempts(df, 3).collect()) == [("u", 1, "x"), ("v", 0, None), ("w", 0, None)]


def test_links_of_a_page(spark):
    pages = spark.createDataFrame([("https://s.nl/p/", '<a href="x.pdf">1</a><a href="http://[bad">2</a><a href="https://job.nl/">3</a>'), ("https://e.nl", "")], "url string, html string")
    got = [tuple(r) for r in fetch.page_links(pages, ["job"]).orderBy("link_pos").collect()]
    assert got == [("https://s.nl/p/", 0, "https://s.nl/p/x.pdf", "s.nl", "", True), ("https://s.nl/p/", 2, "https://job.nl", "job.nl", "job", False)]
    assert fetch.page_links(pages, ["job"]).where(F.col("page_url") == "https://e.nl").count() == 0


def test_pages_are_parsed_once(spark):
    """However many rounds a crawl takes."""
    parsed = spark.sparkContext.accumulator(0)
    graph = {S: [f"/p{i}" for i in range(5)]} | {f"{S}/p{i}": [f"/p{j}" for j in range(5 * i, 5 * i + 5) if j > i] for i in range(120)}
    pages = spark.createDataFrame([(u, "".join(f'<a href="{x}">l</a>' for x in links)) for u, links in graph.items()], "url string, html string")

    def count(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    counted = fetch.page_links(pages.mapInArrow(count, pages.schema), [])
    seeds = spark.createDataFrame([(i, S, "s.nl") for i in range(3)], "seed_pos long, start_url string, start_domain string")
    trace = crawl.crawl(seeds, counted, pages, 50, 200)
    assert trace.where("kind = 'visit'").count() > 300 and trace.where("kind = 'seen'").count() > 300
    assert parsed.value == len(graph)


def test_robots_equal_the_parser(spark):
    """Plain rules and urls in columns, others in Python, against the standard parser."""
    rng = random.Random(3)
    paths = ["/", "/a", "/a/b", "/a%20b", "/a?x=1", "/%7Eu", "/é", "", "/a*", "/b$", "/a;p", "/a/./b", "//a"]
    agents = ["*", "Glean", "other"]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(1, 3)):
            lines.append(f"User-agent: {rng.choice(agents)}")
            lines += [f"{rng.choice(['Allow', 'Disallow'])}: {rng.choice(paths)}" for _ in range(rng.randint(0, 3))] + [""]
        texts.append("\n".join(lines))
    robots = [(f"h{i}", rng.choice([200, 200, 200, 204, 301, 401, 404, 500, None]), x) for i, x in enumerate(texts)]
    urls_ = [(f"h{i}", f"{scheme}://h{i}{p}{q}") for i in range(62) for scheme in ("http", "https") for p in [*paths, "/a/b/c", "/b", "/a b"] for q in ("", "?x=1&y=2", "#f")]
    rows = spark.createDataFrame(urls_, "domain string, url string")
    got = {r.url: r.allowed for r in fetch.with_robots(rows, spark.createDataFrame(robots, "domain string, status int, robots_txt string"), "glean/1.0").collect()}
    rules = {d: fetch._rules(s, x) for d, s, x in robots}
    assert got == {u: rules[d].can_fetch("glean/1.0", u) if d in rules else True for d, u in urls_}


def test_robots_keep_pages_out(spark):
    from gleanspark.plans import scrape
    from gleanspark.sources import snapshots

    html = {S: '<a href="/job/1">1</a><a href="/private/job">2</a>', f"{S}/job/1": "<p>open</p>", f"{S}/private/job": '<p>closed</p><nav><a href="/job/2">3</a></nav>', f"{S}/job/2": "<p>behind it</p>"}
    pages = snapshots.pages_of(spark.createDataFrame(list(html.items()), "url string, html string"))
    seeds = spark.createDataFrame([(0, S, S, "s.nl")], "seed_pos long, base_url string, start_url string, start_domain string")
    robots = spark.createDataFrame([("s.nl", None, None), ("s.nl", 200, "User-agent: *\nDisallow: /private")], "domain string, status int, robots_txt string")
    pipeline = scrape.Pipeline(scrape.Crawl(["job"]))
    assert sorted(r.content for r in pipeline.run(seeds, pages).collect()) == ["behind it", "closed", "open"]
    assert [r.content for r in pipeline.run(seeds, pages, None, robots).collect()] == ["open"]
    assert pipeline.run(seeds, pages, None, robots.limit(0)).count() == 3
