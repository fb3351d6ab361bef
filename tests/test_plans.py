import http.server
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gleanspark import config, model
from gleanspark.operators import fetch, logs, rows
from gleanspark.plans import report, scrape
from gleanspark.sources import files, snapshots
from gleanspark.streaming import pages as streaming


def test_lines(spark, tmp_path):
    (tmp_path / "seeds.txt").write_bytes("a.nl \r\n\nhttp://b.nl\t\n  c.nl\n".encode())
    lines = files.read_lines(spark, str(tmp_path / "seeds.txt"))
    assert lines.count() == 4
    seeds = files.seeds_of(lines, 1, 2).orderBy("seed_pos").collect()
    assert [tuple(s) for s in seeds] == [(0, "", "https://", ""), (1, "http://b.nl", "http://b.nl", "b.nl")]
    (tmp_path / "keywords.txt").write_text("job\n\nwork", encoding="utf-8")
    assert files.read_keywords(spark, str(tmp_path / "keywords.txt")) == ["job", "", "work"]


def test_config():
    made = config.parse_config("aws:\n  access_key: x\ninput:\n  input_dir: in\n  input_files:\n    urls: u.txt\n  url_max: 7\ncrawl:\n  max_depth: 0\noutput:\n")
    assert (made.input.urls, made.input.keywords, made.input.url_max, made.crawl.max_depth, made.crawl.max_visits, made.output.batchsize) == ("u.txt", "keywords.txt", 7, 0, 200, 100)
    assert config.parse_config("") == config.Config()
    assert config.run_directory("out", 5, datetime(2026, 1, 2, 3, 4, 5)) == "out/20260102_030405_offset5"


def test_dedup_keeps_the_first_within_a_seed(spark):
    given = [(0, 2, "u2", "same"), (0, 1, "u1", "same"), (1, 5, "u5", "same"), (0, 3, "u3", "other")]
    df = spark.createDataFrame(given, "s long, p long, u string, c string")
    assert sorted(r.u for r in rows.first_of_each(df, "s", "p", "c", ["u"]).collect()) == ["u1", "u3", "u5"]


def test_batches_run_across_seeds(spark, monkeypatch):
    monkeypatch.setattr(rows, "RUN", 3)
    df = spark.createDataFrame([(s, p) for s, n in ((0, 3), (2, 11), (7, 1)) for p in range(0, 5 * n, 5)], "s long, p long")
    got = sorted((r.s, r.p, r.batch) for r in rows.with_batch(df, "s", "p", 4).collect())
    assert [b for *_, b in got] == [i // 4 for i in range(15)]
    assert rows.with_batch(df.limit(0), "s", "p", 4).count() == 0


LOG = """INFO 2026-01-01 00:00:00,000 MainProcess Trying to crawl base url: a.nl
INFO 2026-01-01 00:00:01,000 MainProcess Crawl did 3 visits out of maximum 200.
INFO 2026-01-01 00:00:02,000 MainProcess Trying to crawl base url: b.nl
INFO 2026-01-01 00:00:03,000 MainProcess Trying to crawl base url: a.nl
INFO 2026-01-01 00:00:04,000 MainProcess Crawl did 1 visits out of maximum 50.
INFO 2026-01-01 00:00:05,000 MainProcess Crawl did 1 visits out of maximum 7.
"""


def test_logs(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.log").write_text(LOG)
    (tmp_path / "ignored.txt").write_text(LOG)
    (tmp_path / "z.log").write_text("x Trying to crawl base url: c.nl\n\nx 1 visits out of maximum many.\n")
    read = files.read_logs(spark, str(tmp_path))
    assert sorted(r.line_no for r in read.where("file LIKE '%a.log'").collect()) == list(range(6))
    by = logs.visits_by_url(logs.sessions(read))
    assert sorted((r.base_url, r.tried, r.visits_max_logged) for r in by.collect()) == [("", False, 7), ("a.nl", True, 50), ("b.nl", True, 0), ("c.nl", True, 0)]
    seeds = spark.createDataFrame([(i, u, u, u) for i, u in enumerate(["a.nl", "b.nl", "c.nl"])], model.SEEDS)
    assert [tuple(r) for r in report.orphan_visits(by, seeds).collect()] == [("", 7)]
    scraped = spark.createDataFrame([(b, f"u{i}", None, "t", 0) for i, b in enumerate(["x", "y", "z", "z", "z"])], model.SCRAPED)
    assert sorted(tuple(r) for r in report.pages_histogram(scraped).collect()) == [(1, 2), (3, 1)]
    assert report.run_summary(scraped, by, seeds).first().asDict() == dict(urls_given=3, urls_tried=3, without_visits=2, with_visits=1, sites_scraped=3, pages_scraped=5, sites_with_one_page=2, most_pages=3)
    empty = report.run_summary(scraped.limit(0), by.limit(0), seeds.limit(0)).first()
    assert list(empty) == [0] * 8


def test_sessions_run_across_files(spark):
    given = [("a", 0, logs.TRYING + "x.nl"), ("b", 0, "nothing"), ("c", 0, "did 2" + logs.VISITS + "9."), ("c", 1, "did 2" + logs.VISITS + "8.")]
    got = logs.sessions(spark.createDataFrame(given, model.LOGS))
    assert [(r.base_url, r.visits) for r in got.orderBy("file", "line_no").collect()] == [("x.nl", None), ("x.nl", 9), ("", 8)]


PAGES = {
    "https://s.nl": '<a href="/job/1">1</a><a href="/job/2">2</a><a href="/job/3">3</a>',
    "https://s.nl/job/1": "<p>first</p>",
    "https://s.nl/job/2": "<p>first</p>",
    "https://s.nl/job/3": "<nav>only</nav>",
    "https://s.nl/job/4": "<p>from the sitemap</p>",
}


def test_pipeline_end_to_end(spark, tmp_path):
    for name, lines in (("urls.txt", "s.nl\nhttps://s.nl\n"), ("keywords.txt", "job\n")):
        (tmp_path / name).write_text(lines)
    settings = config.parse_config(f"input:\n  input_dir: {tmp_path}\noutput:\n  output_dir: {tmp_path}/out\n  batchsize: 3\n")
    pipeline, seeds, folder = scrape.build_pipeline(spark, settings)
    pages = snapshots.pages_of(spark.createDataFrame(list(PAGES.items()), "url string, html string"))
    sitemap = spark.createDataFrame([("s.nl", 0, "https://s.nl/job/4"), ("s.nl", 1, "https://s.nl/job/1")], model.SITEMAP)
    scraped = pipeline.run(seeds, pages, sitemap)
    want = [(b, u, "job", c, i // 3) for i, (b, u, c) in enumerate((b, f"https://s.nl/job/{n}", c) for b in ("s.nl", "https://s.nl") for n, c in ((1, "first"), (4, "from the sitemap")))]
    assert sorted(tuple(r) for r in scraped.collect()) == sorted(want)
    pipeline.write(scraped, folder)
    assert sorted(p.name for p in __import__("pathlib").Path(folder).iterdir() if p.is_dir()) == ["batch=0", "batch=1"]
    back = files.read_results(spark, f"{tmp_path}/out")
    assert sorted(tuple(r) for r in back.collect()) == sorted(w[:4] for w in want)
    assert report.pages_per_site(back).count() == 2


def test_stand_ins(spark):
    seeds = spark.createDataFrame([(0, "s.nl", "https://s.nl", "s.nl")], model.SEEDS)
    pages = snapshots.constant_pages(seeds.select(F.col("start_url").alias("url")))
    assert scrape.Pipeline(scrape.StartPages()).run(seeds, pages).first().content == "Hello"
    assert scrape.Pipeline(scrape.StartPages(), scrape.NoText()).run(seeds, pages).count() == 0
    assert scrape.Pipeline(scrape.Crawl([], max_visits=0, use_sitemap=False)).run(seeds, pages).count() == 0


def test_invalid_results_are_left_out(spark, tmp_path):
    df = spark.createDataFrame([("b", "u", None, "ok", 0), ("b", "v", None, "\x00\x01", 0), ("b", "w", None, None, 1)], model.SCRAPED)
    files.write_results(df, str(tmp_path / "r"))
    assert files.read_results(spark, str(tmp_path)).count() == 1 and files.read_results(spark, str(tmp_path), valid_only=False).count() == 3


def test_arriving_pages(spark, tmp_path):
    for i in range(2):
        rows_ = spark.createDataFrame([(f"https://s.nl/{i}", 200, "text/html", f"<p>t{i}</p>"), ("x", 404, "text/html", "no")], model.PAGES)
        rows_.write.mode("append").parquet(str(tmp_path / "in"))
        streaming.store(streaming.arriving_contents(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == i + 1


def test_live_pages(spark):
    class Site(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200 if self.path != "/gone" else 404)
            self.send_header("Content-Type", "text/html" if self.path != "/image" else "image/png")
            self.end_headers()
            self.wfile.write(b"<p>hi</p>")

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    snapshots.register(spark)
    rows_ = spark.read.format("live_pages").option("urls", "\n".join(f"{base}/{p}" for p in ("a", "gone", "image"))).option("delay", "0").option("max_retries", "0").load().collect()
    server.shutdown()
    assert sorted((r.url.rsplit("/", 1)[1], r.status, r.html) for r in rows_) == [("a", 200, "<p>hi</p>"), ("gone", 404, None), ("image", 200, None)]


def test_live_crawl(spark):
    """A crawl that fetches as it goes: every page once, robots files kept, rounds end when the time is over."""
    html = {"/": '<a href="/job/1">1</a><a href="/a">a</a><a href="/private/job">p</a>', "/job/1": "<p>one</p><nav><a href='/job/2'>2</a></nav>", "/job/2": "<p>two</p>", "/a": "<p>a</p>", "/job/3": "<p>three</p>", "/private/job": "<p>closed</p>"}
    asked = []

    class Site(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            self.send_response(200 if self.path in html else 404)
            self.send_header("Content-Type", "text/html")
            self.end_headers()
            self.wfile.write(html.get(self.path, "").encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    host = f"127.0.0.1:{server.server_port}"
    seeds = spark.createDataFrame([(i, host, f"http://{host}/", host) for i in range(2)], model.SEEDS)
    robots = spark.createDataFrame([(host, 200, "User-agent: *\nDisallow: /private")], model.ROBOTS)
    sitemap = spark.createDataFrame([(host, 0, f"http://{host}/job/3"), (host, 1, f"http://{host}/job/1")], model.SITEMAP)
    settings = config.parse_config("requests:\n  max_retries: 0\n  timeout_connect: 2\n")
    pipeline = scrape.Pipeline(scrape.Crawl(["job"]), useragent="glean/1")
    got = scrape.run_live(pipeline, seeds, settings, sitemap, robots, delay=0).collect()
    assert sorted(r.content for r in got) == ["one", "one", "three", "three", "two", "two"]
    assert len(asked) == len(set(asked)) and "/private/job" not in asked
    cache = fetch.FetchCache(lambda wanted: snapshots.live_attempts(wanted, settings.requests, 0).where("status = 200").select("url", "html"))
    wanted = spark.createDataFrame([(f"http://{host}/a",), (f"http://{host}/gone",), (f"http://{host}/a",)], "url string")
    before = len(asked)
    assert [r.html for _ in range(2) for r in cache.ask(wanted).collect()] == ["<p>a</p>"] * 2 and len(asked) == before + 2
    cache.reset()
    assert cache.ask(wanted).count() == 1 and len(asked) == before + 4
    none = config.parse_config("requests:\n  max_retries: 0\ncrawl:\n  max_duration: -1\n")
    assert [r.content for r in scrape.run_live(pipeline, seeds.limit(1), none, None, robots, delay=0).collect()] == []
    server.shutdown()


def test_sitemap_files(spark):
    robots = spark.createDataFrame([("s.nl", 200, "User-agent: *\nSitemap: https://s.nl/i.xml\n sitemap:https://s.nl/b.xml\nSitemap: https://s.nl/none.xml"), ("x.nl", 404, "Sitemap: https://x.nl/a.xml")], model.ROBOTS)
    page = lambda *urls: "<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'>" + "".join(f"<url><loc> {u} </loc></url>" for u in urls) + "</urlset>"
    given = [
        ("https://s.nl/i.xml", "<sitemapindex><sitemap><loc>https://s.nl/c.xml</loc></sitemap><sitemap><loc>https://s.nl/bad.xml</loc></sitemap></sitemapindex>"),
        ("https://s.nl/b.xml", page("https://s.nl/3")), ("https://s.nl/c.xml", page("https://s.nl/1", "https://s.nl/2/")), ("https://s.nl/bad.xml", "<urlset><url>"), ("https://x.nl/a.xml", page("https://x.nl/1")),
    ]
    files_ = spark.createDataFrame(given, "file_url string, xml string")
    got = snapshots.sitemap_from_files(robots, files_).orderBy("sm_pos").collect()
    assert [tuple(r) for r in got] == [("s.nl", 0, "https://s.nl/1"), ("s.nl", 1, "https://s.nl/2/"), ("s.nl", 2, "https://s.nl/3")]
    index = lambda *urls: "<sitemapindex>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in urls) + "</sitemapindex>"
    deep = [(f"f{i}", index(f"f{i + 1}", "f0")) for i in range(9)] + [("f9", page("https://d.nl/x"))]
    named = spark.createDataFrame([("d.nl", 200, "Sitemap: f0")], model.ROBOTS)
    assert [tuple(r) for r in snapshots.sitemap_from_files(named, spark.createDataFrame(deep, "file_url string, xml string")).collect()] == [("d.nl", 0, "https://d.nl/x")]


def test_robots_files_that_answered_count(spark):
    given = [("a", None, None), ("a", 200, "x"), ("a", 404, None), ("b", None, None), ("b", 404, None), ("c", None, None)]
    got = snapshots.robots_by_domain(spark.createDataFrame(given, model.ROBOTS)).collect()
    assert sorted(tuple(r) for r in got) == [("a", 200, "x"), ("b", 404, None), ("c", None, None)]


def test_a_cluster_names_its_folder(spark, monkeypatch):
    from gleanspark import checkpoints

    class Context:
        master, set = "spark://host:7077", None
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isEmpty": lambda self: self is not None})()})()})()

        def setCheckpointDir(self, path):
            self.set = path

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda self, name, default: None})()

    with pytest.raises(ValueError):
        checkpoints.with_checkpoints(Session())
    Session.sparkContext.master = "local[2]"
    checkpoints.with_checkpoints(Session())
    assert Session.sparkContext.set


def test_command(spark, tmp_path):
    from gleanspark.__main__ import main

    for name, text in (("urls.txt", "s.nl\n"), ("keywords.txt", "job\n"), ("c.yaml", f"input:\n  input_dir: {tmp_path}\noutput:\n  output_dir: {tmp_path}/out\n")):
        (tmp_path / name).write_text(text)
    spark.createDataFrame(list(PAGES.items()), "url string, html string").write.parquet(str(tmp_path / "pages"))
    folder = main([str(tmp_path / "c.yaml"), str(tmp_path / "pages")])
    assert spark.read.parquet(folder).count() == 1
    tried = logs.visits_by_url(logs.sessions(files.read_logs(spark, str(tmp_path / "out")))).collect()
    assert [(r.base_url, r.tried, r.visits_max_logged) for r in tried] == [("s.nl", True, 200)]
    assert "Crawl did 4 visits out of maximum 200." in "".join(p.read_text() for p in (tmp_path / "out").rglob("*.log"))


@pytest.mark.parametrize("path", ["sf0.001"])
def test_queries_equal_their_sql(spark, path):
    import duckdb

    from gleanspark import queries

    folder, con = f"/root/testdata/{path}", duckdb.connect()
    for table in ("pages", "documents", "nation"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    sql = queries.oracle_sql()
    for name, query in queries.queries().items():
        got = query(spark, folder)
        cols = ", ".join(f'"{c}"' for c in got.columns)
        want = con.execute(f"SELECT {cols} FROM ({sql[name]})").fetchall()
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr), name


#: Queries that have to tell pages of the same url apart, or must not count them twice.
REPEATED = ["fetch_retry_resolve", "link_depth", "queue_admission", "queue_order", "sitemap_extension", "scrape_content", "scrape_end_to_end", "pages_histogram", "pages_per_base_url", "run_summary"]


@pytest.mark.parametrize("name", REPEATED)
def test_urls_recorded_twice(spark, tmp_path, name):
    """A fifth of the pages have the url of another page, with other html."""
    import duckdb

    from gleanspark import queries

    con = duckdb.connect()
    con.execute(
        f"""COPY (SELECT p.page_id, coalesce(q.url, p.url) AS url, p.html FROM '/root/testdata/sf0.001/pages.parquet' p
        LEFT JOIN '/root/testdata/sf0.001/pages.parquet' q ON p.page_id % 5 = 4 AND q.page_id = p.page_id - 1) TO '{tmp_path}/pages.parquet'"""
    )
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    assert con.execute("SELECT count(*) > count(DISTINCT url) FROM pages").fetchall() == [(True,)]
    got = queries.queries()[name](spark, str(tmp_path))
    cols = ", ".join(f'"{c}"' for c in got.columns)
    want = con.execute(f"SELECT {cols} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
