import random
import re
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from gleanspark.functions import keywords, texts, urls
from gleanspark.functions.markup import parse_page, parse_pages


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")


def applied(spark, values, expression):
    rows = column(spark, values).select("i", expression(F.col("v")).alias("x")).collect()
    return [r.x for r in sorted(rows, key=lambda r: r.i)]


def test_scheme(spark):
    given = ["a.nl", "http://a.nl", "https://a.nl", "HTTP://a.nl", "", None]
    assert applied(spark, given, urls.with_scheme) == ["https://a.nl", "http://a.nl", "https://a.nl", "https://HTTP://a.nl", "https://", None]


def test_parts_equal_the_standard_library(spark):
    rng = random.Random(8)
    bits = ["http", "https", ":", "//", "/", "a", "B.c", "?", "#", ";p=1", "@", ":80", " ", "\t", "\n", "\x00", "é", "mailto:", "ftp://", "javascript:", "%20", "1x:", "+", ".", "-", "[::1]"]
    given = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(3000)]

    def parsed(u):
        try:
            p = urlparse(u)
            return p.netloc, p.path
        except ValueError:
            return None

    want = [parsed(u) for u in given]
    got = zip(applied(spark, given, urls.netloc), applied(spark, given, urls.path), strict=True)
    for u, w, g in zip(given, want, got, strict=True):
        if w is not None:
            assert g == w, repr(u)


@pytest.mark.parametrize(
    ("url", "rejected"),
    [
        ("https://x.nl/a.pdf", True), ("https://x.nl/a.pdf?v=2", True), ("https://x.nl/a.pdf/view", True), ("https://www.doctor.nl/", True), ("https://www.rabobank.nl/", True),
        ("https://x.nl/a.PDF", False), ("https://x.nl/a.ai", False), ("https://x.nl/a.ai?download=true", True), ("https://x.nl/a.mov?download=true", True), ("https://x.nl/", False),
    ],
)
def test_unsupported(spark, url, rejected):
    assert applied(spark, [url], urls.is_unsupported) == [rejected]


def test_shortest_list_rejects_the_same():
    every = [*urls.UNSUPPORTED, *(f"{x}?download=true" for x in urls.UNSUPPORTED), *urls.UNSUPPORTED_DOWNLOADS]
    few = urls.unsupported_literals()
    assert len(urls.UNSUPPORTED) == 52 and len(few) == 51
    assert all(any(x in y for x in few) for y in every)


def test_absolute(spark):
    pairs = [("https://s.nl/a/b", "c"), ("https://s.nl/a/", "../x//"), ("https://s.nl", "#top"), ("https://s.nl", "mailto:x@s.nl"), ("https://s.nl/a", "//p.nl/"), ("https://s.nl", "http://[bad"), ("https://s.nl", None)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, b string, r string").select("i", urls.absolute(F.col("b"), F.col("r")).alias("x")).collect()
    assert [r.x for r in sorted(rows)] == ["https://s.nl/a/c", "https://s.nl/x", "https://s.nl#top", "mailto:x@s.nl", "https://p.nl", None, None]


def test_hops(spark):
    cases = [("s", "s", "s", True), ("s", "s", "b", True), ("s", "b", "b", True), ("s", "b", "s", True), ("s", "b", "c", False)]
    rows = spark.createDataFrame(cases, "s string, p string, d string, want boolean")
    assert rows.where(urls.may_hop(F.col("s"), F.col("p"), F.col("d")) != F.col("want")).count() == 0


KEYWORD_CASES = [
    ("https://jobs.x.nl/vacature/1", "jobs"), ("https://x.nl/werken-vacature", "vacature"), ("https://x.nl/a?q=vacature", ""), ("https://x.nl/Vacature", ""), ("mailto:vacature@x.nl", "vacature"), ("https://x.nl", ""),
]


@pytest.mark.parametrize("more", [[], ["(?i)nothing(?=x)"]])
def test_first_hit(spark, more):
    words = ["vacature", "werken", "jobs", *more]
    assert keywords.reads_alike("vacature") and not keywords.reads_alike("(?i)nothing(?=x)")
    got = applied(spark, [u for u, _ in KEYWORD_CASES], lambda u: keywords.first_hit(urls.netloc(u), urls.path(u), words))
    assert got == [hit for _, hit in KEYWORD_CASES]


def test_empty_match_ends_the_search(spark):
    got = applied(spark, ["https://jobs.nl/jobs"], lambda u: keywords.first_hit(urls.netloc(u), urls.path(u), ["", "jobs"]))
    assert got == [""] and keywords.first_hit_of("jobs.nl", "/jobs", ["x*", "jobs"]) == ""


def test_hits_equal_python(spark):
    patterns = ["ab|b", "a{2}", "[a-c]+$", "(x|y)?b", "^/?a", r"\.nl", "b.c", "(?:ba)*c"]
    assert all(map(keywords.reads_alike, patterns))
    for odd in (r"\bx", "a++", "(?=x)", r"(a)\1", "[[a]", "x{,3}", "*", "(", "a**", "\\d\\", "[^]"):
        assert not keywords.reads_alike(odd), odd
    rng = random.Random(1)
    given = ["https://" + "".join(rng.choices("abcxy./", k=6)) + "/" + "".join(rng.choices("abcxy./", k=8)) for _ in range(400)]
    for pattern in patterns:
        got = applied(spark, given, lambda u, p=pattern: keywords.first_hit(urls.netloc(u), urls.path(u), [p]))
        assert got == [keywords.first_hit_of(urlparse(u).netloc, urlparse(u).path, [pattern]) for u in given], pattern


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<title>T</title><nav>n</nav><p> a <b>b</b> c</p>", "T\na\nb\nc"), ("a<script>x</script>b", "a\nb"), ("<header>h</header><aside>i</aside>", ""), ("<p>a &amp; b</p><!-- c -->", "a & b"),
        ("a<!-- x -->b", "a\nb"), ("<nav>never closed <p>x</p>", ""), ("<div><nav>x</div>y", "y"), ("<p>a&unknown;b &#8364; &#x41;</p>", "a&unknownb € A"), ("<br/>x<br>y", "x\ny"), ("<!DOCTYPE html>x", "x"),
        ("<style>p{}</style><template>t</template>z", "z"), ("</p>x</nav>", "x"), ("", ""),
    ],
)
def test_body_text(html, text):
    assert parse_page(html)[0] == text


@pytest.mark.parametrize(("html", "text"), [("<h1>a = &quot</h1><p>&quot;b&quot; &quot</p>", 'a = &quot\n"b" &quot'), ("<i>x</i>y &lt z &amp<b>&copy;</b>", "x\ny &lt z &\n©"), ("\n&copy\n", "&copy")])
def test_references_without_semicolon(html, text):
    assert parse_page(html)[0] == text


def test_links():
    page = '<a href="/a">x</a><a name="b">y</a><nav><a href="c">z</a></nav><A HREF=d>w</A><a href>v</a><a href="/e?x=1&amp;y=2">u</a>'
    assert parse_page(page)[1] == ["/a", "c", "d", "", "/e?x=1&y=2"]
    assert parse_page(None) == (None, [])


def test_parse_once(spark):
    """Native filters reach the scan and one Python node parses."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = parse_pages(pages.where("page_id > 3")).where("content <> ''")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "GreaterThan(page_id,3)" in plan


def test_valid_text(spark):
    given = [None, "", "\x00" + "a" * 9, "\x00" + "a" * 8, "\t\n\f\r", "\x0b", "\x7f" + "b" * 9, "ok"]
    assert applied(spark, given, texts.is_valid) == [False, False, True, False, True, False, True, True]
    rng = random.Random(4)
    some = ["".join(rng.choices("\x00\x07\x08\x0b\x0c\x1f\x7fabcdefghijklmnopqrstuvwxyzé🙂", k=rng.randint(1, 30))) for _ in range(500)]
    want = [len(re.findall(r"[\x00-\x08\x0B\x0E-\x1F\x7F]", s)) / len(s) <= 0.1 for s in some]
    assert applied(spark, some, texts.is_valid) == want


def test_references_equal_the_parser(spark):
    """Those joined in columns and those that are not."""
    rng = random.Random(8)
    parts = ["/", "a", "b.c", ".", "..", "?", "x=1", "#", "f", "//", "http://h.nl", "https://h.nl:8080", ";p", " ", "%20", "é", "[", "..a", "a.", ":", "mailto:"]
    bases = ["https://s.nl", "http://s.nl/a/b?x#y", "https://s.nl:81/", "HTTP://s.nl/q", "s.nl/x", "https://u@s.nl/z", "https://[::1]/a", None]
    pairs = [(rng.choice(bases), "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for _ in range(4000)] + [(b, r) for b in bases for r in ("/a/b.html", "https://x.nl/a?b=1#c", "/a/../b", "", None)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(pairs)], "i long, b string, r string")
    got = {r.i: r.u for r in df.select("i", urls.absolute(F.col("b"), F.col("r")).alias("u")).collect()}
    for i, (b, r) in enumerate(pairs):
        want = urls.join_one(b, r)
        assert got[i] == (None if want is None else want.rstrip("/")), (b, r)
