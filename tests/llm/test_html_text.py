import itertools
import random
import re
import time

from gleanspark.llm.html_text import best_run, extract_text, labelled_pages, main_text, score_of, text_of, tokens, weights


def test_labelled_pages():
    for page in labelled_pages():
        content = re.sub(r"\{\{.*\}\}", "", page[page.index("[[") + 2 : page.index("]]")])
        assert main_text(re.sub(r"\[\[|\]\]|\{\{|\}\}", "", page)) == main_text(f"<article>{content}</article>")


def test_scan_decides(spark):
    """Without the scan, every page of the table would have more text."""
    learned = weights()
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert text_of(list(tokens(row.html, learned))) != main_text(row.html)


def test_scan_without_an_article():
    """Link lists and short notes under names that no labelled page has."""
    text = "<p>The first of two paragraphs that a reader came for.</p><p>The second one ends the story well.</p>"
    want = "The first of two paragraphs that a reader came for.\n\nThe second one ends the story well."
    links = "<ul>" + "<li><a href=x>Go here</a></li>" * 12 + "</ul>"
    for inner, outer in (('<div class="q7">', "</div>"), ("<td>", "</td>"), ("", "")):
        assert main_text(f'<body><div class="zz1">{links}</div>{inner}{text}{outer}<div id="k9">{links}</div></body>') == want


def test_class_names_inside_an_article_drop_nothing():
    for name in ("legal", "related-work", "side-effects", "no-ads-here", "related", "widget", "search", "share tags", "comment-free"):
        page = f'<body><nav>Home</nav><article><p>Before it.</p><div class="{name}"><p>Inside of it.</p></div><p>After it.</p></article><footer>x</footer></body>'
        assert main_text(page) == "Before it.\n\nInside of it.\n\nAfter it.", name


def test_nesting_does_not_add_up():
    for a, b in (("<main><article><div class='entry-content'>", "</div></article></main>"), ("<div class=content><div class=post>", "</div></div>")):
        assert main_text(f"<body>{a}<p>One two three.</p><div class='ad'>Buy it now</div><p>Four five six.</p>{b}</body>") == "One two three.\n\nFour five six."


def test_blocks_and_references():
    page = "<article><h1>A&amp;B &copy; &#8364;</h1><p>one\n two<br>three&nbsp;<b>f</b>our<p>&amp;lt; x &am</article>"
    assert main_text("<article><p title='a > b' x=it's id=\"c > d\">isn't</p></article>") == "isn't"
    assert main_text(page) == "A&B © €\n\none two three four\n\n&lt; x &am"


def test_called_out_parts_go():
    body = "<p>The article has a number of words here.</p>"
    out = "The article has a number of words here.\n\nThe article has a number of words here."
    for junk in (
        '<div class="ad">Buy a lot of things now please</div>', "<script>var a = '<p>';</script>", "<style>p{}</style>", "<!-- <p>no</p> -->", "<form>Name <input></form>",
        '<div id="comments"><p>First! I am a reader with an opinion.</p></div>', "<nav>Home News</nav>", "<aside>Side words</aside>", '<p hidden>secret</p>', '<div class="cookie-notice">We use cookies a lot</div>',
    ):
        assert main_text(f"<html><body><nav>Menu words</nav><article>{body}{junk}{body}</article><footer>Foot words</footer></body></html>") == out, junk


def test_scan_finds_the_best_run():
    """Against all runs of a row."""
    rng, found, learned = random.Random(1), 0, weights()
    for _ in range(500):
        row = list(tokens("".join(rng.choice(["<p>", "</p>", "<a>x</a>", "<div>", "</div>", "word two", "<nav>", "</nav>", "<b>w</b>"]) for _ in range(14)), learned))
        score = [score_of(t, learned) for t in row]
        first, last = best_run(score)
        best = max((sum(score[a:b]) for a, b in itertools.combinations(range(len(row) + 1), 2)), default=0)
        assert abs(sum(score[first:last]) - max(0, best)) < 1e-9
        found += best > 0
    assert found > 300


def test_long_and_broken_pages_take_linear_time():
    began = time.time()
    for unit in ("<", "<p", '<a b="', "<!--", "</p>", "<b>", "<i x='", "&", "<script>", "<div class=ad>", "x<", "<!", "<script></script", "</script"):
        main_text(unit * 60_000)
    assert time.time() - began < 20


def test_pages_equal_their_articles(spark):
    import duckdb

    from gleanspark.llm.html_text import ORACLE_SQL

    path = "/root/testdata/sf0.001/pages.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}'")
    got = extract_text(spark.read.parquet(path)).collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(f"SELECT page_id, url, text, n_chars FROM ({ORACLE_SQL})").fetchall())


def test_awkward_rows(spark):
    rows = [(1, None, None, 1), (2, "u", "", 1), (2, "u", "", 1), (None, None, "<p>words of a page</p>", None), (3, "u", "plain words " * 20_000, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    got = {r.page_id: r for r in extract_text(df).collect()}
    assert got[1].text == got[2].text == "" and got[None].text == "words of a page" and got[3].n_chars == 240_000 - 1
    assert extract_text(df.limit(0)).count() == 0


def test_tags_never_help():
    learned = weights()
    assert all(w < 0 for w in learned.tags.values()) and learned.features["<article"] > 0 > learned.features["<a"] and learned.bias > 0


def test_long_insets_do_not_part_the_text():
    lead, rest = ("word " * 40).strip(), ("text " * 90).strip()
    for inset in ("Buy now " * 400, "<ul>" + "<li><a href=x>More of it</a></li>" * 300 + "</ul>", "<p hidden>x</p><article><p>Read this instead</p></article>" * 100):
        for junk in (f"<aside>{inset}</aside>", f'<div class="newsletter">{inset}</div>'):
            page = f"<html><body><nav>Menu words</nav><article><p>{lead}</p>{junk}<p>{rest}</p></article><aside>{inset}</aside></body></html>"
            assert main_text(page) == f"{lead}\n\n{rest}"


def test_quoted_values_of_any_length():
    for quote in "\"'":
        value = "x > <p>no</p> " * 100_000
        assert main_text(f"<article><p data-x={quote}{value}{quote}>yes</p></article>") == "yes"
    began = time.time()
    for unit in ("<a b=\"'", "<a b='>\"", "<p x= >", "=\"", "<a =' \">"):
        main_text(f"<b {unit * 60_000}")
        main_text(unit * 60_000 + "<i x=\"" + "<i y='" + "<i z=" * 60_000)
    assert time.time() - began < 20
