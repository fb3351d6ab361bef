"""Main-text extraction from HTML as a maximum-scoring subsequence.

A page is read as a row of words and tags. Words score by the elements they stand in: each element's tag,
each of its class, id and role names as a whole, and whether it is hidden are features with a weight, and
so is standing in a link; a name that no labelled page has weighs nothing. Of all open elements the
strongest weight above zero and the strongest below count. Tags score by their name, always below zero. The weights are learned by logistic regression, those of tags counted, on a bounded set
of labelled pages (those of `labelled_pages`, about 120, with and without an article element, unless others are given).
One linear scan finds the contiguous run with the greatest total, which is the content region.

Inside the region, words whose elements weigh below zero, with content before and after them, are called
out (an advert between two paragraphs) and left out of the text. In an element that weighs above the rest
of the page (an article), such an inset counts for its own two tags alone in the scan, however long it is,
so that it cannot part the text around it. Links never call words out. Of runs of equal total the first is
taken, and the shorter of those that begin together; no other ties arise.

Text comes as blocks in page order, joined by an empty line; within a block, character references are
decoded once and white space, line breaks included, becomes one space.

Edge cases: a null or empty page, or one without a region above zero, has no text; unclosed elements
end with their parent, an open paragraph at the next block; what looks like an unfinished tag or comment
at the end is dropped; repeated rows give repeated results; an empty table gives an empty result; extra
columns are ignored. The work is linear in the page's length.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleanspark.llm.arrowmap import map_texts

#: A quoted value has any length. The search for its end can fail but once for each kind of quote, so reading stays linear.
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?>=\s*\"[^\"]*+\"|=\s*'[^']*+'|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
_RAW = "script style noscript template svg math iframe object canvas textarea".split()
#: An end tag that is never closed ends the page, so the search is linear.
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in _RAW}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Tags that tell nothing about where words stand.
_NEUTRAL = set("html body div span p b i em strong br u small h1 h2 h3 h4 h5 h6 section table thead tbody tr td th".split())
_HINTS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:\s|^)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
class Place(NamedTuple):
    """Where words stand: the features of all open elements, and what they make of the words."""

    features: frozenset[str]
    #: Log-odds of a word here, and what the elements but links make of it.
    word: float
    element: float
    #: In an element that weighs above the page, or called out in such a one.
    main: bool
    inset: bool


class Weights:
    """Weights of features and tags, and the places that they have been asked for."""

    def __init__(self, bias: float, features: dict[str, float], tags: dict[str, float]):
        self.bias, self.features, self.tags = bias, features, tags
        self._places: dict[tuple[Place, str, str], Place] = {}

    @property
    def page(self) -> Place:
        return Place(frozenset(), self.bias, self.bias, False, False)

    def inside(self, outer: Place, name: str, attributes: str) -> Place:
        """The place of words in an element that opens at `outer`."""
        key = (outer, name, attributes)
        found = self._places.get(key)
        if found is None:
            if len(self._places) > PLACES:
                self._places.clear()
            found = self._places[key] = self._inside(outer, name, attributes)
        return found

    def _inside(self, outer: Place, name: str, attributes: str) -> Place:
        # The header of an article is its own.
        features = outer.features | (features_of(name, attributes) - (OWN_HEADER if outer.main else frozenset()))
        if features == outer.features:
            return outer
        # Of all open elements, the strongest for and the strongest against count, so that nesting does not add up.
        found = [self.features.get(f, 0.0) for f in features if f != LINK]
        element = self.bias + max(0.0, *found, 0.0) + min(0.0, *found, 0.0)
        word = element + (self.features.get(LINK, 0.0) if LINK in features else 0.0)
        inset = outer.inset or (outer.main and element < 0)
        return Place(features, word, element, not inset and element > self.bias, inset)


LINK, OWN_HEADER = "<a", frozenset({"<header"})
#: Places remembered at once by a task.
PLACES = 20_000


def features_of(name: str, attributes: str) -> frozenset[str]:
    """The features that an element gives its words."""
    made = set() if name in _NEUTRAL else {f"<{name}"}
    if attributes and name not in ("html", "body"):
        for found in _HINTS.findall(attributes):
            made.update(f".{hint.lower()}" for hint in "".join(found).split())
        if _HIDDEN.search(attributes):
            made.add("hidden")
    return frozenset(made)


def tokens(page: str, learned: Weights):
    """(place, text, None) for each run of text and (place, None, name) for each tag, in page order; raw elements are skipped."""
    stack: list[tuple[str, Place]] = []
    is_open: Counter = Counter()
    at, end = 0, len(page)
    outside = place = learned.page

    def pop_to(name):
        while stack:
            last = stack.pop()[0]
            is_open[last] -= 1
            if last == name:
                break

    while at < end:
        less = page.find("<", at)
        found = _TOKEN.match(page, less) if less >= 0 else None
        while less >= 0 and found is None:  # a plain "<"
            less = page.find("<", less + 1)
            found = _TOKEN.match(page, less) if less >= 0 else None
        stop = less if less >= 0 else end
        if stop > at:
            yield place, page[at:stop], None
        if found is None:
            return
        at, name = found.end(), found["name"]
        if not name:
            continue
        name = name.lower()
        if found["close"]:
            if is_open[name]:
                pop_to(name)
                inner, place = place, stack[-1][1] if stack else outside
            else:
                inner = place
            yield (inner if inner.inset and place.inset else place), None, name
            continue
        if name in _RAW_END:
            close = _RAW_END[name].search(page, at)
            at = close.end() if close else end
            continue
        if name in _BLOCK and is_open["p"]:
            pop_to("p")
            place = stack[-1][1] if stack else outside
        yield place, None, name
        if name not in _VOID:
            place = learned.inside(place, name, found["rest"])
            stack.append((name, place))
            is_open[name] += 1


#: No tag counts for less than minus this, so that one tag cannot outweigh a sentence.
LEAST_TAG = 1.0
#: Pages with the main text between the marks [[ and ]]; what stands between {{ and }} inside is not part of it.
LABELLED = [
    '<html><head><title>A title</title></head><body><header><h1>Site</h1><p>All about it</p></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">Blog posts</a></li></ul></nav>'
    "<article>[[<h1>How rivers move stones</h1><p>Water drags small stones along the bed and lifts the finest of them.</p><p>Larger ones roll, <b>slowly</b>, and only in floods.</p>"
    '<ul><li>Clay floats for days.</li><li>Sand settles within minutes.</li></ul>]]</article><aside><p>Read more: <a href="/x">Ten maps of rivers</a></p></aside><footer><p>&copy; Site. All rights reserved.</p></footer></body></html>',
    '<body><div id="menu"><a href="1">News</a> | <a href="2">Sport</a> | <a href="3">Weather</a></div><div id="content">[[<h2>Council agrees on bridge</h2><p>After a long debate the council agreed to repair the old bridge next spring.'
    "<p>The work will take <i>five</i> months.<br>Traffic goes through the valley.]]</div><div id=\"footer\">Contact | Imprint | <a href=p>Privacy</a></div></body>",
    '<body><table><tr><td><a href="/">Start</a><br><a href="/list">List</a></td><td>[[<p>The first printed books looked like written ones, because readers expected it.</p><p>Only later did printers choose plainer letters.</p>'
    '<blockquote>A page should not be noticed.</blockquote>]]</td></tr></table><p><a href="/">Top</a> <a href="/imprint">Imprint</a></p></body>',
    '<body><div class="cookie-notice">We use cookies to improve this site. <button>Accept</button></div><main>[[<h1>Bread without kneading</h1><p>Mix flour, water, salt and a little yeast.</p><p>Wait a day.</p><p>Bake it hot in a closed pot.</p>]]'
    '<section class="comments"><h3>Comments</h3><p>Great recipe, thanks for sharing it with all of us!</p><p>Mine was too wet, what did I do wrong?</p></section></main><form><input name="q"><label>Search the site</label></form></body>',
    '<body><div class="top"><a href="/">Shop</a> <a href="/cart">Cart</a></div><div class="post">[[<h1>Why clocks drift</h1><div>A quartz crystal swings a little faster when it is cold.</div><div>Over a month this adds up to seconds, as <a href="/q">tables of quartz</a> show.</div>]]</div>'
    '<div class="ad">Buy a better clock now and save a lot of money.</div><div class="related"><a href="/r">Sundials</a><a href="/s">Water clocks</a></div></body>',
    "<body><p><a href=/>Index</a></p>[[<p>Notes from the meeting in May.</p><p>All members were present and the minutes were read aloud.</p><pre>Votes: 7 for, 2 against</pre>]]<p><a href=prev>Previous</a> <a href=next>Next</a></p></body>",
]
#: Names of parts that stand beside the main text but, inside an article, may be its own; names and elements that are not part of
#: the text inside one either; names of parts with the main text.
_BESIDE = "breadcrumb breadcrumbs copyright header masthead pager pagination related related-posts search share social tags topbar widget".split()
_INSIDE = (
    "ad ads advert advertisement adsbygoogle banner comment-list commentlist comments consent cookie-banner cookie-notice cookies disqus_thread footer login menu modal nav navbar "
    "navigation newsletter notice popup promo sidebar signup sponsored subscribe"
).split()
_INSIDE_TAGS = "aside nav form footer button select label menu dialog fieldset".split()
_HEAD = "content main article post entry story entry-content post-content article-body".split()
_LEAD, _REST, _JUNK = "The river rose by a hand in the night and the mill stood still.", "By noon the water had gone and the wheel turned again.", "Follow us, sign in or read more of what others like today"


def labelled_pages() -> list[str]:
    """LABELLED, and a page for each name and element that is not content, in turn with an article, a named part and neither."""
    made = list(LABELLED)
    around = [("<article>", "</article>"), *((f'<div class="{h}">', "</div>") for h in _HEAD), ("<div>", "</div>"), ("", "")]
    for i, name in enumerate([*_BESIDE, *_INSIDE]):
        a, b = around[i % len(around)]
        made.append(f'<body><div class="{name}">{_JUNK}</div>{a}[[<h1>The mill</h1><p>{_LEAD}</p><p>{_REST}</p>]]{b}<div id="{name}"><p>{_JUNK}</p></div></body>')
    for name in _BESIDE:
        made.append(f'<body><article>[[<h1>The mill</h1><div class="{name}"><p>{_LEAD}</p></div><p>{_REST}</p>]]</article><div class="{name}"><p>{_JUNK}</p></div></body>')
    for i, (a, b) in enumerate([*((f'<div class="{n}">', "</div>") for n in _INSIDE), *((f"<{n}>", f"</{n}>") for n in _INSIDE_TAGS), ("<p hidden>", "</p>"), ('<p style="display:none">', "</p>")]):
        c, d = around[0] if i % 3 else around[1 + i % len(_HEAD)]
        made.append(f"<head><title>The mill</title></head><body><header><h2>{_JUNK}</h2></header>{c}[[<header><h1>The mill</h1></header><p>{_LEAD}</p>{{{{{a}{_JUNK}{b}}}}}<section><p>{_REST}</p></section>]]{d}{a}{_JUNK}{b}</body>")
    for tag in ("div", "p", "td", "blockquote", "pre"):
        for text in (_LEAD, _REST, f"{_REST} {_LEAD}"):
            made.append(f'<body><a href="/">Start</a>[[<{tag}>{text} See <a href="/x">the map</a>.</{tag}><{tag}>{_REST} {text}</{tag}>]]<a href="/n">Next</a></body>')
    return made


def _marked(page: str, learned: Weights):
    """(features, words or None, tag or None, whether it is content) of a labelled page."""
    inside = out = False
    for place, text, tag in tokens(page, learned):
        if text is None:
            yield place.features, None, tag, inside and not out
            continue
        for piece in re.split(r"(\[\[|\]\]|\{\{|\}\})", text):
            if piece in ("[[", "]]"):
                inside = piece == "[["
            elif piece in ("{{", "}}"):
                out = piece == "{{"
            elif words := len(piece.split()):
                yield place.features, words, None, inside and not out


@lru_cache(maxsize=4)
def weights(labelled: tuple[str, ...] | None = None) -> Weights:
    """Weights learned from labelled pages: of a word's features by logistic regression, of tags by counting."""
    blank = Weights(0.0, {}, {})
    rows = [row for page in labelled or labelled_pages() for row in _marked(page, blank)]
    texts = [(f, n, y) for f, n, tag, y in rows if tag is None]
    names = sorted({x for f, _, _ in texts for x in f})
    number = {x: i + 1 for i, x in enumerate(names)}
    x = np.zeros((len(texts), len(names) + 1))
    x[:, 0] = 1
    for i, (f, _, _) in enumerate(texts):
        x[i, [number[n] for n in f]] = 1
    n, y = np.array([n for _, n, _ in texts], float), np.array([y for _, _, y in texts], float)
    w, decay = np.zeros(x.shape[1]), np.concatenate([[0.1], np.full(len(names), DECAY)])
    for _ in range(30):  # Newton's steps on a convex loss
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + decay * w
        w -= np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(decay), slope)
    total, inside = Counter(t for _, _, t, _ in rows if t), Counter(t for _, _, t, y in rows if t and y)
    tags = {t: max(-LEAST_TAG, min(math.log((inside[t] + 0.5) / (total[t] - inside[t] + 0.5)), -0.1)) for t in total}
    return Weights(float(w[0]), dict(zip(names, w[1:].tolist(), strict=True)), tags)


#: Weight of the square of a feature's weight against words, in the regression.
DECAY = 1.0
UNKNOWN_TAG = -0.5


def score_of(token: tuple, learned: Weights) -> float:
    """What a word run or a tag adds to the run that holds it."""
    place, text, tag = token
    if text is None:
        return 0.0 if place.inset else learned.tags.get(tag, UNKNOWN_TAG)
    return 0.0 if place.inset else len(text.split()) * place.word


def best_run(scores: list[float]) -> tuple[int, int]:
    """The run [first, last) with the greatest total above zero; (0, 0) if there is none."""
    run, start = 0.0, 0
    best, first, last = 0.0, 0, 0
    for i, score in enumerate(scores):
        run += score
        if run > best:
            best, first, last = run, start, i + 1
        elif run <= 0:
            run, start = 0.0, i + 1
    return first, last


def main_text(page: str | None, learned: Weights | None = None) -> str:
    """The main text of a page; "" if it has none."""
    if not page:
        return ""
    learned = learned or weights()
    row = list(tokens(page, learned))
    first, last = best_run([score_of(t, learned) for t in row])
    return text_of(row[first:last])


def text_of(region: list[tuple]) -> str:
    """The blocks of a region, without what is called out between its first and its last content."""
    content = [i for i, (place, text, _) in enumerate(region) if text is not None and place.element >= 0 and not text.isspace()]
    first, last = (content[0], content[-1]) if content else (0, -1)
    blocks, block = [], []
    for i, (place, text, tag) in enumerate(region):
        if text is not None:
            if not (first < i < last and place.element < 0):
                block.append(text)
        elif tag in _BLOCK:
            blocks.append(block)
            block = []
        elif tag == "br":
            block.append(" ")
    made = (" ".join(references.unescape("".join(b)).split()) for b in [*blocks, block])
    return "\n\n".join(b for b in made if b)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", labelled: list[str] | None = None) -> DataFrame:
    """id, url, text and n_chars of each page; map-only."""
    kinds = dict(pages.dtypes)

    def start():
        learned = weights(tuple(labelled) if labelled else None)

        def work(texts):
            made = [main_text(t, learned) for t in texts]
            return {"text": pa.array(made, pa.string()), "n_chars": pa.array(map(len, made), pa.int64())}

        return work

    return map_texts(pages, [id_col, url_col], html_col, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long", start)


#: What the pages at hand hold between <article> and </article>, block by block.
ORACLE_SQL = r"""
WITH parts AS (
  SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)[^>]*>') AS b FROM pages),
clean AS (
  SELECT page_id, url, list_transform(b, lambda x: trim(regexp_replace(
    replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(x, '<br[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&amp;?', '&', 'g'), chr(160), ' '), '\s+', ' ', 'g'))) AS b FROM parts),
joined AS (SELECT page_id, url, coalesce(array_to_string(list_filter(b, lambda x: x <> ''), chr(10) || chr(10)), '') AS text FROM clean)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined"""
