"""URL filter: explicit host/path rules, then a weighted Aho-Corasick vocabulary.

Every url gets a verdict. The rule whose host (or a parent domain of it) and path prefix fit,
the longest one first, decides. Otherwise the vocabulary does: each term counts where no letter
or digit touches it, a strict term rejects alone, and soft terms reject when the weights of at
least two distinct ones add up to the threshold.

Of rules that fit, the one of the longest host decides, and of those the one with the longest path; two rules with
the same host and path would be one. Terms are looked for in the url as it is written: percent-encoded letters hide them.

Edge cases: a null url, or one without `://`, has empty host and path, fits no rule, and its whole
string still meets the vocabulary (null: allow). Repeated rows get repeated results; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from gleanspark.llm.arrowmap import ascii_lower, map_texts

#: A strict term rejects alone.
STRICT_TERMS = (
    "porn porno pornhub xxx xvideos hentai camgirls escorts milf nsfw warez keygen cracked "
    "viagra cialis casino onlinecasino sportsbet phishing malware ransomware"
).split()
#: Soft terms reject only together; the weight tells how telling each is.
SOFT_TERMS = {
    **dict.fromkeys("sex sexy nude naked erotic adult fetish hookup dating gambling betting poker slots jackpot spam".split(), 1.5),
    **dict.fromkeys("pills pharmacy torrent crack serial hack cheap free bonus win loan payday replica farm".split(), 1.0),
    **dict.fromkeys("click ref track redirect popup download promo deal".split(), 0.5),
}
SOFT_THRESHOLD = 2.5
MIN_SOFT_HITS = 2


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as the filter sees them; both empty without `://`."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    whole = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, slash, path = whole.partition("/")
    return ascii_lower(host), slash + path


class UrlJudge:
    def __init__(self, rules: list[Rule] = (), strict=tuple(STRICT_TERMS), soft=None, threshold: float = SOFT_THRESHOLD):
        self.by_host: dict[str, list[Rule]] = {}
        for rule in rules:
            self.by_host.setdefault(rule.host, []).append(rule)
        self.threshold = threshold
        self.words = ahocorasick.Automaton()
        for term, weight in (SOFT_TERMS if soft is None else soft).items():
            self.words.add_word(term, (term, weight))
        for term in strict:
            self.words.add_word(term, (term, None))
        self.words.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        best, suffix = None, host
        while suffix:
            for rule in self.by_host.get(suffix, ()):
                if path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
                    best = rule
            suffix = suffix.partition(".")[2]
        return best

    def hits(self, url: str) -> tuple[set[str], dict[str, float]]:
        """Distinct strict terms, and soft terms with weights, that stand alone in the url."""
        low, strict, soft = ascii_lower(url), set(), {}
        edge = lambda i: not (0 <= i < len(low) and low[i].isascii() and low[i].isalnum())
        if len(self.words):
            for end, (term, weight) in self.words.iter(low):
                if edge(end + 1) and edge(end - len(term)):
                    if weight is None:
                        strict.add(term)
                    else:
                        soft[term] = weight
        return strict, soft

    def __call__(self, url: str | None) -> tuple:
        host, path = split_url(url)
        rule = self.rule(host, path)
        strict, soft = self.hits(url or "")
        weight = sum(soft.values())
        rejects = bool(strict) or (len(soft) >= MIN_SOFT_HITS and weight >= self.threshold)
        verdict = rule.verdict if rule else "block" if rejects else "allow"
        return host, path, rule and rule.text, verdict, len(strict), len(soft), weight


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", **vocabulary) -> DataFrame:
    """id, host, path, rule, verdict, n_strict, n_soft, soft_weight of each row; a map-only pass over two columns."""
    kind = dict(pages.dtypes)[id_col]

    def start():
        judge = UrlJudge(rules, **vocabulary)
        names = ("host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")

        def work(urls):
            made = list(zip(*map(judge, urls), strict=True)) or [()] * len(names)
            return dict(zip(names, made, strict=True))

        return work

    schema = f"`{id_col}` {kind}, host string, path string, rule string, verdict string, n_strict long, n_soft long, soft_weight double"
    return map_texts(pages, [id_col], url_col, schema, _typed(start))


def _typed(start):
    import pyarrow as pa

    kinds = dict(n_strict=pa.int64(), n_soft=pa.int64(), soft_weight=pa.float64())

    def typed():
        work = start()
        return lambda urls: {k: pa.array(v, kinds.get(k, pa.string())) for k, v in work(urls).items()}

    return typed


#: The rules that the registered query holds.
QUERY_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def oracle_sql() -> str:
    """The same judgement with one bounded regular expression for each term."""
    touch = lambda term: f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    ranked = sorted(QUERY_RULES, key=lambda r: -len(r.text))
    strict = " + ".join(f"{touch(t)}::BIGINT" for t in STRICT_TERMS)
    soft = " + ".join(f"{touch(t)}::BIGINT" for t in SOFT_TERMS)
    weight = " + ".join(f"CASE WHEN {touch(t)} THEN {w}::DOUBLE ELSE 0 END" for t, w in SOFT_TERMS.items())
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS low,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1), '{upper}', '{lower}') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*(/[^?#]*)', 1) AS path
  FROM pages),
judged AS (
  SELECT *, CASE {' '.join(f"WHEN {fits(r)} THEN '{r.text}'" for r in ranked)} END AS rule,
         {strict} AS n_strict, {soft} AS n_soft, {weight} AS soft_weight
  FROM parts)
SELECT page_id, host, path, rule,
       CASE {' '.join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in ranked)}
            WHEN n_strict > 0 OR (n_soft >= {MIN_SOFT_HITS} AND soft_weight >= {SOFT_THRESHOLD}) THEN 'block'
            ELSE 'allow' END AS verdict,
       n_strict, n_soft, soft_weight
FROM judged"""
