from gleanspark.llm.url_filter import QUERY_RULES, Rule, UrlJudge, judge_urls, split_url


def test_split():
    assert split_url("HTTPS://A.Example.ORG/En/1?x#y") == ("a.example.org", "/En/1")
    assert split_url("http://x.org") == ("x.org", "")
    assert split_url("http://x.org?q=/a") == ("x.org", "")
    assert split_url("no-scheme/path") == split_url(None) == ("", "")


def test_longest_rule_wins():
    judge = UrlJudge(QUERY_RULES)
    verdict = lambda url: judge(url)[2:4]
    assert verdict("https://a.example.org/en/12") == ("example.org/en/1", "block")
    assert verdict("https://a.example.org/en/2") == ("org/", "allow")
    assert verdict("https://notexample.org/en/12") == ("org/", "allow")
    assert verdict("https://x.com/de/porn") == ("com/de/", "block")
    assert verdict("https://x.com/fr/porn") == ("com/fr/", "allow")
    assert verdict("https://x.org") == (None, "allow")  # its path is empty


def test_vocabulary_needs_boundaries_and_several_soft_hits():
    judge = UrlJudge([Rule("allow", "safe.net", "/")])
    blocked = lambda url: judge(url)[3] == "block"
    assert blocked("https://porn.net/") and not blocked("https://sporn.net/a") and not blocked("https://safe.net/porn")
    assert not blocked("https://x.net/sex") and not blocked("https://x.net/sex/sex") and blocked("https://x.net/sex-dating")
    assert not blocked("https://essex.net/adulthood")
    assert not blocked("https://x.net/cheap-download") and blocked("https://x.net/cheap-download-casino")


def test_awkward_rows(spark):
    rows = [(1, None, "p"), (2, "", "q"), (2, "", "q"), (None, "https://x.com/de/" + "a" * 100_000, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = sorted(judge_urls(df, QUERY_RULES).collect(), key=repr)
    assert [(r.page_id, r.host, r.verdict) for r in got] == [(1, "", "allow"), (2, "", "allow"), (2, "", "allow"), (None, "x.com", "block")]
    assert judge_urls(df.limit(0), QUERY_RULES).count() == 0
