"""Schemas of the relations, always given explicitly so that an all-null column keeps its type."""

SEEDS = "seed_pos long, base_url string, start_url string, start_domain string"
KEYWORDS = "kw_pos int, pattern string"
PAGES = "url string, status int, content_type string, html string"
ATTEMPTS = "url string, attempt int, status int, content_type string, html string"
ROBOTS = "domain string, status int, robots_txt string"
SITEMAP = "domain string, sm_pos long, url string"
LINKS = "page_url string, link_pos int, url string, domain string, hit string, unsupported boolean"
RESULTS = "seed_pos long, result_pos long, url string, source string, targeted boolean, first_keyword_hit string"
SCRAPED = "base_url string, url string, first_keyword_hit string, content string, batch int"
LOGS = "file string, line_no long, line string"

#: Every result of a crawl, whatever crawler made it, names this source.
RESULT_SOURCE = "NoCrawler"
