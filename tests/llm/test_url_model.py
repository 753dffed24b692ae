"""The URL model's odds against a plain computation, and pages and URLs of great length."""

import math
import re
import time
from collections import Counter

from lumenreef.llm import url_filter

SCHEMA = "page_id long, url string, html string"


def test_tags_are_stripped_as_by_a_plain_pattern():
    plain = re.compile(r"<(script|style)\b.*?</\1>|<[^>]*>", re.S | re.I)
    pages = [
        "", "no tags", "a<b>c</b>d", "<script>x</SCRIPT>y", "<SCRIPT src=1>x<b></script>y<style>z</style>w", "<scripty>kept</scripty>",
        "<script>never closed <b>bold</b>", "a < b and c", "a <", "<style>x</script>y</style>z", "<script><style>a</style>b</script>c", "x<!-- c -->y", "<<a>>",
    ]
    for page in pages:
        assert url_filter.visible(page).split() == plain.sub(" ", page).split(), page


def test_long_pages_take_linear_time():
    began = time.process_time()
    for part in ("<script ", "<style>", "<", "<a ", "< > "):
        url_filter.visible(part * (1_000_000 // len(part)))
    assert time.process_time() - began < 5


def test_long_urls_and_labels(spark):
    label = "spam" * 500
    rows = [(1, f"http://{label}.example.org/{'a/' * 20_000}", f"<p>{'word ' * 100_000}</p>"), (2, "http://www.example.org/", None), (None, None, None)]
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].host == f"{label}.example.org" and len(got[1].path) == 40_001
    assert (got[1].verdict, got[2].verdict, got[None].host) == ("block", "allow", "")


def plain_odds(urls, counts):
    """Log-odds of each distinct (host, tokens) by naive Bayes over all URLs."""
    counts = Counter(counts)
    counts.update({w: url_filter.SEED_COUNT for w in (*url_filter.SEEDS, *url_filter.NAME_WORDS)})
    total = sum(counts.values())
    bad, good, prior = Counter(), Counter(), Counter()
    bags = {}
    for url in urls:
        rest = url.partition("://")[2]
        host, _, path = rest.partition("/")
        words = [w for x in re.split(r"[^a-z0-9]+", host) if x for w in url_filter.segment(x, counts, total)]
        tokens = [re.sub("[0-9]+", "0", x) for x in re.split(r"[^a-z0-9]+", path.lower()) if x]
        unwanted = any(w in url_filter.SEEDS for w in words)
        bags[host, tuple(tokens)] = bag = [f"h:{w}" for w in words] + [f"p:{t}" for t in tokens]
        (bad if unwanted else good).update(t for t in bag if t.removeprefix("h:") not in url_filter.SEEDS)
        prior[unwanted] += 1
    bad.update({f"h:{s}": url_filter.SEED_WEIGHT for s in url_filter.SEEDS})
    names = {*bad, *good}
    a = url_filter.SMOOTHING

    def weight(t):
        return math.log((bad[t] + a) / (sum(bad.values()) + a * len(names))) - math.log((good[t] + a) / (sum(good.values()) + a * len(names)))

    return {k: math.log((prior[True] + 1) / (prior[False] + 1)) + sum(map(weight, bag)) for k, bag in bags.items()}


def test_odds_equal_a_plain_naive_bayes(spark):
    hosts = ["bestcasino.org", "freespam.net", "riverstone.com", "stone-river.com", "www.pokerriver.org", "cheapstone1.com", "river.org"]
    paths = ["win/now", "win/7", "about/us", "about/2024/x9", "", "stone"]
    urls = [f"http://{h}/{p}" for k, h in enumerate(hosts) for j, p in enumerate(paths) if (k * 5 + j) % 4] * 2
    counts = {"river": 40, "stone": 30, "about": 3, "us": 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path = url_filter.host_and_path(rows.url)
    shaped = rows.select(host.alias("host"), url_filter.path_tokens(path).alias("tokens"))
    got = {(r.host, tuple(r.tokens)): r.odds for r in url_filter.url_odds(shaped, words).collect()}
    want = plain_odds(urls, counts)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)
    assert want["river.org", ("win", "now")] > want["river.org", ("about", "0", "x0")]  # words that come with seed words count
