"""URL filters: longest-match rules, then word segmentation and naive Bayes.

Where no rule fits, a URL is judged by its words. Host labels are split into words
by unigram Viterbi, with word counts over the visible text of all pages. A
multinomial naive Bayes model over host words and path tokens is trained on weak
labels: a URL with a seed word among its host words counts as unwanted. Its seed words are left out when it is
learnt from, so what the model learns is what else such URLs hold, and a seed word weighs no more than its prior
count. Everything that grows with the corpus (word counts, hosts, tokens) is joined, never collected or broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenreef.llm._arrow import slices, texts_of
from lumenreef.llm._scratch import materialise

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words looked up in a label have at most this many characters.
LONGEST_WORD = 20
#: Characters of a label whose substrings are cut together, from longer windows to shorter ones.
WINDOWS = (4000, 60)
SMOOTHING = 0.5
#: Occurrences that each seed word counts for in the word counts and in the unwanted class.
SEED_COUNT, SEED_WEIGHT = 1000, 2

# Seed words of unwanted hosts.
SEEDS = (
    "ads", "adult", "bet", "bets", "betting", "casino", "cheap", "clickbait", "doorway", "gambling",
    "lottery", "malware", "phishing", "pills", "poker", "porn", "slots", "spam", "track", "tracker",
    "viagra", "warez", "xxx",
)
# Other words of names, so that names of several words can be split.
NAME_WORDS = ("best", "blog", "buy", "deal", "deals", "farm", "free", "online", "play", "sale", "shop", "site", "store", "top", "web", "win")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(host, _AZ, _az), path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


_HIDDEN = re.compile(r"<(script|style)\b", re.I)
_CLOSE = {kind: re.compile(f"</{kind}>", re.I) for kind in ("script", "style")}
_WORDS = re.compile(r"(?<![^\W\d_])[^\W\d_]{2,20}(?![^\W\d_])")  # whole words only


def visible(html: str) -> str:
    """``html`` with a space for each tag, and for scripts and styles with what they hold.

    One walk from left to right; a closing tag that is not there is looked for once.
    """
    kept, at, missing = [], 0, set()
    while (tag := html.find("<", at)) >= 0:
        kept.append(html[at:tag])
        found = _HIDDEN.match(html, tag)
        kind = found.group(1).lower() if found else None
        if kind and kind not in missing:
            if close := _CLOSE[kind].search(html, tag):
                at = close.end()
                continue
            missing.add(kind)
        end = html.find(">", tag)
        if end < 0:  # no more tags: this one and the rest are text
            at = tag
            break
        at = end + 1
    return " ".join([*kept, html[at:]])


def page_words(pages: DataFrame, flush: int = 200_000) -> DataFrame:
    """``word, n``: counts of the words (2 to 20 letters) in the visible text of all pages.

    A null page has no words. A task holds at most ``flush`` counts and one page's words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, 64):
            for html in texts_of(batch, "html"):
                seen.update(_WORDS.findall(visible(html).lower()))
            if len(seen) > flush:
                yield out()
                seen.clear()
        if seen:
            yield out()

    return pages.select("html").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def segment(label: str, counts: Mapping[str, int], total: int) -> list[str]:
    """The most probable split of ``label`` into words under a unigram model.

    Words without a count have probability 10 / (total * 10 ** length). Of equally
    probable splits the one with the longest last word wins.
    """
    known = {word: math.log(n / total) for word, n in counts.items() if n}
    unknown = [math.log(10 / total) - size * math.log(10) for size in range(LONGEST_WORD + 1)]
    best, starts = [0.0], [0]  # log-probability of the best split up to each place, start of its last word
    for end in range(1, len(label) + 1):
        top, at = -math.inf, 0
        for start in range(max(0, end - LONGEST_WORD), end):
            p = best[start] + known.get(label[start:end], unknown[end - start])
            if p > top:
                top, at = p, start
        best.append(top)
        starts.append(at)
    words, end = [], len(label)
    while end:
        words.append(label[starts[end] : end])
        end = starts[end]
    return words[::-1]


def segmented_labels(labels: DataFrame, words: DataFrame) -> DataFrame:
    """``label, words`` for distinct ``label``s, with ``words(word, n)`` as the unigram counts.

    Every substring of a label of up to ``LONGEST_WORD`` characters is joined with the counts, so no dictionary is sent
    round. Substrings are cut from windows of a label and go by its number, not with its text, so the work and what
    is gathered for a label grow with its length.
    """
    spark = labels.sparkSession
    known = spark.createDataFrame([(w, SEED_COUNT) for w in (*SEEDS, *NAME_WORDS)], "word string, n long")
    words = words.unionByName(known).groupBy("word").agg(F.sum("n").alias("n"))
    total = max(2, words.agg(F.sum("n")).first()[0] or 0)
    labels = materialise(labels.select("label", F.monotonically_increasing_id().alias("id")), "label-ids")
    windows = labels.select("id", F.col("label").alias("w"))
    for width in WINDOWS:  # finding a place in a text takes time in proportion to it, so long windows are cut again
        offsets = F.sequence(F.lit(1), F.greatest(F.length("w"), F.lit(1)), F.lit(width))
        windows = windows.select("id", "w", F.explode(offsets).alias("i")).select("id", F.substr("w", F.col("i"), F.lit(width + LONGEST_WORD - 1)).alias("w"))
    starts = windows.where("w <> ''").select("id", "w", F.explode(F.sequence(F.lit(1), F.least(F.length("w"), F.lit(WINDOWS[-1])))).alias("i"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("w") - F.col("i") + 1))
    parts = starts.select("id", "w", "i", F.explode(sizes).alias("k")).select("id", F.substr("w", F.col("i"), F.col("k")).alias("word")).distinct()
    found = parts.join(words, "word").groupBy("id").agg(F.collect_list(F.struct("word", "n")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, out = batch.column("label").to_pylist(), []
            for label, found in zip(names, batch.column("found").to_pylist()):
                counts = {x["word"]: x["n"] for x in found or []}
                out.append(segment(label, counts, total))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(out, pa.list_(pa.string()))], names=["label", "words"])

    return labels.join(found, "id", "left").select("label", "found").mapInArrow(run, "label string, words array<string>")


def _host_words(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """``host, host_words`` for distinct hosts."""
    split = hosts.select("host", F.explode(F.filter(F.split("host", r"[^\p{L}\p{N}]+"), lambda x: x != "")).alias("label"))
    labels = materialise(segmented_labels(materialise(split.select("label").distinct(), "labels"), words), "segments")
    joined = split.join(labels, "label").groupBy("host").agg(F.array_sort(F.flatten(F.collect_list("words"))).alias("host_words"))
    return joined


def path_tokens(path: Column) -> Column:
    """Lower-case runs of letters and digits of a path, numbers as ``0``."""
    tokens = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    return F.transform(tokens, lambda x: F.regexp_replace(x, "[0-9]+", "0"))


def shape_of(host: Column, tokens: Column) -> Column:
    """A short name for a host and its path tokens (neither holds a slash), so that long paths are not copied with each token."""
    return F.sha2(F.concat_ws("/", host, tokens), 256)


def url_odds(urls: DataFrame, words: DataFrame) -> DataFrame:
    """``shape, host, tokens, odds`` for each distinct host and token list of ``urls(host, tokens)``.

    ``odds`` is the naive Bayes log-odds of the unwanted class.
    """
    shape = shape_of(F.col("host"), F.col("tokens")).alias("shape")
    shapes = urls.groupBy(shape).agg(F.first("host").alias("host"), F.first("tokens").alias("tokens"), F.count("*").alias("count"))
    hosts = materialise(shapes.select("host").distinct(), "hosts")
    shapes = shapes.join(_host_words(hosts, words), "host", "left").withColumn("host_words", F.coalesce("host_words", F.array().cast("array<string>")))
    seeds = F.array(*map(F.lit, SEEDS))
    seeded = F.arrays_overlap("host_words", seeds)
    shapes = shapes.withColumns({"bad": F.when(seeded, F.col("count")).otherwise(0), "good": F.when(seeded, 0).otherwise(F.col("count"))})
    marked = lambda name, mark: F.transform(name, lambda x: F.concat(F.lit(mark), x))
    shapes = materialise(shapes.withColumn("all", F.concat(marked("host_words", "h:"), marked("tokens", "p:"))), "shapes")
    learnt = shapes.select(F.explode("all").alias("token"), "bad", "good").where(~F.col("token").isin([f"h:{s}" for s in SEEDS]))
    counted = learnt.groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    prior = urls.sparkSession.createDataFrame([(f"h:{s}", SEED_WEIGHT, 0) for s in SEEDS], "token string, bad long, good long")
    counted = materialise(counted.unionByName(prior).groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "tokens")
    n = counted.agg(F.count("*"), F.sum("bad"), F.sum("good")).first()
    of = shapes.agg(F.sum("bad"), F.sum("count")).first()
    bad_urls, all_urls = of[0] or 0, of[1] or 0
    base = math.log((bad_urls + 1) / (all_urls - bad_urls + 1))
    size = math.log(((n[2] or 0) + SMOOTHING * n[0]) / ((n[1] or 0) + SMOOTHING * n[0]))
    weights = counted.select("token", (F.log(F.col("bad") + SMOOTHING) - F.log(F.col("good") + SMOOTHING) + size).alias("w"))
    summed = shapes.select("shape", F.explode("all").alias("token")).join(weights, "token").groupBy("shape").agg(F.sum("w").alias("w"))
    return shapes.select("shape", "host", "tokens").join(summed, "shape", "left").select("shape", "host", "tokens", (F.coalesce("w", F.lit(0.0)) + base).alias("odds"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict, odds.

    The verdict is the longest fitting rule's, else ``block`` where the model's
    log-odds are above 0. A null URL, or one without ``://``, has empty host and path
    and the model's prior. Null page ids and repeated rows stay as they are; other columns
    take no part. An empty table gives no rows. Pages, labels and URLs of any length are
    taken whole: the work grows with their length, for a label times ``LONGEST_WORD``, which also bounds the words
    that are counted and found.
    """
    words = materialise(page_words(pages), "words")
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    urls = materialise(urls.select("*", rule.alias("rule"), verdict.alias("ruled"), path_tokens(F.col("path")).alias("tokens")), "urls")
    odds = materialise(url_odds(urls, words).select("shape", "odds"), "odds")
    judged = urls.withColumn("shape", shape_of(F.col("host"), F.col("tokens"))).join(odds, "shape")
    own = F.when(F.col("odds") > 0, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "odds")


def url_report(pages: DataFrame) -> DataFrame:
    """``judge_urls`` of all pages."""
    return judge_urls(pages)
