"""Versioned catalogs, KPIs from partial results, contacts from markup, frequent sets."""

import random
from html.parser import HTMLParser
from itertools import combinations
from urllib.parse import unquote

import pytest
from lumenreef.operators import contacts, frequent_sets, kpi, markup, rollup
from lumenreef.session import shared_path
from lumenreef.sources import versions
from lumenreef.streaming import kpi as streams
from pyspark.sql import functions as F

CATALOG = "run_id long, event_id long, fuente string, organizador string, email string"


def random_catalog(spark, rows=400, seed=1):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([None, *values])
    return spark.createDataFrame([(rng.choice([1, 2, 3, None]), k, pick("a", "b", "c"), pick("o", "p"), pick("e")) for k in range(rows)], CATALOG)


def test_a_version_is_committed_or_not_seen(spark, tmp_path):
    root = f"file://{tmp_path}/catalog"
    assert versions.current_version(spark, root) == 0
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    rows = random_catalog(spark)
    assert versions.commit(rows, root, 0) == 1
    # A write that fails half way, after some of its files are there: the current version stays as it is.
    broken = versions.read(spark, root).repartition(6).withColumn("email", F.when(F.col("event_id") == 250, F.raise_error(F.lit("halfway"))).otherwise(F.col("email")))
    with pytest.raises(Exception, match="halfway"):
        versions.commit(broken, root, 1)
    assert versions.current_version(spark, root) == 1
    assert sorted(map(str, versions.read(spark, root).collect())) == sorted(map(str, rows.collect()))
    # A version may be made of the one that it follows, which stays readable.
    assert versions.commit(versions.read(spark, root).where("fuente = 'a'"), root, 1) == 2
    assert versions.read(spark, root).count() == rows.where("fuente = 'a'").count()
    assert versions.read(spark, root, 1).count() == rows.count()


def test_of_two_writers_on_one_version_the_second_is_told(spark, tmp_path):
    root = f"file://{tmp_path}/catalog"
    rows = random_catalog(spark)
    versions.commit(rows, root, 0)
    first, second = versions.read(spark, root).where("fuente = 'a'"), versions.read(spark, root).where("fuente = 'b'")
    assert versions.commit(first, root, 1) == 2
    with pytest.raises(versions.VersionConflict):
        versions.commit(second, root, 1)
    assert versions.current_version(spark, root) == 2
    assert {r.fuente for r in versions.read(spark, root).collect()} == {"a"}
    left = {p.name for p in (tmp_path / "catalog" / "data").iterdir()}
    assert len(left) == 2 and not list((tmp_path / "catalog" / "aside").glob("*.json"))
    assert versions.commit(second, root, versions.current_version(spark, root)) == 3  # tried again on the current version


def news(spark, rows):
    """New values for about half of the events."""
    return rows.where("event_id % 2 = 0").select("event_id", F.lit("new").alias("organizador"), F.when(F.col("event_id") % 3 > 0, "new@x.org").alias("email"))


def test_enrichment_reads_and_writes_through_versions(spark, tmp_path):
    root = f"file://{tmp_path}/catalog"
    rows = random_catalog(spark)
    versions.commit(rows, root, 0)
    assert contacts.enrich_version(spark, root, news(spark, rows), "run_id", 0, 0) == 1  # no run needs it
    assert contacts.enrich_version(spark, root, news(spark, rows), "run_id", 10**6, 95) == 2
    poor = {r.run_id for r in kpi.catalog_kpi(rows, ["run_id"]).collect() if r.eventos > 95 and r.run_id is not None}
    assert 0 < len(poor) < 4
    want = contacts.fill_contacts(rows, news(spark, rows)).collect()
    plain = {r.event_id: r for r in rows.collect()}
    want = {r.event_id: r if r.run_id in poor else plain[r.event_id] for r in want}
    got = {r.event_id: r for r in versions.read(spark, root).collect()}
    assert {k: (r.organizador, r.email) for k, r in got.items()} == {k: (r.organizador, r.email) for k, r in want.items()}


def test_counts_by_source_changed_by_filled_rows_equal_counting_again(spark):
    rows = random_catalog(spark, seed=5)
    filled = contacts.fill_contacts(rows, news(spark, rows))
    gaps = rows.alias("a").join(filled.alias("b"), "event_id").select(
        "a.run_id", "a.fuente", *[F.when(F.col(f"a.{c}").isNull(), F.col(f"b.{c}")).alias(c) for c in ("organizador", "email")]
    )
    parts = rollup.by_source(rows, ["run_id"])
    for by, cat in ((["run_id"], rows), (["run_id"], filled)):
        mine = rollup.kpis(rollup.merged(parts, *([rollup.filled(gaps, by)] if cat is filled else []), by=by), by)
        assert sorted(map(str, mine.collect())) == sorted(map(str, kpi.catalog_kpi(cat, by).collect()))
    marked = rows.join(filled.select("event_id", F.col("organizador").alias("nuevo_organizador"), F.col("email").alias("nuevo_email")), "event_id")
    enrich = lambda df: contacts.fill_contacts(df, news(spark, rows))
    want = contacts.enrich_then_measure(rows.where("run_id IS NOT NULL"), "run_id", enrich, 10**6, 95)
    got = rollup.enriched_kpis(marked.where("run_id IS NOT NULL"), "run_id", 10**6, 95)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert rollup.enriched_kpis(marked.where("false"), "run_id").count() == 0


def test_sketches_roll_up_to_the_direct_sketch_within_their_error(spark):
    """Sets of 3 to 60,000 sources, cut into parts in any way."""
    sizes = {1: 3, 2: 300, 3: 5_000, 4: 60_000}
    rows = spark.range(200_000).select(
        (F.col("id") % 4 + 1).alias("run_id"), (F.xxhash64("id") % 7).alias("dia"), F.lit(None).cast("string").alias("organizador"), F.lit("e").alias("email"), "id"
    )
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    rows = rows.withColumn("fuente", F.concat(F.lit("s"), F.xxhash64("id", F.lit(2)) % size[F.col("run_id")]))
    direct = {r.run_id: r for r in rollup.estimated(rollup.sketched(rows, ["run_id"])).collect()}
    exact = {r.run_id: r for r in kpi.catalog_kpi(rows, ["run_id"]).collect()}
    for by in (["run_id", "dia"], ["run_id", "dia", "_p"]):
        parts = rollup.sketched(rows.withColumn("_p", F.spark_partition_id()), by)
        path = shared_path(spark, "sketches")
        parts.write.parquet(path)
        got = {r.run_id: r for r in rollup.estimated(rollup.rolled_up(spark.read.parquet(path), ["run_id"])).collect()}
        assert got == direct
    for run, r in direct.items():
        assert (r.eventos, r.organizadores, r.emails) == (exact[run].eventos, 0, exact[run].emails)
        assert abs(r.fuentes - exact[run].fuentes) <= 4 * 1.04 / 2 ** (rollup.LG_K / 2) * exact[run].fuentes
    assert direct[1].fuentes == exact[1].fuentes
    empty = rollup.estimated(rollup.rolled_up(rollup.sketched(rows.where("false"), ["run_id"]), ["run_id"]))
    assert empty.count() == 0
    nulls = rollup.estimated(rollup.sketched(rows.limit(3).withColumn("fuente", F.lit(None).cast("string")), ["email"])).first()
    assert (nulls.eventos, nulls.fuentes, nulls.score) == (3, 0, 12)


def test_windows_with_sketches_equal_windows_with_sets(spark):
    rows = spark.range(5000).select(F.timestamp_seconds(F.col("id") * 90).alias("ts"), (F.col("id") % 11).cast("string").alias("fuente"), F.lit("o").alias("organizador"), F.lit(None).cast("string").alias("email"))
    want = streams.windowed_kpi(rows)
    assert sorted(map(str, rollup.estimated(rollup.windowed(rows)).select(*want.columns).collect())) == sorted(map(str, want.collect()))


class Plain(HTMLParser):
    """Addresses by the standard library's parser, for markup that it reads without doubt."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.raw, self.found, self.text = None, [], []

    def flush(self):
        self.found += [("text", a) for a in markup.ADDRESS.findall("".join(self.text))]
        self.text = []

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.raw = tag if tag in markup.RAW else None
        for name, value in attrs:
            if name == "href" and (value or "")[:7].lower() == "mailto:":
                self.found += [("mailto", x.strip()) for x in unquote(value[7:].partition("?")[0]).split(",") if markup.ADDRESS.fullmatch(x.strip())]

    def handle_endtag(self, tag):
        self.flush()
        self.raw = None

    def handle_comment(self, data):
        self.flush()

    def handle_data(self, data):
        if self.raw is None:
            self.text.append(data)


def random_page(rng):
    pieces = ["a@b.org", "x&#64;y.net", "x&#x40;y.net", "q&commat;r.io ", "&amp;", "text ", "<b>", "</b>", "<br/>", "<!-- c@d.ee -->", "<script>s@t.uu<b></script>", "<style>p@q.rr</style>", "<STYLE>h@i.jj</Style >", "é@ü.de ", "w.@x..yy", "@", " 1 < 2 "]
    links = ['<a href="mailto:m%40n.org">', "<a class=x HREF='mailto:o@p.com?cc=z@z.zz'>", "<a href=mailto:bare@one.fr>", '<a title="t@u.vv" href = "MAILTO:k@l.mm, n@o.pp">', '<a href="http://h.st/?m=a@b.cc">', "<p data-x='>' href=\"mailto:&#97;b@cd.ee\">"]
    return "".join(rng.choice(pieces + links) for _ in range(rng.randrange(0, 40)))


def test_addresses_equal_those_of_a_full_parser():
    rng = random.Random(3)
    for _ in range(3000):
        page = random_page(rng)
        parser = Plain()
        parser.feed(page)
        parser.close()
        parser.flush()
        assert markup.addresses(page) == parser.found, page


@pytest.mark.parametrize("part", ['<a b="', "<a b='c", "<", "<a ", "<!-- ", "<script>", "a@", "&#64;", "<a href=x ", '<a "', "<a =", "</", "<a/=", "<a href=\"mailto:a@b.cc,\"", "x  =  "])
def test_long_pages_take_linear_time(part):
    import time

    took = []
    for size in (250_000, 1_000_000):
        began = time.process_time()
        markup.addresses(part * (size // len(part)))
        took.append(time.process_time() - began)
    assert took[1] < 1 or took[1] < 10 * took[0]


def test_contacts_of_odd_pages(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (None, "n@o.pp"), (3, "n@o.pp n@o.pp"), (4, "<script>x@y.zz"), (5, "<!-- a@b.cc"), (6, "a@b.cc<a href='mailto:")], "k long, html string")
    got = sorted(map(str, ((r.k, r.lugar, r.email) for r in markup.contacts_in(rows, "k", "html").collect())))
    assert got == sorted(map(str, [(None, "text", "n@o.pp"), (3, "text", "n@o.pp"), (3, "text", "n@o.pp"), (6, "text", "a@b.cc")]))
    assert markup.contacts_in(rows.where("false"), "k", "html").count() == 0


@pytest.mark.parametrize("least", [1, 4, 30])
def test_frequent_sets_equal_enumeration(spark, least):
    rng = random.Random(2)
    rows = []
    for k in range(200):
        items = rng.choice([None, [], *[rng.choices(["ES", "PT", "FR", "DE", None, "ñ"], k=rng.randrange(0, 8)) for _ in range(6)]])
        rows.append((items, rng.choice([None, *range(50)]) if k % 3 else 7))
    held = {}
    for items, score in rows:
        if score is None:
            continue
        mine = sorted({x for x in items or [] if x is not None})
        for size in range(1, len(mine) + 1):
            for one in combinations(mine, size):
                held.setdefault(one, []).append(score)
    want = {(k, len(v), round(sum(v) / len(v), 9)) for k, v in held.items() if len(v) >= least}
    df = spark.createDataFrame(rows, "paises array<string>, score long")
    got = [(tuple(r["items"]), r.n, round(r.avg_score, 9)) for r in frequent_sets.frequent_sets(df, "paises", "score", least).collect()]
    assert len(got) == len(set(got)) and set(got) == want
