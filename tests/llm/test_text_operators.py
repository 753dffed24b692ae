"""License scan, quality rules, SentencePiece, toxicity and quality classifier."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from lumenreef.llm import license_scan, quality_classifier, quality_rules, sentencepiece_bpe, toxicity
from lumenreef.llm import registry
from pyspark.sql import functions as F

import public_tokenizers

ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "one two"), (5, "x" * 50_000), (6, "mit license " * 300), (6, "mit license " * 300)]
SCHEMA = "doc_id long, text string, label string, toxicity string, ids string, kept string, score string"


def odd_docs(spark, rows=ODD):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA)


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in low + " ":
        if c.isascii() and not ("a" <= c <= "z" or "0" <= c <= "9"):
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def base_places(text):
    w = words_of(text)
    return sorted((i, k) for k, p in PHRASES.items() for i in range(len(w)) if w[i : i + len(p)] == p)


def license_texts():
    rng = random.Random(2)
    bag = ["MIT", "License", "apache", "general", "public", "license.", "é", "the", "of", "GNU", "x9"]
    return [" ".join(rng.choice(bag) for _ in range(rng.randint(0, 60))) for _ in range(200)]


def test_license_base_places(spark):
    texts = license_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan.license_report(docs).collect():
        places = base_places(texts[r.doc_id])
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (len(words_of(texts[r.doc_id])), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({k for _, k in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def labels_of(text):
    return {h.notice.label for h in license_scan.Scanner().hits(license_scan.normalised(text)[1])}


def test_names_of_a_notice_stand_or_are_off_by_one_slip():
    for text in ("get it license", "kit license", "omit license", "generate public license", "all nights reserved", "mits license", "released under the bsd license", "licensed under cc by sa"):
        assert labels_of(text) == set(), text
    wanted = {
        "mit licence": "mit", "apache licence": "apache", "general public licens": "gpl", "al rights reserved": "all-rights-reserved",
        "licensed under the apach license version 2 0": "apache", "licensed under the apachee license version 2.0": "apache",
        "released under the mitt license": "mit", "mozila public license": "mpl", "creative comons attribution": "cc",
        "genral public license": "gpl", "all rigths reserved": "all-rights-reserved", "all right reserved": "all-rights-reserved", "apachelicense": "apache",
    }
    for text, label in wanted.items():
        assert labels_of(f"a {text} b") == {label}, text
    assert "lgpl" in labels_of("gnu lesser general pubic license")


def swaps(word):
    return {word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(len(word) - 1)}


def test_license_fuzzy_matches_are_within_bounds_and_none_is_lost():
    """Over the production notices: every text within the bound whose names stand by the rule is found."""
    scanner = license_scan.Scanner()
    rng = random.Random(8)
    checked = 0
    for notice in license_scan.NOTICES:
        for _ in range(150):
            phrase = list(notice.phrase)
            for _ in range(rng.randint(0, notice.edits + 1)):
                k = rng.randrange(len(phrase))
                phrase[k : k + rng.randint(0, 1)] = rng.choice(["", "q", "z"])
            made = " ".join("".join(phrase).split())
            hits = [h for h in scanner.hits(license_scan.normalised(f"aaa bbb {made} ccc")[1]) if h.notice == notice]
            assert all(h.edits <= notice.edits for h in hits)
            words = made.split()
            if notice.exact:
                named = all(f" {n} " in f" {made} " for n in notice.names)
            else:
                named = all(n in made or any(w[0] == n[0] and (edits(w, n) <= 1 or w in swaps(n)) for w in words) for n in notice.names)
            if edits(made, notice.phrase) <= notice.edits and named:
                assert hits, (notice.phrase, made)
                checked += 1
    assert checked > 1000


def test_license_spans(spark):
    text = "Ünder: Released  under the MIT-Licence, ok"
    got = license_scan.license_spans(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).collect()
    full = [r for r in got if r.notice == "released under the mit license"]
    assert [(text[r.start_char : r.end_char], r.edits) for r in full] == [("Released  under the MIT-Licence", 1)]


def test_license_odd_rows(spark):
    got = license_scan.license_report(odd_docs(spark)).collect()
    assert len(got) == len(ODD)
    assert {(r.n_words, r.n_base, r.score) for r in got if r.doc_id in (1, 2, 3)} == {(0, 0, 0.0)}
    assert [r.n_base for r in got if r.doc_id == 6] == [300, 300]
    assert license_scan.license_report(odd_docs(spark, [])).count() == 0


def test_quality_counts_by_hand(spark):
    text = "a b c a b c\na b c\nx|y # é\n \na b c"
    s = quality_rules.TextStats(text)
    assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines) == (15, 17, 2, 1)
    assert s.n_repeat_words == 12


def test_quality_repeat_words_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        w = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        assert quality_rules.TextStats(" ".join(w)).n_repeat_words == len(hit)


def test_cascade_order_does_not_change_verdicts():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["ab", "#", "THE", "12", "word"]) for _ in range(rng.randint(0, 120))) for _ in range(80)]
    a, b = quality_rules.Cascade(quality_rules.RULES), quality_rules.Cascade(quality_rules.RULES[::-1])
    for t in texts:
        assert (a.first_failing(quality_rules.TextStats(t)) is None) == (b.first_failing(quality_rules.TextStats(t)) is None)


def test_order_by_benefit():
    rows = [([True, False, False], [9.0, 1.0, 1.0]), ([False, True, False], [9.0, 1.0, 1.0]), ([True, True, False], [9.0, 1.0, 1.0])]
    assert quality_rules.order_by_benefit(rows, 3) == [1, 0, 2]


def test_quality_filter_keeps_columns_and_handles_odd_rows(spark):
    good = " ".join(f"word{k}" for k in range(80)).translate(str.maketrans("0123456789", "abcdefghij"))
    docs = odd_docs(spark, [*ODD, (9, good), (9, good)])
    kept = quality_rules.filter_quality(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [9, 9]
    report = quality_rules.quality_report(docs)
    assert report.count() == len(ODD) + 2 and report.where("kept").count() == 2
    assert quality_rules.quality_report(odd_docs(spark, [])).count() == 0
    assert quality_rules.filter_quality(odd_docs(spark, [])).count() == 0


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_bpe.Codec(sentencepiece_bpe.BpeModel.load())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(codec, library):
    rng = random.Random(3)
    pieces = [p.replace("▁", " ") for p in codec.model.ids]
    letters = "abcdefgh   the ing ation▁\n\t  éñß中文🤖0123456789.,!?'\"<0x0A>AB\x00"
    for k in range(1500):
        if k % 2:
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        else:
            text = "".join(rng.choice(pieces) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(1, 9)))
        text *= 400 if k % 250 == 0 else 1
        ids = library.encode(text)
        assert codec.encode(text) == ids
        back = library.decode(ids)
        assert codec.decode(ids) == back
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        assert codec.digest(text) == (len(ids), *sha)


def test_long_segments(codec, library):
    for text in ("a" * 5000, "abcdefghij" * 2000, "é中" * 4500):
        assert codec.encode(text) == library.encode(text)


def test_encode_and_decode_tables(spark, library):
    docs = odd_docs(spark)
    encoded = sentencepiece_bpe.encode_texts(docs)
    back = sentencepiece_bpe.decode_ids(encoded)
    assert [c for c in back.columns if c not in ("ids", "decoded")] == [c for c in docs.columns if c != "ids"]
    for r in back.collect():
        assert r.ids == library.encode(r.text or "") and r.decoded == (r.text or "").replace("▁", " ")
    assert sentencepiece_bpe.encoding_report(odd_docs(spark, [])).count() == 0
    assert sentencepiece_bpe.encoding_report(docs).where("doc_id = 1").first().n_tokens == 0


def test_toxicity_finds_misspelt_words():
    rng = random.Random(6)
    plain = ["table", "river", "stone", "garden", "music", "winter", "letter", "window", "summer", "bridge"]
    bad = ["grumblex", "snarlify"]
    texts, labels = [], []
    for k in range(240):
        words = [rng.choice(plain) for _ in range(60)]
        if k % 3 == 0:
            words[rng.randrange(60)] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append(int(k % 3 == 0))
    model = toxicity.train(texts, labels)
    score = model.scorer()
    assert all((score(t) >= 0.5) == bool(y) for t, y in zip(texts, labels))
    assert score("table grumblexx river") > 0.5 > score("table river stone brand")
    assert score("river " * 5000 + "grumblex") > 0.5


def test_toxicity_degenerate_training():
    for texts, labels in (([], []), (["a"], [1]), (["", ""], [0, 1])):
        s = toxicity.train(texts, labels).scorer()
        assert 0 <= s("") <= 1 and 0 <= s("word") <= 1


def test_toxicity_rows_and_odd_tables(spark):
    docs = odd_docs(spark, [*ODD, (7, "bad"), (8, "good"), (8, "good")])
    labels = spark.createDataFrame([(7, 1), (8, 0), (8, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == len(ODD) + 3
    for r in got:
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(text.encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
    scored = toxicity.score_toxicity(docs, toxicity.train([], []))
    assert sorted(scored.columns) == sorted(docs.columns)
    assert toxicity.toxicity_report(odd_docs(spark, []), labels).count() == 0


def test_quality_classifier_held_out(spark):
    d = "/root/testdata/sf0.01"
    got = registry.queries()["op9_quality_classifier"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    got = registry.queries()["op7_toxicity"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9


def test_quality_classifier_odd_tables(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_classifier.quality_scores(docs, none).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(k, 1) for k in range(1, 7)], "doc_id long, quality int")
    assert all(r.score > 0.5 for r in quality_classifier.quality_scores(docs, one).collect())
    assert quality_classifier.quality_scores(odd_docs(spark, []), one).count() == 0


def test_isotonic():
    got = quality_classifier.isotonic(np.array([1.0, 1, 2, 1]), np.array([0.0, 3, 1.5, 4]))
    assert np.allclose(got, [0, 2, 2, 4])


def test_normal_equations_equal_one_numpy_solve(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, len(quality_classifier.STATISTICS)))
    y = (x[:, 0] > 0).astype(int)
    stats = spark.createDataFrame([(int(i), row.tolist()) for i, row in enumerate(x)], "doc_id long, x array<double>").repartition(5)
    labels = spark.createDataFrame([(int(i), int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    model = quality_classifier.fit_quality(stats, labels, F.lit(True))
    z = model.features(x)
    penalty = quality_classifier.RIDGE * len(y) * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-9
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)
