"""The pipeline's near-dedup stage against brute force on exact shingle sets."""

import random

import corpus_pipeline
import numpy as np
import pytest
from lumenreef.llm import near_dedup, simhash
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def texts_at(rng, share_changed):
    """A text and a copy with some words changed."""
    words = [f"w{rng.randrange(9000)}" for _ in range(rng.randint(60, 400))]
    other = list(words)
    for _ in range(max(1, int(len(words) * share_changed))):
        other[rng.randrange(len(other))] = "changed"
    return " ".join(words), " ".join(other)


def brute_kept(texts):
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8 and root[i] != root[j]:
                high, low = max(root[i], root[j]), min(root[i], root[j])
                root = [low if r == high else r for r in root]
    return {k for k, r in enumerate(root) if k == r}


def stage(spark, texts):
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], DOCS)
    return {r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()}


def test_stage_meets_pairs_at_the_bound(spark):
    rng = random.Random(3)
    texts = [None, "", "  ", "a b c", "A b  C", "a b d"]
    for _ in range(120):
        texts += texts_at(rng, rng.choice([0.02, 0.03, 0.06]))
    near = [similarity(shingle_set(a), shingle_set(b)) for a, b in zip(texts[6::2], texts[7::2])]
    assert sum(0.8 <= s < 0.9 for s in near) > 20 and sum(s < 0.8 for s in near) > 20
    assert stage(spark, texts) == brute_kept(texts)


def test_stage_follows_chains(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(9000)}" for _ in range(200)]
    chain = []
    for k in range(30):  # neighbours are alike, the ends are not
        words = words[6:] + [f"x{k}y{j}" for j in range(6)]
        chain.append(" ".join(words))
    rng.shuffle(chain)
    assert stage(spark, chain) == brute_kept(chain) == {0}


def joined(n, links):
    root = list(range(n))
    for i, j in links:
        high, low = max(root[i], root[j]), min(root[i], root[j])
        root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("seed", range(12))
def test_linked_sets_against_all_pairs(seed):
    """Sets of all sizes around the bound, with common hashes; known components and two sides."""
    rng = np.random.default_rng(seed)
    common = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = []
    for _ in range(25):
        base = rng.integers(0, 1 << 63, rng.integers(1, 120), dtype=np.uint64)
        for _ in range(rng.integers(1, 5)):
            kept = base[rng.random(len(base)) < rng.choice([0.8, 0.9, 0.97, 1])]
            sets.append(np.unique(np.concatenate([kept, common[: rng.integers(1, 60)]])))
    n = len(sets)
    roots = [int(r) for r in rng.integers(0, n, n)] if seed % 3 == 0 else list(range(n))
    sides = [int(s) for s in rng.integers(0, 2, n)] if seed % 2 else [0] * n
    groups = {r: [k for k in range(n) if roots[k] == r] for r in set(roots)}
    known = [(g[0], k) for g in groups.values() for k in g[1:]]
    pairs = [(i, j) for i in range(n) for j in range(i) if seed % 2 == 0 or sides[i] != sides[j]]
    want = [(i, j) for i, j in pairs if similarity(set(sets[i].tolist()), set(sets[j].tolist())) >= 0.8]
    got = list(near_dedup.linked(sets, roots, sides))
    assert all((max(x), min(x)) in want for x in got) and len(got) < n
    assert joined(n, known + got) == joined(n, known + want)


def test_one_band_of_unlike_texts(spark, monkeypatch):
    """5,000 texts with a common passage in one band, of which pairs are alike, in many chunks."""
    monkeypatch.setattr(near_dedup, "BAND_HASHES", 20_000)
    rng = random.Random(12)
    passage = [f"p{k}" for k in range(40)]
    texts = []
    for k in range(2_400):
        own = [f"w{rng.randrange(10**6)}" for _ in range(20)]
        texts += [" ".join(passage + own), " ".join(passage + own[:-1] + ["z"] * (k % 3))]
    texts += [" ".join(passage + [f"x{k}y{j}" for j in range(40)]) for k in range(200)]
    plain = near_dedup._sketches
    monkeypatch.setattr(near_dedup, "_sketches", lambda docs: plain(docs).withColumn("keys", F.array(F.lit(1).cast("long"))))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    want = {}
    for k in range(0, 4_800, 2):
        low = min(ids[k], ids[k + 1])
        want[ids[k]] = want[ids[k + 1]] = low
    want |= {i: i for i in ids[4_800:]}
    assert got == want


def test_groups_of_fingerprints_are_bands(spark, monkeypatch):
    """Without MinHash bands the stage finds what SimHash links within 4 bits, checked on the exact sets."""
    rng = random.Random(21)
    texts = [None, "", "a b c"]
    for _ in range(60):
        texts += texts_at(rng, 0.01)
    texts += ["x " * n for n in (30, 40, 50)]  # one set and one shingle, repeated
    # One fingerprint whose sets differ: the exact check keeps them apart.
    many = [f"m{k}" for k in range(7)]
    texts += [" ".join(many * 400), " ".join(many * 400 + [f"z{k}" for k in range(12)])]
    plain = near_dedup._sketches
    monkeypatch.setattr(near_dedup, "_sketches", lambda docs: plain(docs).withColumn("keys", F.array().cast("array<long>")))
    prints, sets = [simhash.fingerprint(t or "") for t in texts], [shingle_set(t) for t in texts]
    assert (prints[-1] ^ prints[-2]).bit_count() <= 4 and similarity(sets[-1], sets[-2]) < 0.8
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] == sets[j] or (prints[i] ^ prints[j]).bit_count() <= 4]
    links = [(i, j) for i, j in links if similarity(sets[i], sets[j]) >= 0.8]
    alike = sum(sets[i] != sets[j] for i, j in links)
    assert alike > 10
    assert stage(spark, texts) == {k for k, r in enumerate(joined(len(texts), links)) if k == r}
