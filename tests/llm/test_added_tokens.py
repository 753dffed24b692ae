"""Ids of texts that hold an added token's content, against the library as loaded."""

import zlib

import numpy as np
from lumenreef.llm import packing
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "中文 <|endoftext|> 中", "<|endoftext |>", "plain", "", "中"]


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_library_as_loaded():
    mine, theirs = packing.Tokenizer(), library()
    for text in TEXTS:
        assert mine.ids(text) == theirs.encode(text, add_special_tokens=False).ids, text
    assert mine.ids(TEXTS[0]) == [64, 220, 50256, 275]


def test_query_and_pipeline_use_them(spark):
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_chars long")
    theirs = library()
    for got in (packing.packing_report(docs), corpus_pipeline.pack_sequences(spark, docs, "")):
        rows = got.collect()
        for k, text in enumerate(TEXTS):
            ids = np.array([*theirs.encode(text, add_special_tokens=False).ids, packing.END_ID], "<u4")
            mine = sorted((r for r in rows if r.doc_id == k), key=lambda r: r.start)
            assert sum(r.length for r in mine) == mine[0].doc_tokens == len(ids)
            assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine)


def test_merge_join_gives_the_places_of_the_broadcast(spark, monkeypatch):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('word ', cast(id * 37 % 900 AS int)) AS text").repartition(7, "doc_id")
    kinds = []
    for most in (packing.BROADCAST_BYTES, 0):
        monkeypatch.setattr(packing, "BROADCAST_BYTES", most)
        got = packing.pack(docs, 256)
        rows = sorted((r.sequence_id, r.offset, r.length) for r in got.collect())
        ends = {}
        for sequence, offset, length in rows:
            assert offset == ends.get(sequence, 0)
            ends[sequence] = offset + length
        assert all(v == 256 or v & (v - 1) == 0 for v in ends.values())
        kinds.append((len(ends), sum(ends.values())))
    assert kinds[0] == kinds[1]
