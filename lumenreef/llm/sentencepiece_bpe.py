"""Exact encoding and decoding with a merge-type SentencePiece model.

A sequence of pieces is the encoding of a text exactly if every piece encodes
to itself and every two neighbours stay two pieces when their joined text is merged
again. So the encoder walks the text with the longest match of an Aho-Corasick
automaton at each place, checks it against the piece before by re-merging the
two, tries the next shorter match if they are not compatible, and steps back when
none is left, marking places from which no way leads on in a bit field. No piece has
the space mark behind another character, so a text falls into segments (spaces and
what follows up to the next space) that are encoded apart and remembered.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lumenreef.llm._arrow import slices, texts_of

SPACE = "▁"
#: Entries of each of a task's two segment memories; the older one goes when the newer is full.
MEMORY = 300_000
#: Segments longer than this are not remembered, and their matches are found in blocks.
LONG = 64
_BLOCK = 4096
_NONE = float("-inf")
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def merged(text: str, scores: dict[str, float], border: int = 0) -> list[str] | None:
    """Plain merging: again and again the best-scored neighbours, the leftmost of equals.

    With a ``border`` the result is None as soon as a merge would cross that place.
    """
    parts, get = list(text), scores.get
    ranks = [get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
    while ranks and (best := max(ranks)) != _NONE:
        k = ranks.index(best)
        if border and sum(map(len, parts[: k + 1])) == border:
            return None
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
        del ranks[k]
        if k < len(ranks):
            ranks[k] = get(parts[k] + parts[k + 1], _NONE)
        if k:
            ranks[k - 1] = get(parts[k - 1] + parts[k], _NONE)
    return parts


@dataclass
class BpeModel:
    """Pieces of a model: text -> id, scores, ids of single bytes, and longest piece.

    ``reachable`` has the pieces that merging their own text gives back whole.
    """

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    unknown: int
    reachable: frozenset[str] = frozenset()
    texts: list[bytes | None] = field(default_factory=list)
    _codec: Codec | None = None

    def codec(self) -> Codec:
        """The process's codec for this model: later tasks of a worker find its memories filled."""
        if self._codec is None:
            self._codec = Codec(self)
        return self._codec

    @classmethod
    def load(cls, path: str | None = None) -> BpeModel:
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        n = sp.get_piece_size()
        texts: list[bytes | None] = [None] * n
        ids, scores, byte_ids = {}, {}, [sp.unk_id()] * 256
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[1:-1], 16)
                byte_ids[value], texts[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                ids[piece], scores[piece] = i, sp.get_score(i)
                texts[i] = piece.replace(SPACE, " ").encode()
        whole = frozenset(p for p in ids if len(p) == 1 or merged(p, scores) == [p])
        return cls(ids, scores, byte_ids, sp.unk_id(), whole, texts)


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, model: BpeModel) -> None:
        self.model = model
        self.longest = max(map(len, model.reachable))
        self.automaton = ahocorasick.Automaton()
        for piece in model.reachable:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self._letters = {p for p in model.ids if len(p) == 1}
        self._fits: dict[tuple[str, str], bool] = {}
        self._memory: dict[str, tuple[str, int, str]] = {}
        self._older: dict[str, tuple[str, int, str]] = {}

    def compatible(self, a: str, b: str) -> bool:
        """True if merging the joined text of two pieces gives the two again."""
        key = (a, b)
        fits = self._fits.get(key)
        if fits is None:
            if len(self._fits) > MEMORY:
                self._fits.clear()
            fits = self._fits[key] = merged(a + b, self.model.scores, len(a)) is not None
        return fits

    def _matches(self, text: str):
        """A function place -> pieces that start there, shortest first."""
        blocks: dict[int, list[list[str]]] = {}

        def block(k: int) -> list[list[str]]:
            first = k * _BLOCK
            size = min(_BLOCK, len(text) - first)
            found: list[list[str]] = [[] for _ in range(size)]
            for end, piece in self.automaton.iter(text[first : first + size + self.longest]):
                start = end + 1 - len(piece)
                if start < size:
                    found[start].append(piece)
            if len(blocks) > 8:
                blocks.clear()
            blocks[k] = found
            return found

        if len(text) <= _BLOCK:
            return block(0).__getitem__
        return lambda at: (blocks.get(at // _BLOCK) or block(at // _BLOCK))[at % _BLOCK]

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text in which every character is a piece."""
        if text in self.model.reachable:
            return [text]
        fits = self._fits
        greedy = [piece for _, piece in self.automaton.iter_long(text)]
        before = greedy[0]
        for piece in greedy[1:]:
            ok = fits.get((before, piece))
            if ok is None:
                ok = self.compatible(before, piece)
            if not ok:
                break
            before = piece
        else:
            return greedy  # the longest matches fit at once
        matches, end = self._matches(text), len(text)
        failed = bytearray(end // 8 + 1)  # a bit for each place without a way on
        out: list[str] = []
        before, at = "", 0
        options = matches(0)
        left = [len(options)]  # matches not yet tried at each place on the way
        while at < end:
            k = left[-1]
            while k:
                k -= 1
                piece = options[k]  # the longest left
                to = at + len(piece)
                if failed[to >> 3] >> (to & 7) & 1:
                    continue
                if not before:
                    break
                ok = fits.get((before, piece))
                if ok or ok is None and self.compatible(before, piece):
                    break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                left.pop()
                at -= len(out.pop())
                before = out[-1] if out else ""
                options = matches(at)
                continue
            left[-1] = k
            out.append(piece)
            before, at = piece, to
            if at < end:
                options = matches(at)
                left.append(len(options))
        return out

    def _segment_ids(self, segment: str) -> list[int]:
        known = self.model.ids
        if self._letters.issuperset(segment):
            return [known[p] for p in self.pieces(segment)]
        ids: list[int] = []
        run: list[str] = []
        for c in segment:
            if c in known:
                run.append(c)
                continue
            if run:
                ids += [known[p] for p in self.pieces("".join(run))]
                run = []
            ids += [self.model.byte_ids[b] for b in c.encode("utf-8")]
        if run:
            ids += [known[p] for p in self.pieces("".join(run))]
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a text; none for the empty text."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return [i for s in _SEGMENT.findall(marked) for i in self._segment_ids(s)]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: one leading space goes, unknown ids become the replacement mark."""
        texts = self.model.texts
        raw = b"".join(" ⁇ ".encode() if i == self.model.unknown else texts[i] or b"" for i in ids)
        return raw.decode("utf-8", "replace").removeprefix(" ")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as text, and SHA-256 of the decoded ids.

        Segments are encoded and decoded once each; a segment starts with the space
        mark, so bytes of one character never lie in two segments.
        """
        if not text:
            return 0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest()
        if len(self._memory) > MEMORY:
            self._memory, self._older = {}, self._memory
        memory, older = self._memory, self._older
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            segments = _SEGMENT.findall(SPACE + text.replace(" ", SPACE))
        else:
            segments = text.split(" ")  # each without its leading mark
        shown, count, back = [], 0, []
        for s in segments:
            got = memory.get(s)
            if got is None and (got := older.get(s)) is not None:
                memory[s] = got
            elif got is None:
                ids = self._segment_ids(s if s[0] == SPACE else SPACE + s)
                got = ",".join(map(str, ids)), len(ids), b"".join(self.model.texts[i] for i in ids).decode("utf-8", "replace")
                if len(s) <= LONG:
                    memory[s] = got
            shown.append(got[0])
            count += got[1]
            back.append(got[2])
        decoded = "".join(back).removeprefix(" ")
        sha = hashlib.sha256
        return count, sha(",".join(shown).encode()).hexdigest(), sha(decoded.encode("utf-8", "replace")).hexdigest()


def _codecs(spark: SparkSession, path: str | None):
    """A broadcast of the model; its size is the vocabulary's."""
    return spark.sparkContext.broadcast(BpeModel.load(path))


def encode_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with a column ``ids`` (array of int); null and empty texts have no ids.

    A column of that name is replaced; all other columns and rows stay.
    """
    docs = docs.drop("ids")
    shared = _codecs(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec()
        for batch in slices(batches):
            ids = pa.array([codec.encode(t) for t in texts_of(batch)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return docs.mapInArrow(run, docs.selectExpr("*", "CAST(NULL AS array<int>) AS ids").schema)


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with a column ``decoded``, the text of its column ``ids`` (null: no ids)."""
    encoded = encoded.drop("decoded")
    shared = _codecs(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec()
        for batch in slices(batches):
            texts = pa.array([codec.decode(ids or []) for ids in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, encoded.selectExpr("*", "CAST(NULL AS string) AS decoded").schema)


REPORT_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoding_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row for each document: number of ids and digests of ids and decoded text.

    Null and empty texts have no ids and the digests of the empty string. A null doc_id keeps its row, repeated rows
    repeat, an empty table gives no rows. Other columns take no part.
    """
    shared = _codecs(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec()
        for batch in slices(batches):
            columns = zip(*[codec.digest(t) for t in texts_of(batch)])
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *arrays], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, REPORT_SCHEMA)
