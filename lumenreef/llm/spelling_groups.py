"""Spelling variants: words one edit apart, grouped under the most frequent form.

Near words are found by dynamic programming over a sorted list: the rows of a query's edit matrix (a
band of three cells, as one edit is the bound) are reused down to the common prefix of a word
with the word before it, and once a row has no cell within one edit, all words that share that
prefix are skipped.

The vocabulary is dealt into lists so that no task needs the whole of it. Of two words one edit
apart, the shorter of ``m`` code points, either the first ``m // 2`` code points agree or the last
``m - m // 2``: the edit is in one half. So a word enters the lists of its first and last half, as a
shorter word (``m`` is its length) and as a longer one (``m`` is one less). Lists of last halves
are read backwards, so that the shared half is a common prefix there too. A list of more than
``LIST_WORDS`` words is cut into chunks, and each pair of chunks is a list of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreef.llm._arrow import slices, texts_of
from lumenreef.llm._scratch import Scratch

#: Runs of these are words; only A-Z are lower-cased.
WORD = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form is at least so many times as frequent.
RATIO = 5
#: Words in a list beyond which it is cut into chunks.
LIST_WORDS = 20_000
#: Distinct words that a task counts before it passes the counts on.
HELD_WORDS = 200_000

Alter = Callable[[int | None, str], str]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, alter: Alter | None = None) -> DataFrame:
    """``word, n`` for the words of all texts with enough code points and occurrences.

    ``alter`` maps a document's id and word to the word counted. Null and empty texts have no
    words; repeated rows count again; ids may be null; an empty table gives no rows. Words are counted in each task before
    they are shuffled, so a word that is everywhere costs a row for each task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return out

        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                text = text.encode("utf-8", "replace").lower().decode("utf-8")  # of bytes: A-Z only
                for word, n in Counter(WORD.findall(text)).items():
                    if alter is not None:
                        word = alter(doc_id, word)
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield passed_on()
        yield passed_on()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


class SortedList:
    """Sorted words with the lengths of their common prefixes, searched for words exactly one edit away."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        #: Common prefix of each word with the word before; a last entry ends the list.
        self.shared = [0, *map(_common, words, words[1:]), -1]
        #: For each entry the next one with a shorter common prefix.
        self.after = [len(words)] * (len(words) + 1)
        open_: list[int] = []
        for i, x in enumerate(self.shared):
            while open_ and self.shared[open_[-1]] > x:
                self.after[open_.pop()] = i
            open_.append(i)

    def one_edit(self, query: str) -> Iterator[int]:
        """Places of the words that differ from ``query`` by one inserted, deleted or replaced code point.

        Row ``r`` holds the distances of a word's first ``r`` code points to the query's first ``r - 1``, ``r`` and
        ``r + 1``, cut off at 2.
        """
        n, words, shared, after = len(query), self.words, self.shared, self.after
        padded = f"\0{query}\0\0\0"  # no word has this code point, so cells beyond the query only grow
        rows = [(2, 0, 1)]
        at = 0
        while at < len(words):
            word = words[at]
            r = min(len(rows) - 1, shared[at])
            del rows[r + 1 :]
            a, b, c = rows[r]
            dead = min(a, b, c) > 1
            while not dead and r < len(word) and r <= n:
                x = word[r]
                a = min(b + 1, a + (x != padded[r]), 2)
                b = min(c + 1, b + (x != padded[r + 1]), a + 1, 2)
                c = min(c + (x != padded[r + 2]), b + 1, 2)
                rows.append((a, b, c))
                r += 1
                dead = a > 1 and b > 1 and c > 1
            if r == len(word) and not dead and -1 <= n - r <= 1 and rows[r][n - r + 1] == 1:
                yield at
            at += 1
            if dead or r < len(word):
                # Not one word with these first r code points is within one edit.
                while shared[at] >= r:
                    at = after[at]


def near_pairs(words: list[str], m: int, backwards: bool) -> Iterator[tuple[int, int]]:
    """Places of the pairs of ``words`` one edit apart whose shorter one has ``m`` code points, each once.

    ``backwards`` leaves out pairs that agree in their first half: another list has them.
    """
    order = sorted(range(len(words)), key=lambda i: words[i][::-1]) if backwards else sorted(range(len(words)), key=words.__getitem__)
    listed = SortedList([words[i][::-1] for i in order] if backwards else [words[i] for i in order])
    half = m // 2
    for place, i in enumerate(order):
        if len(words[i]) != m:
            continue
        for other in listed.one_edit(listed.words[place]):
            j = order[other]
            twice = len(words[j]) == m and other < place
            if len(words[j]) >= m and not twice and not (backwards and words[i][:half] == words[j][:half]):
                yield i, j


_NEAR = "word string, n_near long, near_n long, near string"


def _listed(vocab: DataFrame, limit: int) -> DataFrame:
    """The rows of the lists: key columns, word, n and the chunk of the word in a long list."""
    length, word = F.length("word"), F.col("word")
    entries = []
    for m in (length, length - 1):
        half = F.floor(m / 2).cast("int")
        entries.append(F.struct(m.alias("m"), F.lit(False).alias("backwards"), word.substr(F.lit(1), half).alias("part")))
        entries.append(F.struct(m.alias("m"), F.lit(True).alias("backwards"), F.right(word, m - half).alias("part")))
    rows = vocab.select("word", "n", F.explode(F.array(*entries)).alias("e")).select("e.*", "word", "n")
    key = ["m", "backwards", "part"]
    long_ = rows.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") > limit)
    chunks = F.ceil(F.coalesce(F.col("_rows"), F.lit(1)) / limit).cast("int")
    mine = F.pmod(F.xxhash64("word"), chunks).cast("int")
    marked = rows.join(long_, key, "left").withColumns({"_chunks": chunks, "chunk": mine})
    # A word goes to the pairs of chunks that its own is in.
    others = F.transform(F.sequence(F.lit(0), F.col("_chunks") - 1), lambda k: F.struct(F.least("chunk", k).alias("i"), F.greatest("chunk", k).alias("j")))
    return marked.select(*key, F.explode(others).alias("pair"), "chunk", "word", "n")


def near_words(vocab: DataFrame, limit: int = LIST_WORDS) -> DataFrame:
    """``word, n_near, near, near_n`` for the words that have near words: how many, and the most frequent of them.

    ``vocab`` has distinct words; of equally frequent near words the smallest in code-point order counts.
    """
    key = ["m", "backwards", "part", "pair"]
    dealt = _listed(vocab, limit).repartition(*key).sortWithinPartitions(*key)

    def search(group: tuple, rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, str]]:
        m, backwards, _, pair = group
        if len(rows) < 2 or all(len(w) != m for w, _, _ in rows):
            return
        best: dict[int, tuple[int, str]] = {}
        count: Counter[int] = Counter()
        for i, j in near_pairs([w for w, _, _ in rows], m, backwards):
            if pair["i"] != pair["j"] and rows[i][2] == rows[j][2]:
                continue  # the list of this one chunk has it
            for x, y in ((i, j), (j, i)):
                word, n, _ = rows[y]
                count[x] += 1
                best[x] = min(best.get(x, (1, "")), (-n, word))
        for x, (n, word) in best.items():
            yield rows[x][0], count[x], -n, word

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 4
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "n_near", "near_n", "near"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in key))
            values = zip(*(batch.column(c).to_pylist() for c in ("word", "n", "chunk")))
            for mine, row in zip(keys, values):
                if mine != group:
                    out.extend(search(group, rows) if rows else ())
                    group, rows = mine, []
                rows.append(row)
            if out:
                yield packed()
        out.extend(search(group, rows) if rows else ())
        yield packed()

    found = dealt.mapInArrow(scan, _NEAR)
    first = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    grouped = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("_f"))
    return grouped.select("word", "n_near", F.col("_f.word").alias("near"), (-F.col("_f.n")).alias("near_n"))


def spelling_groups(vocab: DataFrame, ratio: int = RATIO, limit: int = LIST_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for ``vocab(word, n)``: the form a word is a variant of, and the last form.

    A form is the word's most frequent near word (ties: smallest in code-point order) if it is at least ``ratio`` times as
    frequent; without one ``form`` and ``form_n`` are null and ``root`` is the word itself. Each step to a form multiplies the
    count, so forms end after a few; roots are found by doubling the steps. Words are distinct; no words give no rows.
    """
    scratch = Scratch(vocab.sparkSession)
    vocab = scratch.keep(vocab.select("word", "n"), "vocabulary")
    has = F.col("near_n") >= ratio * F.col("n")
    joined = vocab.join(near_words(vocab, limit), "word", "left")
    forms = scratch.keep(
        joined.select("word", F.when(has, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("near_n")).alias("form_n")),
        "forms",
    )
    steps = scratch.keep(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = scratch.keep(steps.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        moved = further.agg(F.max("_moved")).first()[0]
        scratch.drop(steps)
        steps = further
        if not moved:
            break
    scratch.drop(vocab)
    out = forms.join(steps.select("word", "root"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def misspelt(doc_id: int | None, word: str) -> str:
    """The report's planted misspellings: one code point less in each 199th pair of document and word."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    at = h % len(word)
    return word if h % 199 else word[:at] + word[at + 1 :]


def spelling_report(docs: DataFrame) -> DataFrame:
    """``spelling_groups`` of the vocabulary of all texts, with the report's planted misspellings."""
    return spelling_groups(vocabulary(docs, alter=misspelt))


_ACCENTS = "".join(map(chr, range(0xC0, 0x100)))
#: One ASCII character for each of them that no word has, as DuckDB's edit distance counts bytes.
_STAND_INS = "".join(chr(c) for c in range(0x21, 0x61)).replace("\\", "~").replace("'", "|")

#: DuckDB: checksums by the table of CRC-32, words of near lengths compared with each other, and forms followed.
REPORT_SQL = rf"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t
), runs AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY ALL
), bytes AS (
  SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
              lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END))::BIGINT[] AS b FROM runs
), hashed AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc
), vocab AS (
  SELECT word, sum(n)::BIGINT AS n, length(word) AS l, translate(word, '{_ACCENTS}', '{_STAND_INS}') AS plain
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substring(w, (h % length(w) + 2)::BIGINT) ELSE w END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM vocab a JOIN vocab b ON b.l BETWEEN a.l - 1 AND a.l + 1
    AND (left(a.plain, 3) = left(b.plain, 3) OR right(a.plain, 3) = right(b.plain, 3)) AND levenshtein(a.plain, b.plain) = 1
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
         CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
  FROM vocab v LEFT JOIN best USING (word)
), steps AS (
  SELECT word, word AS root, form AS ahead FROM forms
  UNION ALL
  SELECT s.word, s.ahead, f.form FROM steps s JOIN forms f ON f.word = s.ahead
)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN steps s ON s.word = f.word AND s.ahead IS NULL
"""
