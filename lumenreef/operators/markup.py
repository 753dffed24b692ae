"""Contacts from HTML: one pass over the markup, so that targets and encoded addresses count and scripts do not."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Starts where a run of its characters starts, so a long run is read once.
ADDRESS = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+[.][A-Za-z]{2,}")
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
#: A name with or without the sign of a value, a stray sign, or what ends the tag.
_ATTRIBUTE = re.compile(r"[\s/]*(?:([^\s/>=]+)(\s*=\s*)?|=|(?=>)|\Z)")
_BARE = re.compile(r"[^\s>]*")
#: Elements whose content is not text of the page.
RAW = ("script", "style")


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """``("text", decoded text)`` and ``("href", decoded value)`` in the order of a page.

    Comments, declarations, tags and what scripts and styles hold are no text. A comment or script that does not end takes
    the rest of the page; a ``<`` that starts no tag is text. Every character is looked at a bounded number of times.
    """
    at, size = 0, len(page)
    last = {quote: page.rfind(quote) for quote in ("'", '"')}  # a quote that opens there or later does not close
    while at < size:
        tag = page.find("<", at)
        while tag >= 0 and not page[tag + 1 : tag + 2].isalpha() and page[tag + 1 : tag + 2] not in ("/", "!", "?"):
            tag = page.find("<", tag + 1)
        if tag != at:
            yield "text", entities.unescape(page[at:] if tag < 0 else page[at:tag])
        if tag < 0:
            return
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = size if end < 0 else end + 3
            continue
        name = _NAME.match(page, tag + 1)
        if not name:  # a closing tag or a declaration
            end = page.find(">", tag)
            at = size if end < 0 else end + 1
            continue
        kind, at = name.group().lower(), name.end()
        while at < size and page[at] != ">":
            attribute = _ATTRIBUTE.match(page, at)
            at = attribute.end()
            if not attribute.group(2):
                continue
            quote = page[at : at + 1]
            if at < last.get(quote, -1):
                end = page.find(quote, at + 1)
                value, at = page[at + 1 : end], end + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare.group(), bare.end()
            if attribute.group(1).lower() == "href":
                yield "href", entities.unescape(value)
        at += 1
        if kind in RAW:
            end = _closing(page, kind, at)
            at = size if end < 0 else end


_CLOSING = {kind: re.compile(f"</{kind}", re.I) for kind in RAW}


def _closing(page: str, kind: str, at: int) -> int:
    found = _CLOSING[kind].search(page, at)
    return found.start() if found else -1


def addresses(page: str) -> list[tuple[str, str]]:
    """``(place, address)`` of a page: ``mailto`` for the targets of such links, ``text`` for addresses that are shown."""
    found = []
    for kind, value in tokens(page):
        if kind == "text":
            if "@" in value:
                found += [("text", a) for a in ADDRESS.findall(value)]
        elif value[:7].lower() == "mailto:":
            for one in unquote(value[7:].partition("?")[0]).split(","):
                if ADDRESS.fullmatch(one.strip()):
                    found.append(("mailto", one.strip()))
    return found


def contacts_in(rows: DataFrame, key: str, page: str) -> DataFrame:
    """``key, lugar, email``: every address that a page shows or links to, repeats included. Null pages have none."""
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("lugar", T.StringType()), T.StructField("email", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, places, emails = [], [], []
            for i, text in enumerate(batch.column("_page")):
                for place, email in addresses(text.as_py()):
                    of.append(i)
                    places.append(place)
                    emails.append(email)
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(of, pa.int64())), pa.array(places, pa.string()), pa.array(emails, pa.string())], names=[key, "lugar", "email"])

    # A page without an address sign, plain or encoded, is not sent to Python.
    signed = F.col(page).rlike("(?i)@|&#0*64;?|&#x0*40;?|&commat;|%40")
    return rows.where(signed).select(key, F.col(page).alias("_page")).mapInArrow(run, schema)
