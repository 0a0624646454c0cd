"""Operator 2, secrets: Aho-Corasick keyword prefilter, anchored expressions at hits, checksums.

The automaton holds the keywords of assignments in every case, the prefixes of access keys and of
tokens with a checksum, and every group of four hexadecimal digits. An expression is tried only at a
hit, anchored there. Tokens that carry a CRC-32 of themselves are kept only if it agrees.

Defined results: null is an empty text; empty and very long texts are scanned whole; a repeated row
gives a repeated result; a null key is returned as null.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from seqloom.llm.common import Span, long_field, narrow, per_document, sha256, spans_text, string_field, table

#: Base kinds in the order of the contract; the others are the method's own.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "checked")
ORDER = {kind: place for place, kind in enumerate(KINDS)}

#: Keywords, and the public prefixes of tokens that end in a base-62 CRC-32.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_VALUE = re.compile(r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CHECKED = re.compile(r"[a-z]{3}_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")


def checksum(body: str) -> str:
    """CRC-32 of the random part, six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = BASE62[rest] + digits
    return digits


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in KEYWORDS:
        for form in itertools.product(*({c, c.upper()} for c in word)):
            found.add_word("".join(form), ("assign", len(word)))
    found.add_word("AKIA", ("access", 4))
    for word in CHECKED_PREFIXES:
        found.add_word(word, ("checked", len(word)))
    for digits in itertools.product("0123456789abcdef", repeat=4):
        found.add_word("".join(digits), ("hex", 4))
    found.make_automaton()
    return found


def scanner() -> Callable[[str], list[Span]]:
    """A function from a text to all its spans: (start, end, kind), code points, end exclusive."""
    keywords = automaton()

    def scan(text: str) -> list[Span]:
        spans: list[Span] = []
        done = dict.fromkeys(KINDS, 0)  # end of the last match of each kind, kept or dropped
        for last, (kind, width) in keywords.iter(text):
            start = last - width + 1
            if start < done[kind]:
                continue
            if kind == "hex":
                end = done["hex"] = _HEX.match(text, start).end()
                if end - start >= 32:
                    spans.append((start, end, "hex"))
            elif kind == "assign":
                if m := _VALUE.match(text, last + 1):
                    done["assign"] = m.end()
                    if len(m.group(1)) >= 8:
                        spans.append((start, m.end(), "assign"))
            elif kind == "access":
                if m := _ACCESS.match(text, start):
                    done["access"] = m.end()
                    if m.end() - start >= 16:
                        spans.append((start, m.end(), "access"))
            elif (m := _CHECKED.match(text, start)) and checksum(m.group(1)) == m.group(2):
                done["checked"] = m.end()
                spans.append((start, m.end(), "checked"))
        return spans

    return scan


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the number of spans of each kind, and all spans as text."""

    def prepare():
        scan = scanner()

        def work(text: str | None) -> tuple:
            spans = scan(text or "")
            base = [s for s in spans if s[2] in BASE_KINDS]
            counts = [sum(s[2] == kind for s in spans) for kind in KINDS]
            return (*counts, sha256(spans_text(base, ORDER)), spans_text(spans, ORDER))

        return work

    fields = [*(long_field(f"n_{kind}") for kind in KINDS), string_field("base_sha256"), string_field("spans")]
    return per_document(narrow(docs, id_col, text_col), prepare, fields)


def keep_clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, all their columns unchanged, whose text holds no secret."""
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            yield batch.filter(pa.array([not scan(t or "") for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
