"""Operator 1, personal data: Aho-Corasick anchors, local parsers around them.

One automaton per task finds at-signs, plus signs, digits, URL schemes and the cue words of account
numbers. Each anchor is expanded by the parser of its kind, which decides the bounds from the
characters next to it and validates what it found. Parsers never look back past the previous match
of their kind and never retry a failed one, so that all work is linear in the text.

Defined results: null is an empty text; empty texts, unknown languages and texts of any length are
scanned whole; a repeated row gives a repeated result; a null key is returned as null.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqloom.llm.common import Span, long_field, narrow, per_document, sha256, spans_text, string_field, table

#: The base kinds in the order of the contract; the others are the method's own.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
ORDER = {kind: place for place, kind in enumerate(KINDS)}

#: URL schemes and the words that announce an account number.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "mailto:", "tel:")
CUES = ("iban", "account number", "account no", "account", "acct", "passport", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AUTHORITY = re.compile(r"[^\s<>\"'`|{}\\^]+")
_HOST = re.compile(r"(?:[^/?#@]*@)?(\[[0-9A-Fa-f:.]+\]|[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?)(?::[0-9]{1,5})?(?:[/?#]|$)")
_NUMBER = re.compile(r"[\x20:#.=-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}|[0-9](?:[\x20-]?[0-9]){5,16})(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def iban(number: str) -> bool:
    """ISO 13616: country and check digits to the end, letters as 10 to 35, remainder 1 by 97."""
    return 15 <= len(number) <= 34 and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _case_forms(word: str) -> set[str]:
    return {word, word.upper(), word.capitalize(), word.title()}


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for sign, kind in (("@", "at"), ("+", "plus"), *((str(d), "digit") for d in range(10))):
        found.add_word(sign, (kind, 1))
    for words, kind in ((SCHEMES, "scheme"), (CUES, "cue")):
        for word in words:
            for form in _case_forms(word):
                found.add_word(form, (kind, len(word)))
    found.make_automaton()
    return found


def scanner() -> Callable[[str], list[Span]]:
    """A function from a text to all its spans: (start, end, kind), code points, end exclusive."""
    anchors = automaton()

    def scan(text: str) -> list[Span]:
        spans: list[Span] = []
        done = dict.fromkeys(KINDS, 0)  # end of the last match of each kind, kept or dropped
        run_end = 0  # end of the digit run already parsed
        for last, (kind, width) in anchors.iter(text):
            start = last - width + 1
            if kind == "digit":
                if start < run_end:
                    continue
                run_end = _DIGITS.match(text, start).end()
                if start >= done["ip"] and (m := _DOTTED.match(text, start)):
                    done["ip"] = m.end()
                    if all(map(_octet, m.group().split("."))):
                        spans.append((start, m.end(), "ip"))
                if start >= done["card"] and (m := _GROUPED.match(text, start)):
                    done["card"] = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans.append((start, m.end(), "card"))
            elif kind == "plus":
                if start >= done["phone"] and (m := _DIALLED.match(text, start)):
                    done["phone"] = m.end()
                    if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                        spans.append((start, m.end(), "phone"))
            elif kind == "at":
                first = start
                while first > done["email"] and text[first - 1] in _LOCAL:
                    first -= 1
                if first < start and (m := _DOMAIN.match(text, start + 1)):
                    done["email"] = m.end()
                    spans.append((first, m.end(), "email"))
            elif kind == "scheme":
                if start >= done["url"] and (m := _AUTHORITY.match(text, last + 1)):
                    end = last + 1 + len(m.group().rstrip(".,;:!?)]"))
                    if text[last] != "/" or _HOST.match(text[last + 1 : end]):
                        done["url"] = end
                        if end > last + 1:
                            spans.append((start, end, "url"))
            elif start >= done["account"] and not text[start - 1 : start].isalnum():
                if m := _NUMBER.match(text, last + 1):
                    number = m.group(1).replace(" ", "").replace("-", "")
                    if number[0].isdigit() or iban(number):
                        done["account"] = m.end(1)
                        spans.append((m.start(1), m.end(1), "account"))
        return spans

    return scan


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
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


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
