"""Personal data and secrets against plain expressions over whole texts."""

import hashlib
import random
import re

import pytest

from seqloom.llm import pii, secret_scan
from seqloom.llm.pii import luhn

PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")),
    ),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        lambda m: 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d),
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
}
SECRETS = {
    "assign": (
        r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        lambda m: len(m[1]) >= 8,
    ),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
}
PIECES = {
    "pii": ["a", "b.c", "@", "@x.y", "+", "+4", "1", "12", "4111 1111-1111 1111", ".", " ", "-", "(", ")", "300", "1.2.3.4",
            "é", "İ", "iban ", "http://", "account: 1234567 ", "1" * 13, "\n"],
    "secret": ["password", "ToKeN", "api_key", "apikey", "ſecret", "secret", "=", ":", " ", '"', "'", "abcd1234", "AKIA",
               "ABCDEFGH1234", "deadbeef" * 4, "deadbeef", "f", "é", "\n", "x", "ghp_"],
}


def plain(rules, text):
    found = []
    for place, (kind, (pattern, good)) in enumerate(rules.items()):
        found += [(m.start(), place, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if good(m)]
    return [s for *_, s in sorted(found)]


def texts(kind, count):
    draw = random.Random(kind)
    made = ["".join(draw.choices(PIECES[kind], k=draw.choice([1, 4, 12, 60]))) for _ in range(count)]
    return [None, "", *made, "9" * 6000, "1." * 4000, "a@" * 4000, "+1 " * 4000, " ".join(made) * 3]


@pytest.mark.parametrize(
    ("kind", "rules", "find"), [("pii", PII, pii.find_pii), ("secret", SECRETS, secret_scan.find_secrets)]
)
def test_base_spans_are_those_of_the_expressions(spark, kind, rules, find):
    rows = [(None if n == 3 else n, t, "clash") for n, t in enumerate(texts(kind, 400))]
    rows.append(rows[5])
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = find(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for key, text, _ in rows:
        row, expected = by_id[key], plain(rules, text or "")
        assert row.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), text
        for name in rules:
            assert row[f"n_{name}"] == sum(s.startswith(name + ":") for s in expected)
        spans = [s for s in row.spans.split(",") if s]
        assert [s for s in spans if s.split(":")[0] in rules] == expected
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)


def test_added_spans():
    scan = pii.scanner()
    text = "IBAN: GB82 WEST 1234 5698 7654 32 see https://user@host.org:80/a?b=1. IBAN GB83 WEST 1234 5698 7654 32"
    assert [(text[a:b], k) for a, b, k in scan(text) if k not in pii.BASE_KINDS] == [
        ("GB82 WEST 1234 5698 7654 32", "account"),
        ("https://user@host.org:80/a?b=1", "url"),
    ]
    body = "0123456789abcdefghijABCDEFGHIJ"
    good = "ghp_" + body + secret_scan.checksum(body)
    assert [k for *_, k in secret_scan.scanner()(good)] == ["checked"]
    assert secret_scan.scanner()(good[:-1] + ("1" if good[-1] == "0" else "0")) == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(none).count() == secret_scan.find_secrets(none).count() == 0
