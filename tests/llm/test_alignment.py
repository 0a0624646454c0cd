"""Token alignment against plain loops over the bytes, with the libraries of both vocabularies."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from seqloom.llm import alignment
from seqloom.llm.bpe import _byte_of_char


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain_tokens(libraries, text):
    """(id, first byte, end) of both sides."""
    a, b = libraries
    byte = _byte_of_char()
    if not text:
        return [], []
    raw, sides = (" " + text).encode(), []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    sides.append([(i, bytes(byte[c] for c in a.id_to_token(i))) for i in ids])
    pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
    sides.append([(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces])
    if any(b"".join(p for _, p in side) != raw for side in sides):
        return [], []
    found = []
    for side in sides:
        at, own = 0, []
        for i, p in side:
            own.append((i, at, at + len(p)))
            at += len(p)
        found.append(own)
    return found


def plain_rows(libraries, texts):
    tokens = [plain_tokens(libraries, text) for text in texts]
    links = [[(x[0], y[0]) for x in a for y in b if x[2] == y[2]] for a, b in tokens]
    count = Counter(pair for own in links for pair in own)
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    for (a, b), own in zip(tokens, links, strict=True):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        inside = lambda side, lo, hi: ",".join(str(t[0]) for t in side if lo < t[2] <= hi)
        shown = ";".join(f"{inside(a, lo, hi)}|{inside(b, lo, hi)}" for lo, hi in zip([0, *cuts], cuts, strict=False))
        overlaps = sum(max(x[1], y[1]) < min(x[2], y[2]) for x in a for y in b)
        shared = sum(sum(lo < x[2] <= hi for x in a) * sum(lo < y[2] <= hi for y in b) for lo, hi in zip([0, *cuts], cuts, strict=False))
        digest = hashlib.sha256(shown.encode()).hexdigest() if a else ""
        best = sum(count[p] == highest[p[1]] for p in own)
        yield len(a), len(b), len(cuts), len(own), best, sum(count[p] for p in own), digest, overlaps, shared


def texts():
    draw = random.Random(6)
    made = [None, "", " ", "  a", "a▁b", "<|endoftext|> <s> </s> <0x41>", "\x00\x01", "é中文 😀🇩🇪", "don't\n\n\tstop", "ﬁ Å"]
    for n in range(60):
        letters = draw.choice(["ab ", "the an in ", "éà ü ", "中文 a", "0123 9", "\n\t  \r a", "#$% |", "aeiounrst  "])
        made.append("".join(draw.choices(letters, k=draw.choice([1, 8, 60, 300]))))
    made.append(" ".join(draw.choices(["transformers", "tokenization", "sparse", "matrices", "Gustavson", "über"], k=300)))
    return made


def test_products_are_those_of_dense_matrices():
    draw = np.random.default_rng(0)
    for most in (1, 7, 1 << 20):
        x, y = draw.random((9, 14)) < 0.3, draw.random((11, 14)) < 0.3
        made = [alignment.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], 14) for m in (x, y)]
        dense = np.zeros((9, 11), int)
        for rows, columns, values in made[0].product(made[1].transposed(), most):
            dense[rows, columns] += values
        assert (dense == x.astype(int) @ y.astype(int).T).all()
        assert (made[0].terms(made[1].transposed()) == (x.astype(int) @ y.astype(int).T).sum(1)).all()


def test_query(spark, tmp_path, libraries):
    made = texts()
    rows = [(n, t, 1) for n, t in enumerate(made)] + [(None, made[12], 1), (3, made[3], 1)]
    spark.createDataFrame(rows, "doc_id long, text string, pairs int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256 n_overlaps n_shared".split()
    got = alignment.op12_token_alignment(spark, str(tmp_path)).select(*names).collect()
    wanted = [(key, *row) for (key, *_), row in zip(rows, plain_rows(libraries, [t for _, t, _ in rows]), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    empty = alignment.written(alignment.alignments(docs.limit(0)), "none")
    assert alignment.with_corpus_counts(empty, 32_000).count() == 0


@pytest.mark.parametrize("kind", ["overlap", "shared"])
def test_links(spark, libraries, kind):
    made = texts()[:30]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {(r.doc_id, r.place_a, r.place_b, r.id_a, r.id_b, r.value) for r in alignment.token_links(docs, kind).collect()}
    wanted = set()
    for key, text in enumerate(made):
        a, b = plain_tokens(libraries, text)
        cuts = {x[2] for x in a} & {y[2] for y in b}
        group = lambda t, cuts=cuts: sum(c < t[2] for c in cuts)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                value = min(x[2], y[2]) - max(x[1], y[1]) if kind == "overlap" else int(group(x) == group(y))
                if value > 0:
                    wanted.add((key, i, j, x[0], y[0], value))
    assert got == wanted


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(0, "transformers align"), (1, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in alignment.alignments(docs, with_groups=True).collect()}
    assert rows[0].groups.count("|") == rows[0].n_groups and rows[1].groups == ""
    assert rows[0].groups_sha256 == hashlib.sha256(rows[0].groups.encode()).hexdigest()


def test_a_long_text_of_one_group_stays_small():
    aligner = alignment.Aligner()
    found = next(aligner.align(["0123456789" * 30_000]))
    assert len(found.a) and found.n_overlaps <= len(found.a) + len(found.b)
