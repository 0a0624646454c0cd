"""Byte-pair encoding against the library of the vocabulary file."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seqloom.llm import bpe

ALPHABETS = ["ab", "the an in", "éà ü 't's", "中文 a", "01 9", "\n\t  \r a", "#$% |", "aeiounrst", "\x1c\x1d\x85  a'll", "😀🇩🇪 x"]


def texts(count, seed):
    draw = random.Random(seed)
    for n in range(count):
        letters = draw.choice(ALPHABETS)
        text = "".join(draw.choices(letters, k=draw.choice([1, 5, 50, 300, 4000])))
        yield text[:20] + "<|endoftext|>" * (n % 7 == 0) + text[20:]


@pytest.mark.parametrize("leaf", [3, 16, 512])
def test_ids_and_decoding_are_those_of_the_library(leaf):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    codec = bpe.Codec.of(None, leaf)
    for text in ["", *texts(120, leaf)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_a_tree_of_many_leaves_equals_one_piece():
    codec = bpe.Codec.of(None, 64)
    text = "".join(random.Random(1).choices("etaoinshrdlu", k=200_000))
    assert codec.encode(text) == codec.piece(text.encode())


def test_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(0, None, 1), (None, "", 2), (2, "a b" * 9000, 3), (2, "a b" * 9000, 3), (4, "x" * 50_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = bpe.round_trip(docs)
    assert found.count() == 5
    by_id = {key: text for key, text, _ in rows}
    for row in found.collect():
        text = by_id[row.doc_id]
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0)).count() == 0
    assert {len(r.ids) for r in bpe.encode_documents(docs).collect()} == {r.n_tokens for r in found.collect()}
