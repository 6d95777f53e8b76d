"""Byte-level BPE against the tokenizer library."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from sensorflow.llm import bpe

from .helpers import documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def odd_texts(rng):
    signs = ["a", "B", "é", "漢", "\U0001f600", " ", "  ", "\n", "\t", "'s", "'LL", "12", "½", "!?", "-", "the", "ing",
             "\x00", "\x85", "­", "​"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    return texts + ["", None, " ", "   \n", "a" * 95, "a" * 97, "ab" * 3_000, "=" * 5_000, "<|endoftext|>",
                    "word " * 20_000, " leading", "trailing  "]


def test_round_trip_equals_the_library(spark, library):
    encoding, _ = library
    texts = odd_texts(random.Random(1))
    rows = [*enumerate(texts), (None, "null id"), (3, texts[3])]
    got = bpe.bpe_round_trip(documents(spark, rows, clashing=True), VOCABULARY, public_tokenizers.PATTERN,
                             carry=("text",)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        ids = [i for p in bpe.regex.findall(public_tokenizers.PATTERN, text) for i in encoding._encode_single_piece(p.encode())]
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids), repr(text[:80])
        assert bytes(r["decoded"]) == text.encode()
    assert bpe.bpe_round_trip(documents(spark, []), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_heap_and_query_contract_alike(library):
    encoding, ranks = library
    rng = random.Random(2)
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    pieces = ["".join(rng.choice("abcdeiounst' é") for _ in range(rng.randint(1, 90))).encode() for _ in range(300)]
    expected = [bpe.pack(encoding._encode_single_piece(p)) for p in pieces]
    assert codec.encode_pieces(pieces) == expected
    assert [bpe.pack(bpe.contract(p, ranks)) for p in pieces if p not in ranks] == [
        e for p, e in zip(pieces, expected) if p not in ranks]
    assert codec.decode(expected) == pieces


def test_small_bounds_change_nothing(library):
    _, ranks = library
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN, cached_pieces=20, query_rows=50)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("xyz") for _ in range(4)) for _ in range(30)) for _ in range(12)]
    whole = bpe.Codec(ranks, public_tokenizers.PATTERN).both(texts)
    assert [codec.both([t])[0] for t in texts] == whole
