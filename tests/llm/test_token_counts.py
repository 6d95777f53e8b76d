"""Token counts against the library's own encoding of whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sensorflow.llm.token_counts import Counter, count_tokens

from .helpers import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = ["a", "B", "é", "漢", "\U0001f600", " ", "  ", "\n", "\n\n", "\t", "'s", "'re", "'LL", "'", "12", "½", "!?", "-",
         "the", "ing", "\x00", "\x85", "­", "​", "　", "<|endoftext|>", "<|end", "of|>", ".", ", ", "ß", "é",
         "don't", " word", " word", " Haus", ".\nAnd"]


def odd(rng, n):
    return "".join(rng.choice(SIGNS) for _ in range(n))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda t: len(tokenizer.encode(t, add_special_tokens=False))


@pytest.fixture(scope="module")
def data():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


@pytest.mark.parametrize("chunk,overlap", [(64, 20), (50, 17), (200, 60), (33, 1)])
def test_spliced_chunks_equal_whole_texts(library, data, chunk, overlap):
    rng = random.Random(chunk)
    counter = Counter(data, chunk, overlap, cached_units=100)
    for _ in range(250):
        t = odd(rng, rng.randint(0, 160))
        assert counter.count(t) == library(t), repr(t)


def test_runs_longer_than_a_chunk_widen_the_overlap(library, data):
    counter = Counter(data, 64, 20)
    for t in ("a" * 5_000, " " * 3_000 + "x", "x" + "\n" * 2_000, "=" * 1_500, "ab " * 900, "漢" * 1_200, "12" * 700,
              "w " + "b" * 900 + " end " + "c" * 900, " \n" * 700 + "<|endoftext|>" * 90, "é" * 999 + "'re"):
        assert counter.count(t) == library(t), t[:20]


def test_a_long_run_is_read_in_linear_work(data):
    counter, read = Counter(data, 64, 20), []
    encode = counter.encode
    counter.encode = lambda t, a, b: read.append(b - a) or encode(t, a, b)
    counter.count("a" * 100_000)
    assert sum(read) < 8 * 100_000


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        counter = Counter(f.read(), 32, 8)
    t = "Some  Words\n" * 40
    assert not counter.local
    assert counter.counts([t, ""]) == [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False)), 0]


def test_operator_on_odd_rows(spark, library):
    rng = random.Random(7)
    texts = [None, "", " ", "<|endoftext|>", odd(rng, 30_000), "word " * 30_000, *[odd(rng, 40) for _ in range(40)]]
    rows = [*enumerate(texts), (None, "null id"), (3, "<|endoftext|>")]
    got = count_tokens(documents(spark, rows, clashing=True), PATH, chunk_chars=500, overlap_chars=40).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(
        (str(i), len((t or "").encode()), library(t or ""), library(t or "") > 1024) for i, t in rows)
    assert got[0].__fields__ == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert count_tokens(documents(spark, []), PATH).count() == 0


def test_given_documents_equal_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, PATH, chunk_chars=3_000, overlap_chars=100).collect()}
    assert got == {r["doc_id"]: library(r["text"] or "") for r in docs.collect()}
