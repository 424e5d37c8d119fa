"""Byte-level BPE: ids against the library, the query's columns against plain sums over the library's ids."""

import hashlib
import random

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import SparkSession

from runledger.llm.bpe import Codec, digests

PATH = P.path("byte_bpe_50k.tiktoken")
COLUMNS = "doc_id long, text string, n_tokens string, ids_sha256 int"


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def hard_texts():
    pick = random.Random(3)
    signs = "aAsStTrRevVmMlLdD'  \t\n 　é日本0９½_.,-’🙂̀ß"
    texts = ["".join(pick.choices(signs, k=pick.randrange(40))) for _ in range(3000)]
    texts += ["".join(chr(pick.choice([pick.randrange(32, 127), pick.randrange(0x20, 0x3000), pick.randrange(0x1F300, 0x1F700)])) for _ in range(200)) for _ in range(100)]
    return [*texts, "", "  x\n\n 's", "'s", " 's", "''s", "'sx're'll", "x'S", "'re", "日本語 é🙂", "aaaaaaaaaaa" * 400, "abcab" * 3000, " " * 5000 + "b", "\n" * 500, "a" * 100_000]


def test_ids_equal_the_library_and_round_trip(codec, library):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()[:300]
    for text in [*texts, *hard_texts()]:
        ids = codec.encode(text or "")
        assert ids == library.encode_ordinary(text or "")
        assert codec.decode(ids) == (text or "").encode()


def test_other_pattern(codec):
    pattern = r"\S+|\s"
    other, library = Codec(PATH, pattern), tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})
    for text in hard_texts()[:300]:
        assert other.encode(text) == library.encode_ordinary(text)


def test_rows(library):
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    texts = [None, "", "one", "one", "one two", *hard_texts()[-16:]]
    rows = [*enumerate(texts), (None, "no id"), (2, "one")]
    got = digests(spark.createDataFrame([(d, t, "x", 1) for d, t in rows], COLUMNS), PATH)
    want = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), *(hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (t or "").encode()))))
    assert sorted(map(repr, map(tuple, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))) == sorted(map(repr, want))
    assert digests(spark.createDataFrame([], COLUMNS), PATH).collect() == []


def test_pieces_that_share_polynomial_hashes(codec, library):
    """The Thue-Morse word and its complement: alike to any polynomial modulo 2**64."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    for text in (f"{word}\n{other}", f"{other}\n{word}", other, word):
        assert codec.encode(text) == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_few_pieces_kept(library, monkeypatch):
    monkeypatch.setattr("runledger.llm.bpe.MOST_KEPT", 10)
    small = Codec(PATH)
    for text in hard_texts()[:200]:
        assert small.encode(text) == library.encode_ordinary(text)
