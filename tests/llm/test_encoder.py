"""The packing operator's ids equal the tokenizers library's."""

import random

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

from runledger.llm.packing import encoder


def test_ids_equal_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, ids_of = Tokenizer.from_file(path), encoder(path)
    pick = random.Random(1)
    texts = [r[0] or "" for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    texts += ["", " ", "it's IT'S  \n\n x", "a\xa0b  c\x85d  x", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "\x1cfoo\x1f", "a" * 300_000, " " * 300_000 + "b", "\n" * 100_000]
    texts += ["".join(chr(pick.choice([pick.randrange(32, 127), pick.randrange(0x20, 0x3000), pick.randrange(0x1F300, 0x1F700)])) for _ in range(200)) for _ in range(300)]
    assert [ids_of(t) for t in texts] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
