"""op6's rows against plain cutting with the library's ids, for null, empty, long, repeated and id-less texts and clashing columns."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

from runledger.llm.packing import pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def pieces(text, library):
    ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
    first = (len(ids) - 1) % 1024 + 1
    borders = [0, *range(first, len(ids), 1024), len(ids)]
    return [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(borders, borders[1:]))]


def test_rows_equal_plain_cutting():
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    texts = [None, "", " ", "a", "日本語 ÉÀ̀ \r\n\t x", "12345 don't", "word " * 1022, "word " * 1023, "word " * 1024, "long text " * 9000, "z" * 30000]
    texts += [f"sentence {i} of a text " * (i % 90 + 1) for i in range(200)]
    data = [*enumerate(texts), (8, texts[8]), (8, "another text"), (None, "no id"), (None, texts[9])]
    docs = spark.createDataFrame([(d, t, 1, "x", 3) for d, t in data], "doc_id long, text string, piece int, offset string, length long").repartition(4)
    library = Tokenizer.from_file(PATH)
    got = pack(docs, PATH).collect()
    want = Counter((d, *p) for d, t in data for p in pieces(t, library))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) <= 1024
    assert len(places) <= -(-sum(r["length"] for r in got) // 1024) * 1.03 + 1
