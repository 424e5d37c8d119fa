"""The exchange of counts: direct or by teams of blocks, in rows that grow with the blocks, whatever order the input comes in."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.llm import counts, lm

COLUMNS = "doc_id long, text string"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def corpus(n: int) -> list[tuple]:
    pick = random.Random(3)
    words = ["".join(pick.choices("abcdefgh", k=3)) for _ in range(500)]
    return [(i, " ".join(pick.choices(words, k=30))) for i in range(n)] + [(None, "null id"), (-1, None), (-2, "hot " * 2000), (-2, "hot " * 2000)]


def result(df):
    return sorted((-9 if r["doc_id"] is None else r["doc_id"], *r[1:5], round(r["base_score"], 6), round(r["score"], 6)) for r in df.collect())


def test_teams_of_blocks_give_the_scores_of_one_block(spark):
    docs = spark.createDataFrame(corpus(300), COLUMNS).repartition(3).cache()
    want = result(lm.score(docs, block_bytes=1 << 24))
    assert len(want) == 304
    for fan in (2, 5, 1 << 20):
        assert result(lm.score(docs, block_bytes=2000, fan=fan)) == want
    docs.unpersist()


def test_scores_hold_when_the_input_comes_in_another_order_at_each_reading(spark):
    data = spark.createDataFrame(corpus(200), COLUMNS).repartition(3)
    assert result(lm.score(data.orderBy(F.rand()), block_bytes=2000)) == result(lm.score(data, block_bytes=1 << 24))


def rows_sent(spark, monkeypatch, blocks: int, fan: int) -> int:
    """Messages of all levels for so many blocks, each of the same 200 keys at random, with two parts a block."""
    n, kept = [], counts.materialize
    parts = 2 * blocks
    cut = counts.ranges(parts, fan)

    def send(batches):
        import numpy as np

        for batch in batches:
            for block in batch.column(0).to_pylist():
                keys = np.unique(np.random.default_rng(block).integers(1, 1 << 62, 200, dtype=np.uint64) << np.uint64(1))
                yield from counts.messages(block, 0, keys, np.ones(len(keys), np.int64), 0, cut, cut).to_batches()

    def counting(df, what):
        out = kept(df, what)
        n.append(out.filter("block <> -1").count())
        return out

    monkeypatch.setattr(counts, "materialize", counting)
    answers, total, _ = counts.elsewhere(spark.range(blocks).mapInArrow(send, counts.MESSAGE), parts, fan, 0)
    assert total == blocks * 200 and answers.agg(F.sum("n")).first()[0] == total
    monkeypatch.setattr(counts, "materialize", kept)
    return sum(n)


def test_rows_grow_with_the_blocks(spark, monkeypatch):
    small, large = (rows_sent(spark, monkeypatch, b, 8) for b in (32, 128))
    assert small <= 32 * (8 + 8) and large <= 128 * (8 + 32)
    assert rows_sent(spark, monkeypatch, 128, 1 << 20) > 2 * large


def test_messages_cut_where_ranges_end():
    import numpy as np

    keys = np.array([1, (1 << 61) - 1, 1 << 61, 1 << 62, (1 << 63) - 1], np.uint64)
    table = counts.messages(7, 0, keys, np.arange(5), 0, 4, 4)
    assert table.column("part").to_pylist() == [0, 1, 2, 3]
    assert [np.cumsum(counts.unpacked(x), dtype=np.uint64).tolist() for x in table.column("own").to_pylist()] == [[1, (1 << 61) - 1], [1 << 61], [1 << 62], [(1 << 63) - 1]]
    assert isinstance(table, pa.Table)
