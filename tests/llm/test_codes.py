"""Vector codes against a plain version in Python integers; trees settle whole nodes on clustered vectors."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import SparkSession

from runledger.llm import codes
from runledger.llm.codes import Tree, assign, encode, entry_tree, with_label_error


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def table(spark, rows):
    return spark.createDataFrame([(i, v, x, "a", 9) for i, v, x in rows], "vec_id long, v array<double>, label int, code string, part int").repartition(5)


def plain(rows):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    if not kept:
        return []
    wide = max(4, -(-max(len(v) for _, v, _ in kept) // 4) * 4)
    short = sorted(kept, key=lambda r: (r[0], r[1]))[:256]
    full = lambda v: v + [0] * (wide - len(v))
    cut = lambda v, p: full(v)[p * wide // 4 : (p + 1) * wide // 4]
    books = [[cut(v, p) for _, v, _ in short] for p in range(4)]
    near = lambda v, book: min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(v, book[e])), e))
    for _ in range(4):
        for p in range(4):
            met = defaultdict(list)
            for _, v, _ in kept:
                met[near(cut(v, p), books[p])].append(cut(v, p))
            for e, own in met.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, label_error = [], defaultdict(int)
    for i, v, label in kept:
        own = [near(cut(v, p), books[p]) for p in range(4)]
        error = sum((a - b) ** 2 for p in range(4) for a, b in zip(cut(v, p), books[p][own[p]]))
        label_error[label] += error
        out.append((i, "".join(f"{x:02x}" for x in own), error, label))
    return sorted((i, c, e, label_error[label], digest) for i, c, e, label in out)


def fixture(n, wide, seed):
    pick = np.random.default_rng(seed)
    centres = pick.standard_normal((9, wide))
    rows = [(int(i), (centres[i % 9] + 0.2 * pick.standard_normal(wide)).tolist(), [None, 1, 1, 1, 2][i % 5]) for i in pick.permutation(n)]
    rows += [(10_000 + i, rows[i % 3][1], 1) for i in range(90)] + [(5, rows[8][1], 3), (20_000, None, 1), (20_001, [1.0, None], 1), (20_002, [float("nan")], 1), (20_003, [float("inf")], 2), (None, [1.0], 1)]
    return rows


@pytest.mark.parametrize(("n", "wide", "block"), [(700, 12, 4096), (500, 8, 64), (100, 6, 4096)])
def test_equals_plain_version(spark, monkeypatch, n, wide, block):
    monkeypatch.setattr(codes, "BLOCK_ROWS", block)
    rows = fixture(n, wide, n) + [(30_000, [], 1), (30_001, [0.25], 7)]
    assert sorted(map(tuple, encode(table(spark, rows)).collect())) == plain(rows)


def test_empty_table_and_salted_labels(spark):
    assert encode(table(spark, [(1, [1.0], 1)]).filter("vec_id > 1")).collect() == []
    coded = spark.createDataFrame([(i, [None, 1, 2][i % 3], "0", i) for i in range(60)], "vec_id long, label long, code string, error long")
    got = [sorted(map(repr, map(tuple, with_label_error(coded, few).select("vec_id", "label", "error", "label_error").collect()))) for few in (50_000, 1)]
    assert got[0] == got[1] and len(got[0]) == 60


def test_too_large(spark):
    with pytest.raises(ValueError):
        encode(table(spark, [(1, [1e9], 1)]))


@pytest.mark.parametrize("spread", [3, 4000])
def test_trees(spread):
    pick = np.random.default_rng(2)
    entries = pick.integers(-3000, 3000, (37, 4))
    entries[30:35] = entries[20:25]
    points = entries[pick.integers(0, 37, 3000)] + pick.integers(-spread, spread + 1, (3000, 4))
    tree = Tree(points, codes.LEAF)
    code, sums, counts, settled = assign(Tree.read(tree.blob(), 3000), entries, entry_tree(entries))
    want = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
    assert (code == want[tree.order]).all()
    assert (counts == np.bincount(want, minlength=37)).all()
    assert all((sums[e] == points[want == e].sum(0)).all() for e in range(37))
    # Tight groups are settled as whole nodes, save those at equal entries.
    assert settled > 500 if spread == 3 else settled >= 0
