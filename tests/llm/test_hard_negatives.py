"""Hard negatives against all pairs, and the bounds that let pairs be skipped."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakezones.llm import hard_negatives as H
from lakezones.llm.shipping import prepared

ITEMS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("a.b", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)


def brute_force(rows, positives=5, negatives=5, low=80, high=100):
    """The same rows from all pairs; ids divisible by 10 are anchors."""
    used = {}
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        while whole and whole[-1] == 0:
            whole.pop()
        used[(vec_id, tuple(whole), label)] = None
    used = list(used)

    def score(a, b):
        return sum(x * y for x, y in zip(a[1], b[1]))

    def first(candidates, most):
        # Rows of one id and label are told apart by their scores alone in these fixtures.
        return sorted(candidates, key=lambda one: (-one[0], one[1][0] is None, one[1][0] or 0))[:most]

    found = []
    for anchor in used:
        if anchor[0] is None or anchor[0] % 10:
            continue
        others = [(score(anchor, row), row) for row in used if row is not anchor]
        best = first([one for one in others if one[1][2] == anchor[2]], positives)
        for wanted, positive in best:
            fitting = [o for o in others if o[1][2] != anchor[2] and low * wanted <= 100 * o[0] <= high * wanted]
            for rank, (value, negative) in enumerate(first(fitting, negatives), 1):
                found.append((anchor[0], positive[0], rank, negative[0], wanted, value))
    return sorted(found, key=str)


def mined(spark, rows, partitions=3, **options):
    prepared(spark)
    full = [(i, v, label, "x", "y") for i, v, label in rows]
    items = spark.createDataFrame(full, ITEMS).repartition(partitions)
    result = H.mine_hard_negatives(items, F.col("vec_id") % 10 == 0, **options)
    assert result.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, result.collect()), key=str)


def clustered(count, width, seed, noise, labels=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(labels, width))
    rows = []
    for i in range(count):
        label = int(rng.integers(labels))
        center = centers[int(rng.integers(labels))]
        rows.append((i, [float(x) for x in center / 4 + noise * rng.normal(size=width)], label))
    return rows


@pytest.mark.parametrize("noise", [0.02, 0.3])
def test_against_all_pairs(spark, noise):
    rows = clustered(240, 12, 3, noise)
    # Very many rows share a vector, so that scores tie.
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(60)]
    found = mined(spark, rows, slab_rows=70, block_rows=16, anchor_rows=8)
    assert found == brute_force(rows)
    assert len(found) > 300


def test_one_label_has_most_rows(spark):
    rows = [(i, vector, 0 if i % 3 else label) for i, vector, label in clustered(150, 6, 5, 0.2)]
    assert mined(spark, rows, slab_rows=20, block_rows=8, anchor_rows=4) == brute_force(rows)


def test_every_row_has_a_label_of_its_own_or_one_other(spark):
    rows = [(i, vector, i // 2) for i, vector, _ in clustered(80, 6, 7, 0.2)]
    assert mined(spark, rows, slab_rows=20, block_rows=8, anchor_rows=4) == brute_force(rows)


def test_edge_rows(spark):
    nan, infinite = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.25], 1), (0, [0.5, 0.25], 1), (1, [0.5, 0.2], 1), (2, [0.45, 0.25], 2), (3, [0.45, 0.25], 3),
        (4, None, 1), (5, [0.5, None], 1), (6, [nan, 1.0], 2), (7, [infinite, 1.0], 2), (8, [0.5, 0.25], None),
        (10, [0.5, 0.25, 0.125], 2), (11, [0.5], 2), (12, [], 2), (20, [0.0, 0.0], 3), (21, [-0.5, -0.25], 3),
        (None, [0.45, 0.26], 2), (None, [0.4, 0.26], 1), (30, [-1.0, -1.0], 5), (31, [1.0, 1.0], 5),
    ]
    found = mined(spark, rows, slab_rows=4, block_rows=2, anchor_rows=2)
    assert found == brute_force(rows)
    # The anchor 30 has one positive with a score below zero, which no score can be 80 percent of.
    assert {row[0] for row in found} == {0, 10, 20}


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, None, 1), (20, [1.0], None)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_large_components_stay_exact(spark):
    # Products beyond what a floating point number holds exactly.
    rows = [(10 * i, [float(2**20 + i), float(2**19), 1.0], i % 2) for i in range(12)]
    found = mined(spark, rows, slab_rows=5, block_rows=4, anchor_rows=4)
    assert found == brute_force(rows)
    assert max(row[5] for row in found) > 2**53
    # Scores of such a row would not fit into 64 bits.
    assert mined(spark, rows + [(5, [3e38, 0.0, 0.0], 0)], slab_rows=5) == found


def test_bounds_hold_every_score():
    rng = np.random.default_rng(11)
    for width, count in ((2, 1), (8, 5), (64, 16)):
        vectors = [np.floor(256 * rng.normal(size=width) * rng.choice([0.01, 1, 100])) for _ in range(60)]
        vectors += [np.zeros(width), vectors[0] * 3, -vectors[0]]
        code = H.Code(H.spread(vectors[:20], count), 1)
        rows = []
        for i, vector in enumerate(vectors):
            packed, key, squared, angles, nearest, angle = code._one(vector)
            rows.append({"vec_id": i, "label": i % 3, "vector": packed, "key": key, "squared": squared, "angles": angles})
        block = H.Block(H.Pack(100)._packed(0, 0, rows).to_pylist()[0])
        everyone = np.arange(len(vectors))
        exact = H.scores(block, block, everyone, everyone)
        assert (exact == np.array([[int(a @ b) for b in vectors] for a in vectors])).all()
        low, high = H.row_bounds(block, block, everyone)
        assert (low <= exact).all() and (exact <= high).all()
        assert (exact <= H.block_bounds(block, block)[:, None]).all()


def test_references_spare_scores():
    """Of well separated directions most rows are never scored."""
    rng = np.random.default_rng(1)
    centers = 256 * rng.normal(size=(20, 16))
    vectors = [np.floor(centers[i % 20] + 4 * rng.normal(size=16)) for i in range(400)]
    code = H.Code(H.spread(vectors[:100], 16), 1)
    rows = [
        dict(zip(("vector", "key", "squared", "angles"), code._one(vector)), vec_id=i, label=i % 20)
        for i, vector in enumerate(vectors)
    ]
    block = H.Block(H.Pack(1000)._packed(0, 0, rows).to_pylist()[0])
    everyone = np.arange(400)
    exact = H.scores(block, block, everyone, everyone)
    _, high = H.row_bounds(block, block, everyone)
    best = np.sort(exact, axis=1)[:, -5]
    assert (high >= best[:, None]).mean() < 0.15


def test_windows():
    assert H.window(100, 80, 100) == (80, 100)
    assert H.window(101, 80, 100) == (81, 101)
    assert H.window(0, 80, 100) == (0, 0)
    least, greatest = H.window(-100, 80, 100)
    assert least > greatest
