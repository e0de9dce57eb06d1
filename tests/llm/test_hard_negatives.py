"""Hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nodecast.llm import hard_negatives as hn


def plain(rows, every=50, positives=5, negatives=3):
    """(anchor, positive, rank, negative, scores) from whole-number products."""
    usable = []
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v and all(map(math.isfinite, v)):
            usable.append((i, label, [math.floor(256 * x) for x in v]))
    found = []
    for a, (i, label, q) in enumerate(usable):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, w)), j, l) for b, (j, l, w) in enumerate(usable) if b != a]
        for p, j, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fit = sorted(s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p)
            found += [(i, j, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(fit[:negatives])]
    return sorted(found)


def mined(spark, rows, kind="double", **options):
    frame = spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>")
    frame = frame.withColumn("row", F.lit("x")).withColumn("score", F.lit(0))
    return sorted(map(tuple, hn.mine(frame, F.col("id") % 50 == 0, **options).collect()))


def vectors(n, width, seed, labels=4):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(3, width))
    x = centre[rnd.integers(0, 3, n)] + 0.7 * rnd.normal(size=(n, width))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return [(i, int(l), v.tolist()) for i, l, v in zip(range(n), rnd.integers(0, labels, n), x)]


def test_tables_and_planes_give_inner_products():
    rnd = np.random.default_rng(1)
    for width in (1, 7, 8, 9, 64):
        for top in (1, 3, 256, 70_000):
            c, a = rnd.integers(-top, top + 1, (700, width)), rnd.integers(-top, top + 1, (70, width))
            kind = hn.number_kind(c, a)
            assert (hn.look_up(hn.planes(c), hn.subset_sums(a).astype(kind)) == c @ a.T).all()
    edge = np.array([[-256, 255], [-1, 0]])
    assert hn.look_up(hn.planes(edge), hn.subset_sums(edge)).tolist() == (edge @ edge.T).tolist()
    with pytest.raises(OverflowError):
        hn.number_kind(np.array([[1 << 40]]), np.array([[1 << 40]]))


def test_all_scores_are_compared(spark):
    rows = vectors(1200, 64, 2)
    assert mined(spark, rows) == plain(rows) and len(plain(rows)) > 200


def test_slices_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(hn, "SLICE", 3)
    rnd = random.Random(4)
    few = [[rnd.randrange(-2, 3) / 4 for _ in range(9)] for _ in range(12)]  # many equal scores
    rows = [(i, rnd.randrange(3), rnd.choice(few)) for i in range(600)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, positives=2, negatives=9) == plain(rows, positives=2, negatives=9)


def test_a_hot_vector(spark):
    """A third of the rows are one vector, with one label."""
    rows = vectors(900, 16, 6)
    rows = [(i, 1, rows[0][2]) if i % 3 == 0 else r for i, r in enumerate(rows)]
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    good = [0.5, 0.25, -0.5, 0.1]
    rows = [(0, 1, good), (0, 1, good), (50, 1, good), (50, 2, [0.4, 0.2, -0.4]), (1, 1, [0.5, 0.3, -0.4, 0.1]), (2, 2, [0.4, 0.2, -0.4, 0.1]),
            (3, 2, [0.4, 0.2, -0.4, 0.1, 9.0]), (4, 2, []), (5, None, good), (6, 1, None), (7, 1, [None, 1.0, 1.0, 1.0]),
            (8, 2, [math.nan] * 4), (9, 2, [math.inf, 0.0, 0.0, 0.0]), (None, 2, good), (10, 3, [0.0] * 4), (-50, 3, [0.0] * 4),
            (100, 3, [-x for x in good])]
    assert mined(spark, rows) == plain(rows) and plain(rows)
    assert mined(spark, rows, "float") == plain([(i, l, v and [x if x is None else float(np.float32(x)) for x in v]) for i, l, v in rows])
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, good)]) == []
    assert mined(spark, [(0, 1, good)]) == []


def test_scores_beyond_64_bits_are_an_error(spark):
    rows = [(0, 1, [1e17]), (1, 1, [1e17]), (2, 2, [1e17])]
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, rows)
