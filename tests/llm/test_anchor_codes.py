"""Vector codes against plain rounds over all points and entries."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from sensorstar.llm import anchor_codes

ROW = "vec_id long, label int, vector array<bigint>, code string, entry int"


def plain(rows):
    """Every point with every entry, round by round."""
    rows = [r for r in rows if r[2] is not None]
    width = max((-(-len(r[2]) // 4) for r in rows), default=0)
    vectors = np.array([r[2] + [0] * (4 * width - len(r[2])) for r in rows], np.int64).reshape(len(rows), 4 * width)
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, rows[n][2]))[:256]
    codes, errors, numbers = [""] * len(rows), np.zeros(len(rows), np.int64), []
    for part in range(4):
        points = vectors[:, part * width : (part + 1) * width]
        book = points[order].copy()
        for turn in range(5):
            distance = ((points[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
            nearest = distance.argmin(axis=1) if len(rows) else np.array([], int)
            if turn < 4:
                for entry in set(nearest.tolist()):
                    mine = points[nearest == entry]
                    book[entry] = [int(s) // len(mine) for s in mine.sum(axis=0)]
        codes = [code + f"{n:02x}" for code, n in zip(codes, nearest, strict=True)]
        errors += distance.min(axis=1) if len(rows) else 0
        numbers += book.ravel().tolist()
    per_label = Counter()
    for row, error in zip(rows, errors, strict=True):
        per_label[row[1]] += int(error)
    digest = hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()
    return [(r[0], c, int(e), per_label[r[1]], digest) for r, c, e in zip(rows, codes, errors, strict=True)]


def check(spark, rows, shard=50):
    made = [(*r, "clash", 1) for r in rows]
    got = anchor_codes.vector_codes(spark.createDataFrame(made, ROW).repartition(3), shard)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(plain(rows))


def clustered(seed, count, width, spread):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-900, 900, (12, width))
    return (centres[rng.integers(0, 12, count)] + rng.integers(-spread, spread + 1, (count, width))).tolist()


def test_rounds_as_plain(spark):
    vectors = clustered(1, 900, 16, 300)
    check(spark, [(n * 7 % 900, n % 5 if n % 9 else None, v) for n, v in enumerate(vectors)])


def test_ties_and_one_hot_vector(spark):
    """A third of all rows are one vector; others lie halfway between two entries."""
    vectors = [[1, 2, 3, 4, 5, 6, 7, 8]] * 300 + [[n % 3 - 1] * 8 for n in range(600)]
    check(spark, [(n, 0, v) for n, v in enumerate(vectors)])


def test_awkward_rows(spark):
    rows = [(n, n % 2, v) for n, v in enumerate(clustered(2, 280, 10, 50))]
    rows += [(None, None, [5] * 10), (None, 1, [-5] * 10), (3, 1, [9] * 10), (3, 1, [9] * 10), (900, 1, None), (901, 0, []), (902, 0, [7]), (903, 0, [1, 2, 3])]
    check(spark, rows)


def test_few_rows_and_none(spark):
    check(spark, [(4, 1, [1, 2, 3, 4]), (2, 1, [-4, 3, -2, 1]), (9, None, [0, 0, 0, 0])])
    check(spark, [(4, 1, []), (2, 1, [])])
    check(spark, [(4, 1, None)])
    check(spark, [])


def test_embeddings_with_odd_components(spark):
    rows = [(1, [0.5, -0.25, 1.0, 0.0009], 1), (2, [float("nan"), 0.0, 0.0, 0.0], 1), (3, None, 1), (4, [1.0, None, 0.0, 0.0], 1)]
    rows += [(5, [float("inf"), 0.0, 0.0, 0.0], 0), (6, [-0.0001, 0.0, -1.0, 0.25], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = [(1, 1, [512, -256, 1024, 0]), (6, 0, [-1, 0, -1024, 256])]
    assert Counter(map(tuple, anchor_codes.embedding_codes(frame).collect())) == Counter(plain(whole))


@pytest.mark.parametrize("count", [1, 31, 33, 700])
def test_balls_hold_their_points(count):
    points = np.array(clustered(3, count, 6, 100))
    tree = anchor_codes.build_tree(points)
    assert sorted(tree["places"]) == list(range(count)) and (tree["points"] == points[tree["places"]]).all()
    for first, last, left, right, radius, sums in zip(*[tree[c] for c in ("first", "last", "left", "right", "radius", "sums")], strict=True):
        mine = tree["points"][first:last]
        assert (mine.sum(axis=0) == sums).all()
        assert np.sqrt(((mine - sums / len(mine)) ** 2).sum(axis=1)).max() <= radius + 1e-9
        if left >= 0:
            assert (first, last) == (tree["first"][left], tree["last"][right]) and tree["last"][left] == tree["first"][right]


def test_anchors_own_the_nearest_points():
    points = np.array(clustered(4, 400, 5, 200))
    owned = anchor_codes.anchors(points, np.arange(400))
    assert sorted(np.concatenate(owned).tolist()) == list(range(400)) and len(owned) == 20
    apart = np.sqrt(((points[:, None, :] - points[[rows[-1] for rows in owned]][None, :, :]) ** 2).sum(axis=2))
    for n, rows in enumerate(owned):
        assert np.allclose(apart[rows, n], apart[rows].min(axis=1))
        assert (np.diff(apart[rows, n]) <= 1e-9).all()


def test_owned_balls_spare_comparisons():
    """On clusters far apart nearly all points are taken with their balls."""
    points = np.array(clustered(5, 2000, 16, 2))
    book = points[:40].copy()
    walk = anchor_codes.Walk(anchor_codes.build_tree(points), np.unique(book // 50 * 50, axis=0))
    walk.codes()
    assert walk.compared < 0.2 * len(points) * len(walk.book)
