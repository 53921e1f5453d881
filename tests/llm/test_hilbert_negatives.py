"""Hard negatives against all pairs, and the curve and bounds they rest on."""

from __future__ import annotations

import itertools
from collections import Counter

import numpy as np
import pytest

from sensorstar.llm import hilbert_negatives

ROW = "vec_id long, label int, vector array<bigint>, key string, block int, anchor_id string"


def plain(rows, every=100, wanted=5, percent=80):
    rows = [r for r in rows if None not in r]
    width = max((len(r[2]) for r in rows), default=0)
    vectors = np.array([r[2] + [0] * (width - len(r[2])) for r in rows], np.int64).reshape(len(rows), width)
    found = []
    for n, (anchor, label, _) in enumerate(rows):
        if anchor % every:
            continue
        scores = (vectors @ vectors[n]).tolist()
        others = sorted((-s, r[0], r[1]) for s, r in zip(scores, rows, strict=True) if r[0] != anchor)
        for score, positive, _ in [o for o in others if o[2] == label][:wanted]:
            fits = [o for o in others if o[2] != label and -percent * score <= -100 * o[0] <= -100 * score]
            found += [(anchor, positive, k, o[1], -score, -o[0]) for k, o in enumerate(fits[:wanted], 1)]
    return found


def check(spark, rows, block=7, **options):
    made = [(*r, "clash", 1, "clash") for r in rows]
    got = hilbert_negatives.hard_negatives(spark.createDataFrame(made, ROW).repartition(3), block=block, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain(rows, options.get("every", 100))
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    return expected


def points(seed, count, width, spread, size=40):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-size, size, (10, width))
    return (centres[rng.integers(0, 10, count)] + rng.integers(-spread, spread + 1, (count, width))).tolist()


def test_as_all_pairs_with_many_small_blocks(spark, monkeypatch):
    """Several pages of zone maps, parts of anchors and chunks of blocks."""
    monkeypatch.setattr(hilbert_negatives, "ZONES", 40)
    monkeypatch.setattr(hilbert_negatives, "ANCHORS", 9)
    rows = [(n, n * n % 7, v) for n, v in enumerate(points(1, 700, 6, 8))]
    assert check(spark, rows, block=3, every=20)


def test_ties_and_a_hot_vector(spark):
    """A third of the rows are one vector; few different scores."""
    rows = [(n, n % 2, [3, 1, -2]) for n in range(200)] + [(n, n % 3, [n % 5 - 1, n % 2, 1]) for n in range(200, 600)]
    assert check(spark, rows, every=25)


def test_awkward_rows(spark):
    rows = [(n, n % 3, v) for n, v in enumerate(points(2, 150, 4, 5))]
    rows += [(None, 1, [1, 2, 3, 4]), (300, None, [1, 2, 3, 4]), (310, 1, None), (320, 1, []), (330, 2, [50]), (340, 2, [9, 9, 9, 9, 9, 9])]
    rows += [(30, 0, [40, 30, 20, 10]), (30, 0, [40, 30, 20, 10]), (30, 2, [-40, 3, 2, 1]), (41, 1, [9, 9, 9, 9]), (41, 2, [9, 9, 9, 9])]
    assert check(spark, rows, every=10)


def test_scores_below_zero_have_no_negatives(spark):
    rows = [(0, 0, [1, 0]), (1, 0, [-5, 0]), (2, 1, [-5, 1]), (3, 1, [0, 7]), (4, 0, [0, 3])]
    assert check(spark, rows) == [(0, 4, 1, 3, 0, 0)]


def test_few_rows_and_none(spark):
    assert check(spark, []) == []
    assert check(spark, [(100, 1, [3, 4])]) == []
    assert check(spark, [(101, 1, [3, 4]), (102, 2, [3, 4])]) == []
    assert check(spark, [(100, 1, []), (102, 1, []), (103, 2, [])]) == [(100, 102, 1, 103, 0, 0)]


def test_embeddings_with_moved_labels(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5], 9), (1, [0.9, 0.5], 0), (2, [0.8, 0.5], 3), (7, [0.7, 0.5], 2), (3, [nan, 0.5], 0)]
    rows += [(4, [1.0, None], 0), (5, None, 0), (6, [1.0, 0.5], None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, hilbert_negatives.embedding_negatives(frame).collect()))
    # 0.9 * 256 is rounded down to 230; row 0 counts as label 0, row 7 as label 3.
    assert got == [(0, 1, 1, 2, 256 * 230 + 128 * 128, 256 * 204 + 128 * 128), (0, 1, 2, 7, 75264, 256 * 179 + 128 * 128)]


@pytest.mark.parametrize(("bits", "width"), [(1, 3), (2, 2), (3, 2), (4, 3), (2, 5)])
def test_curve_steps_to_a_neighbour(bits, width):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=width)))
    keys = [k.tobytes() for k in hilbert_negatives.curve_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    along = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(4)
    queries, low = rng.integers(-9, 10, (20, 5)), rng.integers(-9, 10, (6, 5))
    high = low + rng.integers(0, 6, (6, 5))
    least, largest = hilbert_negatives.score_bounds(queries, low, high)
    for zone in range(6):
        corners = np.array(list(itertools.product(*zip(low[zone], high[zone], strict=True))))
        scores = queries @ corners.T
        assert (scores.min(axis=1) == least[:, zone]).all() and (scores.max(axis=1) == largest[:, zone]).all()


def test_windows_spare_blocks(spark):
    """Anchors among clusters read few of the blocks."""
    rows = [(n, n % 4, v) for n, v in enumerate(points(5, 2000, 3, 1, 400))]
    frame = spark.createDataFrame(rows, "vec_id long, label long, vector array<bigint>")
    blocks = hilbert_negatives.Blocks(frame, 3, 401, 20)
    anchors = blocks.anchors(100, 5)
    asked = blocks.choose(anchors, 1, True, False).selectExpr("sum(bit_count(mask))").first()[0]
    assert anchors.count() == 20 and asked < 0.3 * 20 * blocks.blocks.count()
