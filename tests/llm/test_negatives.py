"""Hard negatives by an inverted multi-index against all scores in plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives

SCHEMA = "vec_id bigint, embedding array<double>, label string"


def plain(rows, anchors, positives=5, most=5, low=80):
    sound = set()
    for key, v, label in rows:
        if key is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * x) for x in v)
        if sum(x * x for x in q) < 1 << 62:
            sound.add((key, label, q))
    out = []
    for key, label, q in sound:
        if not anchors(key):
            continue
        near = [(-sum(a * b for a, b in zip(q, p)), k, lab) for k, lab, p in sound if k != key and len(p) == len(q)]
        for score, pos, _ in sorted(n for n in near if n[2] == label)[:positives]:
            fit = sorted(n for n in near if n[2] != label and low * -score <= 100 * -n[0] <= 100 * -score)
            out += [(key, pos, r + 1, k, -score, -s) for r, (s, k, _) in enumerate(fit[:most])]
    return sorted(out)


def mined(spark, rows, every=3, **how):
    rows = [(k, v and [x if x is None else float(x) for x in v], label) for k, v, label in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = negatives.mine(df, F.col("label"), F.col("id") % every == 0, **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def cloud(n, dims, seed, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    x = middle[rng.integers(0, centres, n)] + 0.4 * rng.normal(size=(n, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(negatives, "CELL", 4)
    monkeypatch.setattr(negatives, "CHUNK", 5)
    monkeypatch.setattr(negatives, "PROBE", 12)


@pytest.mark.parametrize("dims", [2, 9, 64])
def test_results_are_those_of_all_scores(spark, small_cells, dims):
    x = cloud(300, dims, dims)
    rows = [(i, v.tolist(), str(i * i % 4)) for i, v in enumerate(x)]
    rows += [(1000 + i, x[5].tolist(), str(i % 4)) for i in range(60)]  # equal vectors: ties by id
    want = plain(rows, lambda k: k % 3 == 0)
    assert mined(spark, rows) == want and len(want) > 100


def test_null_broken_repeated_and_long_vectors(spark, small_cells):
    x = cloud(60, 6, 1)
    rows = [(i, v.tolist(), "ab"[i % 2]) for i, v in enumerate(x)]
    rows += [(None, x[0].tolist(), "a"), (61, None, "a"), (62, x[3].tolist(), None), (63, [1.0, None, 0, 0, 0, 0], "a"),
             (66, [math.nan] * 6, "b"), (69, [math.inf] * 6, "b"), (72, [0.0] * 6, "b"), (75, [1e200] + [0.0] * 5, "a"),
             (78, [1e6] * 6, "a"), (79, [0.9e6] * 6, "b"), (80, [0.99e6] * 6, "a"), (81, [], "a"), (82, [], "b"), (84, [], "a"),
             (87, [0.5], "a"), (88, [0.45], "b"), (90, [0.4], "a"), (93, [0.1, 0.2, 0.3], "b"), (94, [0.1, 0.2, 0.25], "a"), (95, [0.1, 0.2, 0.3], "b")]
    rows += rows[:20] + [(3, x[9].tolist(), "b"), (3, x[8].tolist(), "a")]
    assert mined(spark, rows) == plain(rows, lambda k: k % 3 == 0)


def test_few_rows_and_clashing_names(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [0.5, 0.5], "a")]) == []
    assert mined(spark, [(0, [0.5, 0.5], "a"), (1, [0.5, 0.5], "a"), (2, [0.5, 0.4], "b")]) == [(0, 1, 1, 2, 32768, 128 * 128 + 128 * 102)]
    df = spark.createDataFrame([(0, [0.5], 7, 1, 1), (1, [0.5], 7, 1, 2), (2, [0.5], 7, 2, 2)], "vec_id int, embedding array<float>, q int, w int, i int")
    got = negatives.mine(df, F.col("w"), F.col("id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 16384, 16384)]


def test_walk_visits_every_cell_once_in_order():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=7), rng.normal(size=5)
    seen = list(negatives.descending(a, b))
    assert sorted((i, j) for _, i, j in seen) == [(i, j) for i in range(7) for j in range(5)]
    assert all(s[0] >= t[0] for s, t in zip(seen, seen[1:])) and all(abs(s - a[i] - b[j]) < 1e-12 for s, i, j in seen)


def test_no_row_of_a_cell_passes_its_bounds():
    x = np.floor(256 * cloud(500, 10, 3)).astype(np.int64)
    books = {10: (negatives.learn(x[:, :5], 4), negatives.learn(x[:, 5:], 4))}
    (i, d_i), (j, d_j) = negatives.nearest(x[:, :5], books[10][0]), negatives.nearest(x[:, 5:], books[10][1])
    radius = {10: tuple(np.array([d[c == k].max() for k in range(4)]) for c, d in ((i, d_i), (j, d_j)))}
    walker = negatives.Walker(books, radius, {10: np.ones((4, 4), int)})
    for q in x[:20]:
        (ui, li), (uj, lj) = walker.bounds(q)
        assert (x @ q <= ui[i] + uj[j]).all() and (x @ q >= li[i] + lj[j]).all()
        least = int(np.sort(x @ q)[-5])
        needed = {(a, b) for _, a, b in walker.needed(q, least, negatives.MOST)}
        assert {(a, b) for a, b in zip(i[x @ q >= least].tolist(), j[x @ q >= least].tolist())} <= needed


def test_scores_are_exact_beyond_doubles():
    x = np.array([[2**31 - 7, 2**30 + 1]]), np.array([[2**29 + 3, -(2**30) + 5]])
    assert negatives.scores(*x)[0, 0] == (2**31 - 7) * (2**29 + 3) + (2**30 + 1) * (-(2**30) + 5)
