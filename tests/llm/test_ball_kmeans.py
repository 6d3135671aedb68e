"""Ball k-means against plain Lloyd rounds."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from lodestone.llm import ball_kmeans as balls

SCHEMA = "vec_id bigint, embedding array<float>, label int, vec string, cluster string, distance string"


def lloyd(rows, k=8, dims=64, rounds=10):
    held = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted(held, key=key)[:k]]
    far = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w, strict=True))
    near = lambda v: min(range(len(c)), key=lambda j: (far(v, c[j]), j))
    for _ in range(rounds):
        own = [near(v) for _, v in held]
        for j in set(own):
            mine = [v for (_, v), o in zip(held, own, strict=True) if o == j]
            c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    own = [near(v) for _, v in held]
    d = [far(v, c[j]) for (_, v), j in zip(held, own, strict=True)]
    return Counter((i, j, x, sum(y for y, o in zip(d, own, strict=True) if o == j), sum(d), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for (i, _), j, x in zip(held, own, d, strict=True))


def got(df, **kw):
    return Counter(map(tuple, balls.cluster(df, **kw).collect()))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], SCHEMA).repartition(3)


def make_rows(n, seed=1):
    rng = np.random.default_rng(seed)
    spots = rng.normal(0, 1, (5, 64))
    vec = lambda: [float(x) for x in np.float32(spots[rng.integers(5)] + rng.normal(0, 0.5, 64))]
    rows = [(i, vec()) for i in range(n)]
    hot = vec()
    rows += [(10_000 + i, hot) for i in range(n // 2)]  # copies
    rows += [(None, vec()), (None, vec()), rows[3], rows[3], (5, vec()), (20_000, None), (20_001, []), (20_002, hot[:63]), (20_003, [*hot, 1.0]), (20_004, [None, *hot[1:]]), (20_005, [math.nan, *hot[1:]]), (20_006, [math.inf, *hot[1:]])]
    return rows


@pytest.mark.parametrize("refresh", [1, 4, 20])
def test_ball_kmeans_equals_lloyd(spark, monkeypatch, refresh):
    monkeypatch.setattr(balls, "REFRESH", refresh)
    rows = make_rows(120)
    assert got(frame(spark, rows)) == lloyd(rows)


def test_ball_kmeans_on_a_grid_of_ties(spark):
    rows = [(i, [float(i % 3), float(i // 3 % 3), float(i // 9 % 2)]) for i in range(60)]
    assert got(frame(spark, rows), dims=3) == lloyd(rows, dims=3)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_ball_kmeans_of_few_vectors(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    assert got(frame(spark, rows)) == lloyd(rows)


def test_ball_kmeans_of_equal_vectors(spark):
    rows = [(i, [0.5] * 64) for i in range(40)]
    assert got(frame(spark, rows)) == lloyd(rows)


def test_balls_spare_comparisons():
    rng = np.random.default_rng(4)
    spots = rng.integers(-4000, 4000, (8, 64))
    points = np.repeat(spots, 500, axis=0) + rng.integers(-60, 60, (4000, 64))
    spent = [0]
    cluster, distance = balls.moved(points, np.repeat(np.arange(8), 500), spots, spent)
    assert spent[0] == 0 and (cluster == np.repeat(np.arange(8), 500)).all()
    stale = [0]
    again, same = balls.moved(points, np.zeros(4000, np.int64), spots, stale)
    assert 0 < stale[0] <= 7 * 4000 and (again == cluster).all() and (same == distance).all()


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="too large"):
        got(frame(spark, [(1, [3e38] * 64), (2, [1.0] * 64)]))
