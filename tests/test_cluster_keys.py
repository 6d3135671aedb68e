"""Keys of similar sets, against all pairs; near copies don't become all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import clusters


@pytest.mark.parametrize(("small", "threshold"), [(24, 0.85), (2, 0.85), (24, 0.6), (300, 0.9)])
def test_similar_sets_share_a_key(monkeypatch, small, threshold):
    monkeypatch.setattr(clusters, "SMALL", small)
    rng = random.Random(7)
    sets = []
    for _ in range(150):
        base = [rng.getrandbits(64) for _ in range(int(2 ** rng.uniform(0, 9)))]
        for _ in range(4):
            share = rng.uniform(0, 1.2 * (1 - threshold))
            sets.append(np.unique(np.array([x for x in base if rng.random() > share / 2] + [rng.getrandbits(64) for _ in range(int(len(base) * share / 2))], np.uint64)))
    sizes = np.array([len(s) for s in sets])
    own, keys = clusters._keys(sizes, np.concatenate(sets), threshold)
    of = [set(keys[own == i].tolist()) for i in range(len(sets))]
    similar = [(i, j) for i in range(len(sets)) for j in range(i - i % 4, i) if len(set(sets[i].tolist()) & set(sets[j].tolist())) >= threshold * len(set(sets[i].tolist()) | set(sets[j].tolist())) > 0]
    assert len(similar) > 200 and all(of[i] & of[j] for i, j in similar)
    if threshold == 0.85:
        assert len(keys) < 0.5 * sizes.sum()


def test_sets_of_frequent_items_share_no_keys():
    """Sets that have a third of their items in common met by their first items."""
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**63, 60, dtype=np.int64).view(np.uint64)
    sets = [np.sort(np.concatenate([common, rng.integers(0, 2**63, 120, dtype=np.int64).view(np.uint64)])) for _ in range(100)]
    own, keys = clusters._keys(np.full(100, 180), np.concatenate(sets), 0.85)
    pairs = {(a, b) for k in set(keys.tolist()) for a in own[keys == k] for b in own[keys == k] if a < b}
    assert len(pairs) < 0.2 * 4950


def test_sketches_tell_no_similar_sets_apart():
    rng = np.random.default_rng(2)
    for n in (5, 100, 3000):
        a = rng.integers(0, 2**63, n, dtype=np.int64).view(np.uint64)
        b = np.concatenate([a[n // 10 :], rng.integers(0, 2**63, n // 20, dtype=np.int64).view(np.uint64)])
        x, y = (np.array([int(c[i].as_py()) for c in clusters._sketches(np.array([len(a), len(b)]), np.concatenate([a, b]))]) for i in (0, 1))
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= n // 10 + n // 20


def test_near_copies_do_not_become_all_pairs(spark, monkeypatch):
    links = []
    monkeypatch.setattr(clusters, "components", lambda found, all_=clusters.components: (links.append(found.count()), all_(found))[1])
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, "a", " ".join(w if k != i % 190 else "x" for k, w in enumerate(base))) for i in range(80)]
    rows += [(100 + i, rng.choice("ab"), " ".join(rng.sample(base, 100))) for i in range(20)] + [(200, "b", " ".join(base)), (201, None, "w1 w2"), (202, "a", None), (203, "a", "")]
    got = {int(r.id): (r.cluster, r["size"]) for r in clusters.clusters(spark.createDataFrame(rows, "id int, g string, t string"), "id", F.col("t"), ["g"]).collect()}
    assert len(got) == len(rows) and {got[i] for i in range(80)} == {got[0]} and got[0][1] == 80
    assert got[202] == got[203] and got[202][1] == 2 and all(got[i][1] == 1 for i in (*range(100, 120), 200, 201))
    assert max(links) < 800  # 3160 pairs are similar
