"""Similar sets against all pairs; only the first items of each set are shuffled."""

import random

import pytest

from lodestone.operators import clusters


@pytest.mark.parametrize("cells", [1 << 20, 1, 16])
def test_near_pairs_equal_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(clusters, "CELLS", cells)
    rng = random.Random(5)
    base = [rng.sample(range(60), rng.randint(0, 30)) for _ in range(12)]
    sets = [(f"n{i:03}", rng.choice("xy") if i % 17 else None, sorted(set(rng.choice(base)) ^ set(rng.sample(range(60), rng.randint(0, 2))))) for i in range(150)]
    got = clusters.near_pairs(spark.createDataFrame(sets, "node string, g string, items array<bigint>"), ["g"], 0.8)
    assert {(r.a, r.b, round(r.similarity, 9)) for r in got.collect()} == {
        (a, b, round(len(set(x) & set(y)) / len(set(x) | set(y)), 9)) for a, g, x in sets for b, h, y in sets if a < b and g is not None and g == h and x and y and len(set(x) & set(y)) >= 0.8 * len(set(x) | set(y))
    }
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan
