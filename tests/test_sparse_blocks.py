"""Sparse search where the points lie: blocks of queries, cut lists of matches and ties give what plain sums give."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from lodestone.operators import retrieval


def test_no_pairs_are_shuffled_and_blocks_agree(spark, monkeypatch):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    texts = {i: [rng.choice(words) for _ in range(rng.randint(1, 12))] for i in range(150)} | {150: ["w1", "w2"], 151: ["w1", "w2"], 152: ["w1", "w2"]}
    asked = {q: set(rng.sample(words, 5)) | {"absent"} for q in range(23)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "point_id bigint, text string").repartition(3)
    queries = spark.createDataFrame([(q, t) for q, ts in asked.items() for t in ts] * 2, "query_id bigint, term string")
    df, mean = Counter(t for ts in texts.values() for t in set(ts)), sum(map(len, texts.values())) / len(texts)
    want = set()
    for q, ts in asked.items():
        scores = {}
        for i, text in texts.items():
            tf = Counter(text)
            if any(t in tf for t in ts):
                scores[i] = sum(math.log(1 + (len(texts) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(text) / mean)) for t in ts if t in tf)
        want |= {(q, i, round(scores[i], 6), n) for n, i in enumerate(sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:4], 1)}
    find = lambda: retrieval.sparse(queries, docs, F.split("text", " "), 4)
    assert {(r.query_id, r.point_id, round(r.score, 6), r["rank"]) for r in find().collect()} == want
    for name, value in (("ASKED", 5), ("POINTS", 7), ("MATCHES", 3)):
        monkeypatch.setattr(retrieval, name, value)
    found = find()
    assert {(r.query_id, r.point_id, round(r.score, 6), r["rank"]) for r in found.collect()} == want
    # what reaches the last exchange are the best of each partition, not all pairs
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "sum(weight" not in plan


def test_token_overlap_counts_where_documents_lie(spark, monkeypatch):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, rng.sample(words, rng.randint(0, 9)) if i % 13 else None) for i in range(60)]
    queries = [(q, rng.sample([*words, "absent"], rng.randint(1, 6))) for q in range(9)] + [(9, []), (10, None)]
    for name, value in (("OVERLAP", 4), ("POINTS", 7), ("MATCHES", 5)):
        monkeypatch.setattr(retrieval, name, value)
    found = retrieval.token_overlap(spark.createDataFrame(queries, "query_id bigint, query array<string>"), spark.createDataFrame(docs, "point_id bigint, tokens array<string>").repartition(3), 50)
    want = set()
    for q, ts in queries:
        scored = [(i, None if ts is None or d is None else len(set(ts) & set(d)) / max(1, len(ts))) for i, d in docs]
        want |= {(q, i, x, n) for n, (i, x) in enumerate(sorted(scored, key=lambda s: (s[1] is None, -(s[1] or 0), s[0]))[:50], 1)}
    assert {(r.query_id, r.point_id, r.score, r["rank"]) for r in found.collect()} == want
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
