"""Queries on larger tables than test_catalog.py's, and operators by brute force."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone import catalog
from lodestone.operators import changelog, provenance, retrieval

QUERIES = ["k1_v2_dense_top_k", "k2_bm25_top_k", "k3_a3_hybrid_search", "s4_w1_chain_faults", "g1_collection_paths"]


def plain(value):
    return f"{value:.6g}" if isinstance(value, float) else str(value)


def rows(got, columns):
    return sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())


@pytest.fixture(scope="session")
def oracle():
    con = duckdb.connect()
    for t in ("part", "events", "embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query_covers_its_table(spark, oracle, name):
    want = oracle.execute(catalog.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert rows(catalog.QUERIES[name](spark, "/root/testdata/sf0.01"), columns) == sorted(tuple(map(plain, r)) for r in want.fetchall())


@pytest.mark.parametrize("shift", [0, -3, 4])
def test_chain_faults_by_brute_force(spark, shift):
    syncs = [(i + 1 + shift, str(i), None if i == 0 else "x" if i % 7 == 3 else str(i - 1), -1 if i % 5 == 2 else i, i + 1) for i in range(60) if i % 11 != 6]
    want, before = [], None
    for r in syncs:
        fault = "sequence_gap" if r[0] != (before[0] if before else 0) + 1 else "wrong_predecessor" if r[2] != (before and before[1]) else "version_gap" if before and r[3] != before[4] else None
        want += [(r[0], fault)] if fault else []
        before = r
    df = spark.createDataFrame(syncs, "sequence long, sync_id string, previous_sync_id string, from_version long, target_version long").repartition(5)
    assert sorted((r.sequence, r.fault) for r in changelog.chain_faults(df).collect()) == want


def test_dense_by_brute_force_in_blocks(spark, monkeypatch):
    """Blocks and chunks smaller than the data, ties of many copies, a zero and a null vector."""
    monkeypatch.setattr(retrieval, "BLOCK", 3)
    import random

    rng = random.Random(5)
    vecs = [(i, [1.0, 2.0, 2.0] if i % 3 == 0 else [0.0] * 3 if i == 7 else None if i == 8 else [rng.gauss(0, 1) for _ in range(3)]) for i in range(2500)]
    points = spark.createDataFrame(vecs, "point_id long, vec array<float>").repartition(2)
    got = retrieval.dense(points.where("point_id % 250 = 0").selectExpr("point_id AS query_id", "vec AS query"), points, 4)

    import numpy as np

    own = np.array([v or [0.0] * 3 for _, v in vecs], np.float32).astype(float)
    norms = np.sqrt((own**2).sum(axis=1))
    want = set()
    for q in range(0, 2500, 250):
        scores = [round(float(own[q] @ own[i] / (norms[q] * norms[i])), 9) if norms[i] else 0.0 for i in range(2500)]
        want |= {(q, i, r) for r, i in enumerate(sorted(range(2500), key=lambda i: (-scores[i], i))[:4], 1)}
    assert {(r.query_id, r.point_id, r["rank"]) for r in got.collect()} == want


def test_similarity_by_brute_force(spark):
    """Copied runs of 8, 11, 12 and 15 words, exact short items, cut first and last words, repeated words."""
    item = [f"w{i}" for i in range(100)]
    texts = {i: " ".join(item) for i in range(1)} | {6: "", 7: "x", 8: "iny", 9: "w30 w31 w32", 10: " ".join(item[28:48]), 11: "-", 1: "Tiny Item", 2: " one two three four five six ", 3: "a a a a a a b", 4: "q1 q2 q3 q4 q5 q6 q7 q8 q9 r1 r2 r3 r4", 5: "q1 q2 q3 q4 q5 q6 q7 q8 q9 r1 r2 r3 r4 r5"}
    docs = {n: "x " + " ".join(item[30 : 30 + n]) + " y" for n in (4, 5, 7, 8, 11, 12, 15)}
    docs[27] = "x " + " ".join(item[25:50])
    docs |= {20: "a tiny item here", 21: "xone two three four five sixty", 22: "a " * 30 + "b", 23: "zq1 q2 q3 q4 q5 q6 q7 q8 q9 r1 r2 r3 r4", 24: "zq1 q2 q3 q4 q5 q6 q7 q8 q9 r1 r2 r3 r4 r55", 25: "", 26: " ".join(item[:8] + ["-"] + item[50:58])}

    def grams(words):
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    want = {}
    for i, text in texts.items():
        for d, doc in docs.items():
            a, b = text.lower().replace("-", " ").split(), doc.lower().replace("-", " ").split()
            run = max((k for x in range(len(a)) for y in range(len(b)) for k in range(len(a) - x + 1) if a[x : x + k] == b[y : y + k]), default=0)
            shared, exact = len(grams(a) & grams(b)), bool(text.strip()) and text.strip().lower() in doc.lower()
            ratio = shared / max(1, len(grams(a)))
            if shared or exact:
                want[i, d] = (shared, round(ratio, 6), exact, run, "high" if exact or run >= 12 or ratio >= 0.5 else "match" if run >= 8 or ratio >= 0.2 else "low")
    got = provenance.similarity(spark.createDataFrame(list(texts.items()), "item_id int, text string"), spark.createDataFrame(list(docs.items()), "doc_id int, text string"), catalog._tokens)
    rows = got.collect()
    assert {(r.item_id, r.doc_id): (r.shared, round(r.overlap, 6), r.exact, r.run, r.risk) for r in rows} == want
    assert {r.doc_id: r.run for r in rows if r.item_id == 0 and r.doc_id < 20} == {5: 5, 7: 7, 8: 8, 11: 11, 12: 12, 15: 15}
    assert want[0, 8][4] == want[0, 11][4] == "match" and want[0, 12][4] == want[1, 20][4] == want[2, 21][4] == "high"
