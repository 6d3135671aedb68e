"""Routed search by corpus: over-fetch, demotion, exact symbols, inferred assets, filters behind the search, and the envelope."""

import pytest
from pyspark.sql import functions as F

from lodestone.operators import hub

SCHEMA = "point_id int, corpus string, text string, vec array<float>, path string, source_type string, role string, writing_id int, section string, venue string, domains array<string>, title string, asset_type string, lang string"
TOKENS = lambda c: F.regexp_extract_all(F.lower(F.col(c)), F.lit("[a-z0-9]+"), 0)


def point(i, corpus, text="", x=0.0, **own):
    row = {"path": "Body", "source_type": "other", "role": "retrieved_evidence", "writing_id": i, "section": "Intro", "venue": "", "domains": [], "title": "", "asset_type": "phrase", "lang": "en"} | own
    return (i, corpus, text, [1.0, x], *row.values())


@pytest.fixture(scope="module")
def points(spark):
    rows = [point(i, "literature", f"graph w{i}", i / 10, path="References" if i in (0, 1) else "Results") for i in range(8)]
    rows += [point(20 + i, "code", "graph api", i / 10, source_type=s, role=r) for i, (s, r) in enumerate([("issue", "retrieved_evidence"), ("example", "target_version_evidence"), ("source_code", "retrieved_evidence"), ("other", "change_evidence")])]
    rows += [point(40 + i, "writing", "graph phrase", i / 10, asset_type=("strategy", "template", "phrase")[i % 3], section=("1 Introduction", "Methods")[i % 2]) for i in range(6)]
    return spark.createDataFrame([*rows, point(60, "literature", "graph", 0.0, lang="de"), point(61, "literature", None, 0.0)], SCHEMA)


def asked(spark, *queries):
    return spark.createDataFrame([(i, q, [1.0, 0.0]) for i, q in enumerate(queries)], "query_id int, query string, vec array<float>")


def test_literature(spark, points):
    got = hub.search(asked(spark, "graph", "graph references", "  "), points, "literature", TOKENS, "dense", top=3, prefetch=20, equal={"lang": "en"}).collect()
    ids = {q: [r.point_id for r in sorted(got, key=lambda r: r.new_rank) if r.query_id == q] for q in (0, 1, 2)}
    assert ids == {0: [61, 2, 3], 1: [0, 61, 1], 2: []}  # lists of references behind all others that were fetched; the order of the legs where they are asked for
    assert {r.query_id: r.warnings for r in got} == {0: ["bibliography_sections_demoted"], 1: []}


def test_modes(spark, points):
    found = {m: [r.point_id for r in hub.search(asked(spark, "w3 graph"), points, "literature", TOKENS, m, top=2, prefetch=2).orderBy("new_rank").collect()] for m in hub.MODES}
    assert found["dense"] == [60, 0]  # the two of the smallest ids among equals, the list of references last
    assert found["sparse"] == [3, 60]
    assert found["hybrid"] == [60, 0]  # of equal ranks the smaller id, before the order
    with pytest.raises(ValueError, match="mode"):
        hub.search(asked(spark, "x"), points, "code", TOKENS, "fast")
    with pytest.raises(ValueError, match="corpus"):
        hub.search(asked(spark, "x"), points, "poems", TOKENS)
    with pytest.raises(ValueError, match="behind"):
        hub.search(asked(spark, "x"), points, "code", TOKENS, section="Intro")


def test_code(spark, points):
    exact = points.where("point_id = 23").drop("vec").withColumns({"query_id": F.lit(0), "score": F.lit(1.0), "point_id": F.lit(99)})
    got = hub.search(asked(spark, "graph traceback"), points, "code", TOKENS, top=4, exact=exact).orderBy("new_rank").collect()
    assert [r.point_id for r in got] == [99, 21, 23, 22] and got[0].role == "exact_symbol_source"


def test_writing(spark, points):
    queries = asked(spark, "graph", "a graph template")
    adjust = spark.createDataFrame([(44, 0.3)], "target int, adjustment double")
    got = hub.search(queries, points, "writing", TOKENS, top=2, adjustments=adjust, section="introduction").orderBy("query_id", "new_rank").collect()
    assert [(r.query_id, r.point_id) for r in got] == [(0, 44), (0, 40), (1, 44)]


def test_empty_sets(spark, points):
    assert hub.search(asked(spark, "graph").limit(0), points, "literature", TOKENS).count() == 0
    assert hub.search(asked(spark, "graph"), points.limit(0), "writing", TOKENS).count() == 0


def test_envelope(spark, points):
    hits = hub.search(asked(spark, "graph"), points, "code", TOKENS, top=4)
    got = hub.enveloped(hits, 3, 5, "title").orderBy("rank").collect()
    assert [(r.content, r.tokens, r.truncated) for r in got] == [("graph api", 3, False), ("graph ap", 2, True)]
