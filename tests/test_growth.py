"""Queries whose tasks grew faster than their input, against brute force on small rows."""

import json
import random
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from lodestone import catalog
from lodestone.functions import rows
from lodestone.operators import provenance, reconstruct, state, stored_records
from lodestone.plans import code_documents, markdown


def test_contained_paragraphs_meet_in_one_shuffle(spark):
    rng = random.Random(3)
    refs = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.randint(0, 3), rng.choice([None, *range(30)])) for _ in range(60)]
    chunks = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([0, 1, 1, 1]), ref) for ref in [*range(30), None] for _ in range(2)] + [(d, 1, r) for d, _, r in refs if d in (6, 7)]
    got = state.contained(spark.createDataFrame(refs, "d int, paragraph_id int, ref int"), spark.createDataFrame(chunks, "d int, chunk_id int, ref int"), "d")
    held = lambda d, r: {c for e, c, s in chunks if None not in (d, r) and (e, s) == (d, r)}
    want = {}
    for d, p in {(d, p) for d, p, _ in refs}:
        sets = [held(d, r) for e, q, r in refs if (e, q) == (d, p)]
        want[d, p] = set.union(*sets), all(len(s) == 1 for s in sets) and len(set.union(*sets)) == 1
    open_ = {d: all(sound for (e, _), (_, sound) in want.items() if e == d) for d, _ in want}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((d, p, min(s) if open_[d] else None, open_[d]) for (d, p), (s, _) in want.items()), key=str)
    assert any(open_.values()) and not all(open_.values())
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_hits_of_one_symbol_are_made_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(state, "REPEATS", 3, raising=False)
    rng = random.Random(4)
    symbols = [("a", i % 3, i % 2) for i in range(20)] + [("b", 9, 9), (None, 0, 0), ("c", 1, 1)]
    markers = [(0, 0), (1, 1), (2, 0), (0, 0)]
    hits = [(rng.choice(["a", "b", "c", None]), i, float(i)) for i in range(40)]
    got = state.source_markers(spark.createDataFrame(symbols, "symbol string, path int, version int"), spark.createDataFrame(markers, "path int, version int"), spark.createDataFrame(hits, "symbol string, point_id int, score double"))
    rows = got.select("symbol", "point_id", "score", F.spark_partition_id().alias("task")).collect()
    want = Counter(h for s, *place in symbols for m in markers if tuple(place) == m for h in hits if h[0] == s and s is not None)
    assert Counter((r.symbol, r.point_id, r.score) for r in rows) == want
    assert len({r.task for r in rows if r.symbol == "a"}) > 4


def test_hits_are_shuffled_once_however_many_rows_they_become(spark, monkeypatch):
    monkeypatch.setattr(state, "REPEATS", 3)
    symbols = spark.range(90).select(F.lit("a").alias("symbol"), (F.col("id") % 3).alias("path"), F.lit(0).alias("version"))
    markers = spark.createDataFrame([(0, 0), (1, 0)], "path int, version int")
    dealt, deal = [], type(symbols).repartition
    monkeypatch.setattr(type(symbols), "repartition", lambda df, *by: (dealt.append(df.count()), deal(df, *by))[1])
    got = state.source_markers(symbols, markers, spark.range(40).select(F.lit("a").alias("symbol"), F.col("id").alias("point_id"), F.lit(1.0).alias("score")))
    assert Counter(r.point_id for r in got.collect()) == Counter({i: 60 for i in range(40)})
    assert dealt == [40]
    monkeypatch.setattr(state, "BLOCKS", 5)  # 60 rows are four shares of 15
    got = state.source_markers(symbols, markers, spark.range(7).select(F.lit("a").alias("symbol"), F.col("id").alias("point_id"), F.lit(1.0).alias("score")))
    assert Counter(r.point_id for r in got.collect()) == Counter({i: 60 for i in range(7)}) and dealt == [40, 28]


def test_rowwise_python_holds_few_rows_of_a_batch(monkeypatch):
    class Spy:
        def __init__(self, values):
            self.values = values

        def __len__(self):
            return len(self.values)

        def slice(self, at, n):
            return Spy(self.values.slice(at, n))

        def to_pylist(self):
            assert len(self.values) <= 64
            return self.values.to_pylist()

    monkeypatch.setattr(F, "arrow_udf", lambda run, kind: run)
    twice = rows.rowwise(lambda a, b: [a, b, a], "array<string>")
    texts = [None if i % 7 == 0 else f"t{i}" for i in range(300)]
    assert twice(Spy(pa.array(texts)), Spy(pa.array(texts[::-1]))).to_pylist() == [[a, b, a] for a, b in zip(texts, texts[::-1], strict=True)]
    assert twice(Spy(pa.array([], pa.string())), Spy(pa.array([], pa.string()))).to_pylist() == []


def test_code_documents_use_one_python_helper_behind_the_cut(spark):
    docs = spark.createDataFrame([("d", "tutorial", "a.md", "u", "t", "# A\nb", None)], "document_id string, source_type string, path string, source_url string, title string, content string, metadata string")
    plan = code_documents.chunks(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == plan.count("MapInArrow") == 1


def test_texts_read_each_document_once(spark):
    lines = [("section_header", "Intro"), ("text", "a"), ("section_header", " References "), ("text", "b"), ("section_header", "Results"), ("list_item", "c"), ("text", "d")]
    prov = '[{"page_no":1,"bbox":{"l":0.0,"t":1.0,"r":2.0,"b":3.0},"charspan":[0,1]}]'
    texts = [{"label": label, "orig": said, "text": said, "self_ref": f"#/texts/{i}"} for i, (label, said) in enumerate([("text", "before"), *lines])]
    told = json.dumps({"document_id": "x", "parser_name": "docling", "parser_version": "2.112.1", "parse_fingerprint": "f", "structured": {"schema_name": "DoclingDocument", "version": "1.10.0", "body": {"children": [{"cref": f"#/texts/{i}"} for i in range(len(texts))]}, "groups": [], "texts": texts}})
    told = told.replace('"self_ref"', f'"prov": {prov}, "self_ref"')
    state_ = spark.createDataFrame([("x", "ready", "ready", "docling", "2.112.1", "f", "K", "A")], "document_id string, source_status string, parse_status string, parser_name string, parser_version string, parse_fingerprint string, item_key string, attachment_key string")
    docs = reconstruct.documents(state_.select("document_id"), state_, spark.createDataFrame([("x", told, "# Intro\n# References\n# Results")], "document_id string, payload string, markdown string"))
    found = reconstruct.texts(docs)
    assert [(r.place, r.nth, r.section_title, r.paragraph_no, r.text) for r in found.orderBy("place").collect()] == [(2, 1, "Intro", 1, "a"), (6, 3, "Results", 1, "c"), (7, 3, "Results", 2, "d")]
    whole = reconstruct.paragraphs(docs).orderBy("place").collect()
    assert [(r.text, r.section_path, r.paragraph_id is None) for r in whole] == [("a", ["Intro"], False), ("c", ["Results"], False), ("d", ["Results"], False)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_writing_entries_judge_each_paragraph_once(spark):
    docs = spark.createDataFrame([("x", "# Introduction\nHowever, in this paper we propose a new method that is described below in some more detail.\n")], "d string, body string")
    found = markdown.writing_entries(docs, "d", "body")
    assert "Filter isnotnull(function#" in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.family, r.section_no, r.paragraph) for r in found.collect()] == [("introduction", 1, 1)]


def test_stored_records_are_read_once(spark):
    records = spark.createDataFrame([(1, "phrase", "{}"), (2, "phrase", None), (3, "other", "{}"), (4, "phrase", "[1]"), (5, "phrase", '{"a": 1')], "k int, kind string, record string")
    found = stored_records.checked(records, "k", "kind", "record")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("jsonObjectKeys(record#") == 1
    got = {r.k: r.faults for r in found.collect()}
    assert len(got[1]) == len(stored_records.RULES["phrase"]) and (got[2], got[3], got[4]) == (["record"], ["kind"], ["record"])
    assert len(got) == 5


def test_contamination_cuts_documents_into_words_once(spark):
    words = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame([(i, " ".join(words[i : i + 12])) for i in range(3)], "item_id int, text string")
    docs = spark.createDataFrame([(0, " ".join(words)), (1, "x " + " ".join(words[2:8]) + " y"), (2, None), (3, "w1 w2"), (4, "W1 W2\nW3 w4 w5")], "doc_id int, text string")
    got = provenance.similarity(items, docs, catalog._tokens)
    # item 2 and the others share w2 to w7 with document 1, and items 0 and 1 w1 to w5 with document 4
    want = {(0, 0, 8, True, 12), (1, 0, 8, True, 12), (2, 0, 8, True, 12), (0, 1, 2, False, 6), (1, 1, 2, False, 6), (2, 1, 2, False, 6), (0, 4, 1, False, 5), (1, 4, 1, False, 5)}
    assert {(r.item_id, r.doc_id, r.shared, r.exact, r.run) for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    texts = set(re.findall(r"ExistingRDD\[doc_id#\d+,(text#\d+)", plan))
    cut = [line for line in plan.splitlines() for text in texts if f"regexp_extract_all(lower({text})" in line]
    # once in the scan, and once behind the join by id for those that short items found
    assert len(cut) == 2 and not any("lambda" in line for line in plan.splitlines() if "doc_id" in line and "Generate" in line)
