"""Rules whose cases the tables don't hold, on hand-made rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from lodestone.functions import hashing, text, vector
from lodestone.operators import changelog, graph, provenance
from lodestone.plans import chunking
from lodestone.sources import files
from lodestone.streaming import deltas


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("value", "want"), [("abc", "abc"), ("图 神经网络 图", "图 神经网络 图\n__kh_cjk_bigrams__ 图 神经 经网 网络")])
def test_sparse_text(spark, value, want):
    assert one(spark, value, text.sparse_text) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [("1. Introduction", "introduction"), ("IV) Experimental Setup", "experiment"), ("Additional Related Work", "related_work"), ("方法", "method"), ("Conclusions.", "conclusion"), ("Ablation experiments", "experiment"), ("", "other"), ("Appendix Z", "appendix z")],
)
def test_section_family(spark, value, want):
    assert one(spark, value, text.section_family) == want


def test_language_and_intents(spark):
    assert one(spark, "深度学习 ok", text.language) == "zh" and one(spark, "123", text.language) == "und"
    assert one(spark, "升级 guide", text.code_intent) == "migration"
    assert one(spark, "a template or phrase", text.asset_intent) is None and one(spark, "写作模板", text.asset_intent) == "template"


def test_redaction(spark):
    assert one(spark, "api_key = abc, next ?key=zz&x=1", text.redacted) == "api_key = [REDACTED], next ?key=[REDACTED]&x=1"


def test_uuid5_and_partitions(spark):
    assert one(spark, "chunk:1", lambda x: hashing.uuid5(uuid.NAMESPACE_URL, x)) == str(uuid.uuid5(uuid.NAMESPACE_URL, "chunk:1"))
    import hashlib

    assert one(spark, "doc", lambda x: hashing.stable_partition(x, 13)) == int.from_bytes(hashlib.sha256(b"doc").digest()[:8], "big") % 13
    assert one(spark, "in 1999 or 20045", lambda x: hashing.year_of(x)) == 1999
    assert spark.range(1).select(hashing.canonical_json(b=F.lit(1), a=F.lit(None).cast("string")).alias("j")).first()["j"] == '{"a":null,"b":1}'


def test_vectors(spark):
    row = spark.createDataFrame([([3.0, 4.0, 1.0], [0.0, 0.0, 0.0])], "a array<double>, b array<double>").select(
        vector.cosine(F.col("a"), F.col("a")).alias("same"), vector.cosine(F.col("a"), F.col("b")).alias("zero"), vector.truncated(F.col("a"), 2).alias("cut"), vector.truncated(F.col("b"), 2).alias("none")
    )
    r = row.first()
    assert r.same == pytest.approx(1) and r.zero == 0 and r.cut == pytest.approx([0.6, 0.8]) and r.none is None


def test_collection_paths(spark):
    """Trees, children of absent parents, a ring of four with something hanging on it, a folder that is its own parent, folders without names."""
    rows = [("k1", "shelf", None), ("k2", "left", "k1"), ("k3", "", "k2"), ("k4", "deep", "k3"), ("k5", "lost", "nowhere"), ("k6", "lost too", "k5")]
    rows += [(f"r{i}", f"ring{i}", f"r{(i + 1) % 4}") for i in range(4)] + [("h1", "hook", "r2"), ("h2", "coat", "h1"), ("own", None, "own"), ("k7", "other shelf", "")]
    want = {"k1": "shelf", "k2": "shelf/left", "k3": "shelf/left/[unnamed:k3]", "k4": "shelf/left/[unnamed:k3]/deep", "k5": "[missing:nowhere]/lost", "k6": "[missing:nowhere]/lost/lost too"}
    want |= {f"r{i}": f"[cycle]/r{i}/ring{i}" for i in range(4)}
    want |= {"h1": "[cycle]/r2/ring2/hook", "h2": "[cycle]/r2/ring2/hook/coat", "own": "[cycle]/own/[unnamed:own]", "k7": "other shelf"}
    got = graph.collection_paths(spark.createDataFrame(rows, "key string, name string, parent_key string")).collect()
    assert {r.key: r.path for r in got} == want


def test_packing(spark):
    docs = spark.createDataFrame([(1, "a b\n\nc d e\n\n" + "x " * 9 + "\n\nlast"), (2, "")], "id int, text string")
    got = [(r.id, r.chunk_index, r.token_count) for r in chunking.chunks(docs, "id", "text", 5).orderBy("id", "chunk_index").collect()]
    assert got == [(1, 0, 5), (1, 1, 9), (1, 2, 1)]


def test_overlapping_segments(spark):
    rows = spark.createDataFrame([("p", 0, 10), ("p", 5, 6), ("p", 10, 12), ("q", 0, 3)], "k string, b int, e int")
    assert [(r.k, r.b) for r in provenance.overlapping(rows, "k", "b", "e").collect()] == [("p", 5)]


def test_sources(spark, tmp_path):
    rows = [(1, "b", "ready", "t", ["z", "a", "z"], "c", "m", "u"), (1, "a", "missing_pdf", "t", None, None, "m", "u")]
    df = spark.createDataFrame(rows, files.SNAPSHOT)
    files.write_jsonl(df, str(tmp_path / "s"), "document_id")
    assert [(r.document_id, r.tags) for r in files.read_snapshot(spark, str(tmp_path / "s")).collect()] == [("b", ["a", "z"])]
    with pytest.raises(ValueError, match="not unique"):
        files.write_jsonl(df.union(df), str(tmp_path / "t"), "document_id")
    files.write_jsonl(df.withColumn("schema_version", F.lit(9)), str(tmp_path / "v"), "document_id")
    with pytest.raises(Exception, match="unknown schema version"):
        files.read_snapshot(spark, str(tmp_path / "v")).collect()
    assert files.write_chunks(df, str(tmp_path / "c")) == 2
    new = df.where("document_id = 'b'").withColumn("title", F.lit("new"))
    assert {(r.document_id, r.title) for r in files.replace_documents(df, new, "document_id").collect()} == {("a", "t"), ("b", "new")}


def test_delta_stream_equals_fold(spark, tmp_path):
    schema = "sequence long, doc string, operation string, value int"
    log = [(1, "a", "upsert", 1), (2, "b", "upsert", 2), (3, "a", "delete", None), (4, "b", "upsert", 3), (5, "c", "upsert", 4)]
    for i, part in enumerate((log[:2], log[2:4], log[4:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(str(tmp_path / "log" / f"{i}"))
    state = {"df": spark.createDataFrame([], "sequence long, doc string, value int")}

    def apply(batch, _):
        rows = deltas.merged(state["df"], batch, "doc").collect()
        state["df"] = spark.createDataFrame([(r.sequence, r.doc, r.value) for r in rows], "sequence long, doc string, value int")

    deltas.consume(spark, str(tmp_path / "log" / "*"), schema, str(tmp_path / "cp"), apply).awaitTermination()
    fold = changelog.folded(spark.createDataFrame(log, schema), "doc", "sequence", "operation")
    assert {(r.doc, r.value) for r in state["df"].collect()} >= {("b", 3), ("c", 4)}
    assert {(r.doc, r.value) for r in fold.collect()} == {("b", 3), ("c", 4)}


def test_pending_deltas(spark):
    catalog = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "sequence long, delta_sha256 string")
    assert [r.sequence for r in deltas.pending(catalog, catalog.where("sequence = 1")).collect()] == [2, 3]
    with pytest.raises(ValueError, match="vanished or changed"):
        deltas.pending(catalog, spark.createDataFrame([(1, "other")], "sequence long, delta_sha256 string"))


def test_merged_deltas_keep_tombstones(spark):
    schema = "sequence long, doc string, operation string, value int"
    state = spark.createDataFrame([], "sequence long, doc string, operation string, value int")
    for part in ([(2, "b", "upsert", 2), (3, "a", "delete", None)], [(1, "a", "upsert", 1), (4, "b", "upsert", 3)], [(5, "c", "upsert", 4), (6, "c", "delete", None), (7, "d", "upsert", 5)]):
        state = deltas.merged(state, spark.createDataFrame(part, schema), "doc")
    assert {(r.sequence, r.doc, r.value) for r in deltas.live(state).collect()} == {(4, "b", 3), (7, "d", 5)}


def test_delta_files_follow_their_catalogue(spark, tmp_path):
    folder = tmp_path / "deltas"
    folder.mkdir()
    row = '{"schema_version":1,"sync_id":"%s","operation":"%s","document_id":"d%d"}\n'
    (folder / "a.jsonl").write_text(row % ("s1", "upsert", 1) + row % ("s1", "delete", 2))
    (folder / "b.jsonl").write_text(row % ("s2", "upsert", 3))
    schema = "sequence long, sync_id string, delta_path string, row_count long"
    good = [(1, "s1", "deltas/a.jsonl", 2), (2, "s2", "deltas/b.jsonl", 1)]
    got = files.read_deltas(spark, spark.createDataFrame(good, schema), str(folder))
    assert sorted((r.sequence, r.document_id) for r in got.collect()) == [(1, "d1"), (1, "d2"), (2, "d3")]
    for bad in ([(1, "s1", "deltas/a.jsonl", 3)], [(1, "sx", "deltas/a.jsonl", 2)], [(1, "s1", "../a.jsonl", 2)]):
        with pytest.raises(ValueError):
            files.read_deltas(spark, spark.createDataFrame(bad, schema), str(folder))
    catalog = files.append_catalog(spark.createDataFrame(good, schema), spark.createDataFrame([(0, "s3", "deltas/c.jsonl", 0)], schema))
    assert sorted(r.sequence for r in catalog.collect()) == [1, 2, 3]
    with pytest.raises(ValueError):
        files.append_catalog(catalog, spark.createDataFrame(good[:1], schema))
