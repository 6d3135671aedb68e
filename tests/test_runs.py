"""Resumed runs: an interrupted one equals an unbroken one, and what doesn't fit refuses."""

import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestone.operators import runs

VERSIONS = {"rules": "1", "taxonomy": "2"}


def units(spark, n=60, changed=None):
    rows = [(f"u{i}" if i else None, "new" if i == changed else f"f{i}") for i in range(n)] + [("u3", "f3")]
    return spark.createDataFrame(rows, "unit string, fingerprint string").repartition(3)


def work(df):
    return df.select("unit", F.explode(F.array(F.lit(1), F.length("fingerprint"))).alias("value"))


def rows(df):
    return Counter((r.unit, r.value) for r in df.collect())


def test_an_interrupted_run_equals_an_unbroken_one(spark, tmp_path):
    whole = runs.resumed(units(spark), work, VERSIONS, f"file://{tmp_path}/a")
    calls = []

    def counted(df):
        calls.append(1)
        return work(df)

    folder = f"file://{tmp_path}/b"
    assert runs.resumed(units(spark), counted, VERSIONS, folder, most=3) is None
    shutil.rmtree(tmp_path / "b/manifests/part=2")  # torn: rows without a manifest
    assert runs.resumed(units(spark), counted, VERSIONS, folder, most=0) is None
    got = runs.resumed(units(spark).repartition(7), counted, VERSIONS, folder)
    assert rows(got) == rows(whole) == rows(work(units(spark))) and len(calls) == 3 + 6
    assert rows(runs.resumed(units(spark), counted, VERSIONS, folder)) == rows(whole) and len(calls) == 9


def test_changed_inputs_versions_and_rows_refuse(spark, tmp_path):
    folder = f"file://{tmp_path}/c"
    runs.resumed(units(spark), work, VERSIONS, folder, most=4)
    for change in (lambda: runs.resumed(units(spark, changed=7), work, VERSIONS, folder), lambda: runs.resumed(units(spark, 61), work, VERSIONS, folder), lambda: runs.resumed(units(spark), work, VERSIONS | {"rules": "2"}, folder), lambda: runs.resumed(units(spark), work, VERSIONS, folder, parts=2)):
        with pytest.raises(runs.Mismatch):
            change()
    work(units(spark)).limit(5).write.mode("overwrite").parquet(f"{folder}/rows/part=1")
    with pytest.raises(runs.Mismatch, match="part 1"):
        runs.resumed(units(spark), work, VERSIONS, folder)


def test_a_run_without_units(spark, tmp_path):
    assert runs.resumed(units(spark).limit(0), work, VERSIONS, f"file://{tmp_path}/d").count() == 0


def test_receipts(spark):
    packet = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "k int, t string")
    own = runs.digest(packet)
    decide = lambda *rows: spark.createDataFrame(rows, "k int, packet_digest string, accepted boolean")
    accepted, told = runs.receipt(packet, decide((1, own, True), (2, own, False)), "k")
    assert [r.k for r in accepted.collect()] == [1] and told == own == runs.digest(packet.repartition(4))
    for bad in (decide((1, "x", True)), decide((9, own, True)), decide((1, own, True), (1, own, True))):
        with pytest.raises(runs.Mismatch):
            runs.receipt(packet, bad, "k")
    receipts = spark.createDataFrame([("r1", "m", 1, "acknowledge"), ("r1", "m", 2, "reject"), ("r2", "m", 2, "acknowledge"), ("r3", "old", 3, "acknowledge"), ("r4", None, 4, "acknowledge")], "receipt_id string, manifest string, finding_id int, decision string")
    known, stale = runs.acknowledged(receipts, "m")
    assert [r.finding_id for r in known.collect()] == [1] and {r.receipt_id for r in stale.collect()} == {"r3", "r4"}


def test_the_query_covers_all_documents(spark, sf_dir):
    import re

    from lodestone import catalog

    got = Counter(map(tuple, catalog.QUERIES["i14_resumed_run"](spark, sf_dir).select("unit", "tokens").collect()))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert got == Counter((str(r.doc_id), max(1, len(re.findall(r"\S+", r.text or "")))) for r in docs)
