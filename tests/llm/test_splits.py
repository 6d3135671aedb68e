"""Results stay when a table's files are split otherwise in each scan, as when executors come and go."""

import itertools
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, jaccard_join, maxscore, mixing

SIZE, COST = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


def near(docs):
    return jaccard_join.assignments(docs, shingle=5, percent=80)


def kept(docs):
    return jaccard_join.representatives(docs, shingle=5, percent=80)


def found(docs):
    return maxscore.top_k(docs.select("doc_id", F.array(F.col("doc_id") % 13, F.col("doc_id") % 7, F.length("text") % 11).alias("v")), F.col("id") % 5 == 0, "doc_id", "v", scale=1)


@pytest.mark.parametrize("run", [near, kept, exact_dedup.deduplicate, mixing.mix, found], ids=["jaccard_join", "representatives", "exact_dedup", "mixing", "maxscore"])
def test_splits_may_change(spark, rows, tmp_path, monkeypatch, run):
    columns = [{"doc_id": 1000 + i, "text": r[1], "source": r[3]} for i, r in enumerate(rows)]
    pq.write_table(pa.Table.from_pylist(columns), tmp_path / "d.parquet", row_group_size=9)
    docs = spark.read.parquet(str(tmp_path / "d.parquet"))
    want = Counter(map(tuple, run(docs).collect()))
    sizes = itertools.cycle(["4096", "1000000", "9000"])
    old = {name: spark.conf.get(name) for name in (SIZE, COST)}
    seen = set()

    def shifted(f):
        def call(df, *args):
            out = f(df, *args)
            spark.conf.set(SIZE, next(sizes))
            seen.add(spark.read.parquet(str(tmp_path / "d.parquet")).rdd.getNumPartitions())
            return out

        return call

    for module in (jaccard_join, exact_dedup, mixing, maxscore):
        for name in ("stored", "checkpoint"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, shifted(getattr(module, name)))
    spark.conf.set(COST, "0")
    spark.conf.set(SIZE, next(sizes))
    try:
        got = Counter(map(tuple, run(docs).collect()))
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert len(seen) > 1
    assert got == want
