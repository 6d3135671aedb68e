"""The pipeline against a brute-force version, with nulls, empty texts, repeated rows, clashing columns and empty tables."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from lodestone.llm import bpe, mixing, toxicity
from lodestone.llm.shared import ascii_lower

WORDS = [f"w{i}" for i in range(300)]


def corpus():
    rng = random.Random(3)
    body = lambda n: [rng.choice(WORDS) for _ in range(n)]
    rows, labels = [], []
    for i in range(1, 241):
        words = body(rng.randint(20, 60))
        if i % 6 == 0:
            words[2:8] = ["nasty", "vile", "scum"] * 2
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if i % 6 else 1))
    base = body(80)
    for i in range(300, 320):  # near copies
        own = list(base)
        own[rng.randrange(80)] = f"edit{i}"
        rows.append((i, " ".join(own)))
    rows += [(400 + i, rows[4][1].upper()) for i in range(30)]  # copies
    rows += [(500, None), (501, ""), (502, " \t"), (None, "null id " + " ".join(body(20))), (503, "one"), rows[6], rows[6]]
    return [(i, t, "en", None if k % 9 == 0 else f"s{k % 3}", None, "x", "y") for k, (i, t) in enumerate(rows)], labels


def written(path, rows, labels):
    docs = pa.Table.from_pylist([dict(zip(("doc_id", "text", "lang", "source", "n_chars", "key", "row_position"), r, strict=True)) for r in rows], schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("key", pa.string()), ("row_position", pa.string())]))
    pq.write_table(docs, path / "documents.parquet", row_group_size=50)
    pq.write_table(pa.Table.from_pylist([{"doc_id": i, "toxic": y} for i, y in labels], schema=pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32())])), path / "labels.parquet")
    return str(path)


def brute(rows, predicted):
    """The (doc_id, text, source) that reach the mix: clean rows, of copies the last id, of near copies the first."""
    low = lambda x: -1 if x is None else x
    kept = [r for r in rows if not predicted[low(r[0]), r[1] or ""]]
    last = {}
    for r in kept:
        key = ascii_lower(r[1] or "")
        last[key] = max(last.get(key, r), r, key=lambda x: low(x[0]))
    kept = list(last.values())
    sets = []
    for r in kept:
        w = ascii_lower(r[1] or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(kept)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(kept)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    first = {}
    for i, r in enumerate(kept):
        rank = (r[0] is None, low(r[0]))
        if root(i) not in first or rank < first[root(i)][0]:
            first[root(i)] = (rank, r)
    return [r for _, r in first.values()]


def test_pipeline_by_brute_force(spark, tmp_path):
    rows, labels = corpus()
    sf_dir = written(tmp_path, rows, labels)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    predicted = {(-1 if r[0] is None else r[0], r[1] or ""): index.score(r[1])[0] >= 0.5 for r in rows}
    assert all(predicted[i, t] == (i % 6 == 0) for i, t, *_ in rows[:240])
    stages = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "byte_bpe":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        stages[name] = docs.collect()
    plain = lambda r: (-1 if r[0] is None else r[0], ascii_lower(r[1] or ""))
    want = brute(rows, predicted)
    assert sorted(map(str, map(plain, stages["jaccard_join"]))) == sorted(map(str, map(plain, want)))
    # the mix takes what its weights say of what reached it, and the encoder gives each row's ids
    mixed = spark.read.parquet(str(tmp_path / "jaccard_join"))
    times = sum(r.times for r in mixing.repeats(mixed).collect())
    assert len(stages["mixing"]) == times
    coder = bpe.encoding(bpe.rank_file(), bpe.default_pattern())
    ids = sorted((str(r.doc_id), list(r.ids)) for r in stages["byte_bpe"])
    assert ids == sorted((str(r.doc_id), coder.encode_ordinary(r.text or "")) for r in stages["mixing"])
    # runs agree, even where one is read after the next has started
    one, two = corpus_pipeline.run(spark, sf_dir), corpus_pipeline.run(spark, sf_dir)
    assert sorted((str(r.doc_id), r.n_tokens) for r in one.collect()) == sorted((str(r.doc_id), r.n_tokens) for r in two.collect()) == sorted((i, len(x)) for i, x in ids)


@pytest.mark.parametrize("labelled", [True, False])
def test_pipeline_of_an_empty_table(spark, tmp_path, labelled):
    rows, labels = corpus()
    assert corpus_pipeline.run(spark, written(tmp_path, rows[:0] if labelled else rows[:1], labels if labelled else [])).count() == (0 if labelled else 1)
