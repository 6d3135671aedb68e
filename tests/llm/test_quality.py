"""The quality rules and the log-likelihood ratio against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
import xxhash

from lodestone.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def hashed(*words):
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h)
    return h


def counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def grams(text):
    words = WORDS.findall(text or "")
    return [hashed(w) % quality.BUCKETS for w in words] + [hashed(a, b) % quality.BUCKETS for a, b in zip(words, words[1:], strict=False)]


def verdicts(rows, labels):
    """(score, kept) of (id, text) rows."""
    seen = {}
    for i, label in labels:
        seen.setdefault(i, []).append(label)
    good = [i for i, x in seen.items() if i is not None and min(y for y in x) == 1]
    key = {i: xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), seed=42) for i in good}
    fits = {i for i in good if (key[i] >> 17) % 2 == 0}
    raw, target = Counter(), Counter()
    for i, text in rows:
        found = grams(text)
        raw.update(found)
        if i in fits:
            target.update(found)
    n_raw, n_target = sum(raw.values()), sum(target.values())

    def share(n, total):
        added = quality.SMOOTHING * total / quality.BUCKETS
        return (n + added) / (total + quality.BUCKETS * added)

    weight = {b: round(1e6 * math.log(share(target[b], n_target) / share(raw[b], n_raw))) if n_target else 0 for b in raw}
    scores = [sum(weight[b] for b in grams(t)) // max(1, len(grams(t))) for _, t in rows]
    held = sorted(s for (i, _), s in zip(rows, scores, strict=True) if i in key and i not in fits)
    limit = held[max(0, math.ceil(quality.REJECTED * len(held)) - 1)] if held else None
    return [(s, not counts(t)[-1] and (limit is None or s >= limit)) for (_, t), s in zip(rows, scores, strict=True)]


def check(docs, labels, rows, marked):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.score, r.kept) for r in quality.verdicts(docs, labels).collect())
    want = Counter((i, *counts(t), *v) for (i, t), v in zip(rows, verdicts(rows, marked), strict=True))
    assert got == want


def labelled(spark, marked):
    return spark.createDataFrame(marked, "doc_id bigint, quality int")


def test_quality_equals_brute_force(spark, docs, rows):
    marked = [(i, int(i % 3 > 0)) for i in range(1, 130)] + [(None, 1), (4, 0), (9999, 1), (5, 1)]
    check(docs, labelled(spark, marked), [(r[0], r[1]) for r in rows], marked)


def test_quality_of_junk_and_clean_texts(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    clean = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(60, 150)))
    junk = lambda: " ".join(rng.choice(words) + "###" for _ in range(80))
    rows = [(i, junk() if i % 5 == 0 else clean()) for i in range(600)]
    marked = [(i, int(i % 5 > 0)) for i in range(0, 600, 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    check(df, labelled(spark, marked), rows, marked)
    kept = {r.doc_id for r in quality.verdicts(df, labelled(spark, marked)).where("kept").collect()}
    assert not [i for i in kept if i % 5 == 0]
    assert len([i for i in kept if i % 5]) >= 0.95 * 480


@pytest.mark.parametrize("marked", [[], [(1, 0), (2, None)]], ids=["none", "bad"])
def test_quality_without_trusted_rows(spark, marked):
    rows = [(1, "a b c " * 10 + " ".join(f"w{i}" for i in range(60))), (2, None), (3, " \n "), (None, "x y\nx y\n x y"), (4, "é ß <|" * 30)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), labelled(spark, marked), rows, marked if not marked else [(1, 0)])


def test_quality_of_repetition_and_long_texts(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(60_000))
    many = " ".join(f"a{i} b{i} c{i}" for i in range(30)) + " "
    rows = [(1, long), (2, many * 2), (3, many + "x " + many), (4, "a " * 3), (5, "a b c a b c"), (6, "z" * 300_000), (7, "a a a a"), (8, "ab" * 3 + "\n\n \n" * 4)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), labelled(spark, []), rows, [])


def test_quality_of_an_empty_table(spark, empty):
    assert quality.verdicts(empty, labelled(spark, [(1, 1)])).count() == 0


def test_all_good_labels_are_trusted(spark):
    made = quality.trusted_ids(spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality"))
    assert made.count() == 30_000 and 14_000 < made.where("fits").count() < 16_000


@pytest.mark.parametrize("cells", [1 << 26, 256])
def test_targets_beyond_a_broadcast(spark, monkeypatch, cells):
    monkeypatch.setattr(quality, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(quality, "FILTER", cells)
    docs = spark.createDataFrame([(i if i < 2000 else None, f"t{i}") for i in range(2010)] + [(6, "again")], "id bigint, text string")
    trusted = spark.range(500).selectExpr("id * 3 AS trusted_id", "id % 2 = 0 AS fits")
    got = Counter((r.id, r.text) for r in quality.targets(docs, trusted).collect())
    assert got == Counter([(i, f"t{i}") for i in range(0, 1500, 6)] + [(6, "again")])


def test_quantile(spark):
    rng = random.Random(4)
    for n in (0, 1, 7, 100, 1501):
        scores = [rng.choice([-5, 3, rng.randint(-20_000, 20_000)]) for _ in range(n)]
        want = sorted(scores)[max(0, math.ceil(0.01 * n) - 1)] if n else None
        assert quality.quantile(spark.createDataFrame([(s,) for s in scores], "score bigint"), 0.01) == want
