"""Each operator against a brute-force version on small tables with nulls, ties, copies and long texts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import bpe, exact_dedup, idcoder, idfiles, jaccard_join, licenses, maxscore, mixing, perspectives, substring_dedup, toxicity
from lodestone.llm.shared import CellFilter, ascii_lower

LOW = -(10**18)


def low(x):
    return LOW if x is None else x


# ---- shared


def test_cell_filter_has_no_false_negatives(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(-(2**62), 2**62, 3000)
    twice = values[:1000]
    df = spark.createDataFrame([(int(v),) for v in [*values, *twice]], "h bigint").repartition(5)
    seen = CellFilter.build(df, 4000)
    assert seen.maybe_repeated(twice).all()
    assert seen.maybe_repeated(values[1000:]).mean() < 0.05


# ---- toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    words = ["w" + str(i) for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = [str(x) for x in rng.choice(words, 40)]
        if i % 5 == 0:
            text[3:6] = [["nasty", "vilefoe", "grimble"][k] + ["", "s", "est"][i % 3] for k in rng.integers(0, 3, 3)]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    rows += [(None, "nasty nasty nasty"), (1000, None), (1001, ""), (7, rows[7][1])]
    labels += [(None, 1), (2000, None), (5, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_catches_held_out_rows(labelled):
    docs, labels = labelled
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 404
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        if r.doc_id is not None and r.doc_id < 400:
            assert r.predicted == int(r.doc_id % 5 == 0), r
    assert next(r for r in got if r.doc_id == 1000).score == next(r for r in got if r.doc_id == 1001).score
    kept = toxicity.accepted(docs, toxicity.fit(docs, labels)).collect()
    assert len(kept) == sum(1 - r.predicted for r in got)


def test_block_max_search_is_exact(labelled):
    docs, labels = labelled
    index = toxicity.fit(docs, labels)
    vectors = defaultdict(dict)
    for t, blocks in enumerate(index.lists):
        for b, (most, at, weights) in blocks.items():
            assert most == pytest.approx(weights.max())
            for i, w in zip(at, weights, strict=True):
                vectors[b * toxicity.BLOCK + int(i)][t] = w
    for text in ["nasty vilefoe w1 w2", "grimbles nastyest nastys", "vilefoeest"]:
        query = index._weights(toxicity.term_counts(text, index.number))
        every = sorted(((-sum(w * v.get(t, 0) for t, w in query.items()), i) for i, v in vectors.items()))
        every = [(-s, i) for s, i in every if s < 0][: toxicity.NEIGHBOURS]
        assert [round(s, 9) for s, _ in index.nearest(toxicity.term_counts(text, index.number))] == [round(s, 9) for s, _ in every]


def test_toxicity_without_labels(docs, empty, labelled):
    labels = labelled[1]
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


# ---- licenses


def base_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    at = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(at)


def test_license_base(docs, rows):
    got = licenses.detections(docs).collect()
    want = Counter()
    for r in rows:
        n, at = base_places(r[1])
        want[(low(r[0]), n, len(at), low(at[0][0] if at else None), low(at[-1][0] if at else None), ",".join(sorted({x for _, x in at})))] += 1
    assert Counter((low(r.doc_id), r.n_words, r.n_base, low(r.first_word), low(r.last_word), r.base_labels) for r in got) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0", {"apache", "apache-2.0"}),
        ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0-or-later"}),
        ("under CC BY-NC-SA 4.0.", {"cc-by", "cc-by-nc-sa-4.0"}),
        ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
        ("the GNU General Public License, version 3", {"gpl", "gpl-3.0"}),
        ("summit license, accby", set()),
        ("MIT License and MIT License", {"mit"}),
    ],
)
def test_license_rules(text, labels):
    _, base, found = licenses.scan(text)
    assert {x for _, x in base} | {d.label for d in found} == labels


def test_license_suppression_by_containment():
    text = "under the MIT License, and the GNU Lesser General Public License version 3, Apache 2.0 " * 5
    _, _, found = licenses.scan(text)
    for d in found:
        assert not any(o is not d and o.priority < d.priority and o.first <= d.first and d.last <= o.last for o in found)
    assert len(licenses._machine()) > 100


# ---- perspectives


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, None, "who"), (1, 3, None, "who"), (2, None, "ann", "solo"), (None, 1, "zed", "n"), (3, 1, "system", "alone")]
    rows += [(9, 0, f"r{i % 2}", f"m{i}") for i in range(200)]
    got = perspectives.rotate(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    by = {(r.conv_id, r.perspective): r for r in got if r.conv_id != 9}
    assert set(by) == {(1, "ann"), (1, "bob"), (2, "ann"), (None, "zed")}
    r = by[1, "ann"]
    assert r.rendered == "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>user\nwho<|im_end|>\n"
    a, b = map(int, r.loss_spans.split("-"))
    assert r.rendered[a:b] == "hi < |im_end|><|im_end|>" and (r.n_messages, r.n_trained) == (4, 1)
    hot = [r for r in got if r.conv_id == 9]
    assert max(r.n_messages for r in hot) < 80
    for who in ("r0", "r1"):
        assert sum(r.n_messages for r in hot if r.perspective == who) == 200 and sum(r.n_trained for r in hot if r.perspective == who) == 100
    for r in got:
        for span in filter(None, r.loss_spans.split(",")):
            a, b = map(int, span.split("-"))
            assert r.rendered[a:b].endswith("<|im_end|>") and r.rendered[:a].endswith("<|im_start|>assistant\n")


def test_perspectives_empty(spark):
    assert perspectives.rotate(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


# ---- MaxScore


def brute_top(rows, every, k):
    good = [(i, r[0], [int(np.floor(256 * x)) for x in r[1]]) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    out = Counter()
    for i, q, v in good:
        if q is not None and q % every == 0:
            hits = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), c is None, low(c)) for j, c, w in good if j != i)[:k]
            out.update((q, n, low(None if null else c), -s) for n, (s, null, c) in enumerate(hits, 1))
    return out


@pytest.mark.parametrize("dims", [1, 3, 24])
def test_maxscore(spark, dims, monkeypatch):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(dims)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, dims)], "x") for i in range(300)]
    rows += [(i + 300, rows[5][1], "y") for i in range(100)]  # a common vector
    rows += [(400, None, "z"), (401, [None] * dims, "z"), (402, [float("nan")] * dims, "z"), (None, rows[3][1], "z"), (10, rows[3][1], "z"), (10, rows[3][1], "z"), (403, [2.0e6] * dims, "z")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string").repartition(3)
    got = maxscore.top_k(df, F.col("id") % 10 == 0)
    assert Counter((r.query_id, r["rank"], low(r.vec_id), r.score) for r in got.collect()) == brute_top(rows, 10, 5)
    assert maxscore.top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_maxscore_prunes():
    rng = np.random.default_rng(0)
    terms = rng.integers(-200, 200, (16, 500)).astype(np.float32)
    ids = np.arange(500)
    for s in range(30):
        q = rng.integers(-200, 200, 16) * (rng.random(16) < 0.4)
        got = maxscore.search_shard(q, -1, ids, ids, np.ones(500, bool), terms, terms.min(axis=1), terms.max(axis=1), 5)
        scores = q @ terms.astype(int)
        assert got == [(int(-x), int(i)) for x, i in sorted(zip(-scores, ids, strict=True))[:5]], s


# ---- byte-level BPE


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1 \n\t.,'é漢  😀", max_size=400))
def test_bpe_pieces_are_safe(text):
    coder = bpe.encoding(bpe.rank_file(), bpe.default_pattern())
    ids = [i for piece in bpe.pieces(text, 5) for i in coder.encode_ordinary(piece)]
    assert "".join(bpe.pieces(text, 5)) == text and ids == coder.encode_ordinary(text)
    assert coder.decode_bytes(ids) == text.encode()


def test_bpe(docs, rows, empty):
    coder = bpe.encoding(bpe.rank_file(), bpe.default_pattern())
    want = Counter()
    for r in rows:
        ids = coder.encode_ordinary(r[1] or "")
        want[(low(r[0]), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())] += 1
    assert Counter((low(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs).collect()) == want
    assert Counter(bytes(r.raw) for r in bpe.decode(bpe.encode(docs)).collect()) == Counter((r[1] or "").encode() for r in rows)
    assert bpe.digests(empty).count() == 0


# ---- exact dedup


def test_exact_dedup(docs, rows, empty):
    groups = defaultdict(list)
    for r in rows:
        groups[ascii_lower(r[1] or "")].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=low)
        for i in ids:
            want[(low(i), low(keep), len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    got = exact_dedup.assignments(docs).collect()
    assert Counter((low(r.doc_id), low(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns and sorted(low(r.doc_id) for r in out.collect()) == sorted(low(r.doc_id) for r in got if r.kept)
    assert exact_dedup.assignments(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


# ---- substring dedup


def brute_windows(rows):
    first = {}
    for r in rows:
        w = (r[1] or "").encode().split()
        for j in range(len(w) - 19):
            key, at = tuple(w[j : j + 20]), (low(r[0]), j)
            first[key] = min(first.get(key, at), at)
    out = Counter()
    for r in rows:
        w = (r[1] or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            if first[tuple(w[j : j + 20])] < (low(r[0]), j):
                gone[j : j + 20] = [True] * 20
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[(low(r[0]), len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())] += 1
    return out


def test_substring_dedup(docs, rows, empty):
    assert Counter((low(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(docs).collect()) == brute_windows(rows)
    assert substring_dedup.digests(empty).count() == 0
    out = substring_dedup.deduplicate(docs)
    assert out.columns == docs.columns and out.count() == len(rows)


def test_substring_dedup_cuts_hot_minimisers(spark, monkeypatch):
    """One line in many contexts, and texts of one repeated word or a short period."""
    rng = np.random.default_rng(5)
    line = " ".join(f"c{i}" for i in range(9))
    rows = [(i, " ".join(f"u{x}" for x in rng.integers(0, 50, 15)) + " " + line + " " + " ".join(f"v{x}" for x in rng.integers(0, 50, 15)), "a") for i in range(150)]
    rows += [(500, "same " * 300, "a"), (501, "p q r " * 60, "b"), (502, "q r p " * 60, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, words string")
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(df).collect()) == brute_windows(rows)


# ---- token ids in blocks


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60000), max_size=300), st.integers(1, 8))
def test_id_coder_round_trip(ids, repeat):
    ids = np.array(ids * repeat, np.int64)
    block = idcoder.encode(ids)
    assert (idcoder.decode(block) == ids).all()
    if len(block) > 24:
        with pytest.raises(ValueError, match="cut or changed"):
            idcoder.decode(block[:-1])
        with pytest.raises(ValueError, match="cut or changed"):
            idcoder.decode(block[:22] + bytes([block[22] ^ 1]) + block[23:])


def test_id_coder_compresses():
    ids = np.tile(np.arange(500), 200)
    assert len(idcoder.encode(ids)) < len(ids)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab1 \n\t\r.,'é \0", max_size=200))
def test_encoder_pieces_are_safe(text):
    coder = idfiles.encoder(idfiles.tokenizer_file())
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_id_files(docs, rows, empty, monkeypatch):
    coder = idfiles.encoder(idfiles.tokenizer_file()).tokenizer
    got = sorted(idfiles.read(idfiles.write(docs)).collect(), key=lambda r: r.start)
    assert [low(r.doc_id) for r in got] == sorted(low(r[0]) for r in rows)
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:], strict=False)) and got[0].start == 0
    want = Counter()
    for r in rows:
        ids = np.array([*coder.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want[(low(r[0]), len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((low(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    assert idfiles.read(idfiles.write(empty)).count() == 0


# ---- Jaccard join


def brute_components(rows, size, percent):
    sets = []
    for r in rows:
        w = ascii_lower(r[1] or "").encode().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return Counter((low(r[0]), len(sets[i]), low(least.get(root(i)))) for i, r in enumerate(rows))


@pytest.mark.parametrize(("size", "percent", "small"), [(3, 90, 48), (5, 80, 4)])
def test_jaccard_join(docs, rows, size, percent, small, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    got = jaccard_join.assignments(docs, shingle=size, percent=percent).collect()
    assert Counter((low(r.doc_id), r.n_shingles, low(r.component_id)) for r in got) == brute_components(rows, size, percent)


def test_jaccard_representatives(docs, empty):
    out = jaccard_join.representatives(docs, shingle=5, percent=80)
    assert out.columns == docs.columns
    classes = jaccard_join._classes(docs, "doc_id", "text", 5, 80)
    assert out.count() == classes.select("c").distinct().count()
    assert jaccard_join.assignments(empty).count() == 0


def test_components_of_a_long_chain(spark):
    n = 60
    links = spark.createDataFrame([((i * 37) % 61, ((i + 1) * 37) % 61) for i in range(n)], "a bigint, b bigint")
    names = jaccard_join.components(links).collect()
    assert len(names) == 61 and len({r.name for r in names}) == 1


# ---- mixing


def brute_mix(rows):
    sizes = [len((r[1] or "").encode().split()) for r in rows]
    order = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(z for z, r in zip(sizes, rows, strict=True) if r[3] == s) for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full: set = set()
    while True:
        rest, w = sum(total.values()) - sum(3 * total[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * total[s] if s in full else rest * weight[s] / w for s in order}
        over = {s for s in order if target[s] > 3 * total[s]}
        if not over:
            return sizes, total, target
        full |= over


def test_mixing(docs, rows, empty):
    _, total, target = brute_mix(rows)
    first = mixing.taken(docs).collect()
    got = defaultdict(int)
    of = {n: s for s, n in total.items()}
    assert len(of) == len(total)
    for r in first:
        s = of[r.source_size]
        assert r.source_size == total[s] and r.target == pytest.approx(target[s]) and r.taken <= 3 * r.size
        got[s] += r.taken
    for s in total:
        most = max(len((r[1] or "").split()) for r in rows if r[3] == s)
        assert abs(got[s] - target[s]) <= most
    again = mixing.taken(docs).collect()
    assert Counter(map(str, first)) == Counter(map(str, again))
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert sum(len((r.text or "").encode().split()) for r in out.collect()) == sum(r.taken for r in first)
    assert mixing.taken(empty).count() == 0


def test_mixing_refines_the_boundary_bucket(docs, monkeypatch):
    whole = Counter(map(str, mixing.taken(docs).collect()))
    monkeypatch.setattr(mixing, "SMALL_BUCKET", 8)
    assert Counter(map(str, mixing.taken(docs).collect())) == whole


def test_substring_dedup_cuts_buckets(spark, docs, rows, monkeypatch):
    """Buckets of more than a few strings are cut into windows; small chunks and batches."""
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    assert Counter((low(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(docs).collect()) == brute_windows(rows)


def test_substring_dedup_without_filter(docs, rows, monkeypatch):
    monkeypatch.setattr(CellFilter, "MAX_MEMBERS", 1)
    assert Counter((low(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(docs).collect()) == brute_windows(rows)


def test_exact_dedup_in_ranges(docs, monkeypatch):
    """More rows than one filter has room for."""
    want = Counter(map(tuple, exact_dedup.assignments(docs).collect()))
    kept = Counter(map(tuple, exact_dedup.deduplicate(docs).collect()))
    monkeypatch.setattr(CellFilter, "SEGMENT", 512)
    monkeypatch.setattr(CellFilter, "MAX_CELLS", 512)
    assert Counter(map(tuple, exact_dedup.assignments(docs).collect())) == want
    assert Counter(map(tuple, exact_dedup.deduplicate(docs).collect())) == kept


def test_jaccard_join_of_many_near_copies(spark, monkeypatch):
    """2000 near copies of one text, in regions that must be dealt again."""
    rng = np.random.default_rng(11)
    base = [f"b{i}" for i in range(80)]
    made = []
    for i in range(2000):
        own = list(base)
        for at in rng.integers(0, 80, rng.integers(0, 4)):
            own[at] = f"e{rng.integers(0, 60)}"
        made.append((i, " ".join(own), None, None))
    want = brute_components(made, 3, 90)
    monkeypatch.setattr(jaccard_join, "SMALL", 300)
    df = spark.createDataFrame([r[:2] for r in made], "doc_id bigint, text string")
    assert Counter((low(r.doc_id), r.n_shingles, low(r.component_id)) for r in jaccard_join.assignments(df).collect()) == want


def test_jaccard_join_deals_a_large_group_once(spark, monkeypatch):
    """Near copies of one text share most cells of their windows; they are dealt as one region, and to few cells each."""
    rng = np.random.default_rng(12)
    made = []
    for i in range(600):
        own = [f"b{j}" for j in range(80)]
        for at in rng.integers(0, 80, int(rng.integers(1, 9))):
            own[at] = f"e{i}x{at}"
        made.append((i, " ".join(own), None, None))
    want = brute_components(made, 3, 80)
    monkeypatch.setattr(jaccard_join, "SMALL", 150)
    plain, rows = jaccard_join._dealt, []

    def counted(large, sets, percent):
        links, cells = plain(large, sets, percent)
        rows.append((large.count(), cells.count()))
        return links, cells

    monkeypatch.setattr(jaccard_join, "_dealt", counted)
    df = spark.createDataFrame([r[:2] for r in made], "doc_id bigint, text string")
    assert Counter((low(r.doc_id), r.n_shingles, low(r.component_id)) for r in jaccard_join.assignments(df, percent=80).collect()) == want
    assert rows and sum(n for n, _ in rows) <= 2 * 600
    assert sum(n for _, n in rows) <= 25 * 600
