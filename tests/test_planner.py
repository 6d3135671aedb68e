"""Run plans and request batches against plain Python."""

import itertools
import random

import pytest

from lodestone.operators import planner
from lodestone.plans import requests

FACTS = "content string, metadata string, parse_fp string, chunk_fp string, embed_fp string"


def tables(spark, seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice(["x", "x", "x", "x", "y", None])
    status = lambda: rng.choice(["ready"] * 5 + ["failed", None])
    ids = [f"d{i:03}" for i in range(150)]
    lines = list(range(150))
    rng.shuffle(lines)
    now = {i: (rng.choice("ab"), line, *(pick() for _ in range(5))) for i, line in zip(ids, lines, strict=True) if rng.random() < 0.8}
    was = {i: (rng.choice("ab"), rng.random() < 0.8, *(pick() for _ in range(5)), *(status() for _ in range(5))) for i in ids if rng.random() < 0.8}
    changes = [(s, p, rng.choice(ids), rng.choice(["upsert", "upsert", "delete"]), rng.choice([True, True, False, None])) for s, p in itertools.product(range(3), range(20))]
    changes = [c for c in changes if c[3] == "delete" or c[2] in now]
    frames = (
        spark.createDataFrame([(i, *v) for i, v in now.items()], f"document_id string, attachment_key string, line int, {FACTS}"),
        spark.createDataFrame([(i, *v) for i, v in was.items()], f"document_id string, attachment_key string, active boolean, {FACTS}, parse string, chunk string, embed string, dense string, sparse string"),
        spark.createDataFrame(changes, "sequence int, place int, document_id string, operation string, ready boolean"),
    )
    return now, was, changes, frames


def stage(n, w, force):
    if w is None:
        return "parse"
    (content, metadata, parse_fp, chunk_fp, embed_fp), (_, _, *old) = n, w
    o_content, o_metadata, o_parse, o_chunk, o_embed, parse, chunk, embed, dense, sparse = old
    if force or content != o_content or parse != "ready" or parse_fp != o_parse:
        return "parse"
    if metadata != o_metadata:
        return "payload"
    if chunk != "ready" or chunk_fp != o_chunk:
        return "chunk"
    return "embed" if embed != "ready" or embed_fp != o_embed or dense != "ready" or sparse != "ready" else "skip"


def brute(now, was, changes, mode, limit=None, document_id=None, attachment_key=None, force=False, prune=False, parse_only=False):
    keep = lambda i, v: (document_id is None or i == document_id) and (attachment_key is None or v[0] == attachment_key)
    if mode == "incremental":
        last = {c[2]: c for c in sorted(changes, key=lambda c: (c[0], c[1]))}
        out = {}
        for i, c in last.items():
            gone = c[3] == "delete" or not c[4]
            out[i] = ("delete" if i in was and was[i][1] else "skip") if gone else stage(now[i][2:], was.get(i), False)
    elif mode in ("resume", "embed"):
        chosen = sorted(i for i, w in was.items() if w[1] and keep(i, w))
        own = {i: now[i][2:] if i in now else was[i][2:7] for i in chosen}
        if mode == "embed":
            chosen = [i for i in chosen if was[i][8] == "ready" and (force or was[i][9:] != ("ready",) * 3 or was[i][6] != own[i][4])]
        out = {i: "embed" if mode == "embed" else stage(own[i], was[i], False) for i in chosen[:limit]}
    else:
        chosen = sorted((i for i, n in now.items() if keep(i, n)), key=lambda i: now[i][1])[:limit]
        out = {i: stage(now[i][2:], was.get(i), force and mode != "reconcile") for i in chosen}
        if (prune or mode == "reconcile") and limit is document_id is attachment_key is None:
            out |= {i: "delete" for i, w in was.items() if w[1] and i not in now}
    only = parse_only or mode == "parse"
    return {i: "skip" if only and a == "embed" else a for i, a in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_plans(spark, seed):
    now, was, changes, frames = tables(spark, seed)
    every = planner.joined(*frames).cache()
    runs = [("full", {}), ("full", {"prune": True}), ("full", {"prune": True, "limit": 9}), ("full", {"force": True, "attachment_key": "a"}), ("reconcile", {"force": True}), ("incremental", {}), ("incremental", {"parse_only": True})]
    runs += [("resume", {"limit": 11, "force": True}), ("resume", {"document_id": "d003"}), ("parse", {}), ("parse", {"force": True, "limit": 3, "attachment_key": "b"}), ("embed", {}), ("embed", {"force": True, "limit": 5})]
    for mode, options in runs:
        got = planner.plan(every, mode, **options).collect()
        assert {r.document_id: r.action for r in got} == brute(now, was, changes, mode, **options), (mode, options)
        assert len({r.document_id for r in got}) == len(got)
    with pytest.raises(ValueError, match="no filters"):
        planner.plan(every, "incremental", limit=1)
    taken = {m: planner.consumed(frames[2], m).count() for m in planner.MODES}
    assert taken == {"full": 3, "reconcile": 3, "incremental": 3, "resume": 0, "parse": 0, "embed": 0} and planner.consumed(frames[2], "full", filtered=True).count() == 0
    assert {r.batch for r in planner.batches(frames[2]).collect()} == {1, 2, 3}


@pytest.mark.parametrize(("paragraphs", "sentences"), [(1, 1), (3, 5), (100, 7), (2, 100)])
def test_requests(spark, paragraphs, sentences):
    rng = random.Random(paragraphs)
    rows = [(d, i, rng.choice([0, 0, 1, 2, 3, 12, None])) for d in range(12) for i in range(rng.randrange(15))]
    got = requests.batched(spark.createDataFrame(rows, "d int, i int, n int").repartition(3), "d", "i", "n", paragraphs, sentences).collect()
    want = set()
    for d in range(12):
        batch, held, used = 0, set(), 0
        for _, i, n in sorted(r for r in rows if r[0] == d):
            for begin in range(0, n or 0, sentences):
                own = min(sentences, n - begin)
                if held and (len(held) >= paragraphs or used + own > sentences or i in held):
                    batch, held, used = batch + 1, set(), 0
                want.add((d, batch, i, begin, own))
                held, used = held | {i}, used + own
    assert {(r.d, r.batch, r.i, r.first_sentence, r.sentences) for r in got} == want and len(got) == len(want)


def test_requests_need_positive_limits(spark):
    with pytest.raises(ValueError, match="positive"):
        requests.batched(spark.range(1).selectExpr("id AS d", "id AS i", "id AS n"), "d", "i", "n", 0, 1)
