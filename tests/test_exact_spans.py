"""Proposals by sentences and by quotations: unique, covered spans become evidence, all others are refused with a reason."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from lodestone.functions import code
from lodestone.operators import exact_spans

TEXT = "  First one here. Second, with 3 numbers! Is this the third?  The best last"
SEG = "array<struct<begin:int,end:int,self_ref:string,page_no:bigint,bbox:struct<l:double,t:double,r:double,b:double>>>"
BOX = (0.0, 0.0, 1.0, 1.0)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def paragraphs(spark, rows):
    return spark.createDataFrame([(i, "zotero:1", "fp", "experiment", t, h or sha(t), s) for i, t, h, s in rows], f"paragraph_id string, document_id string, parse_fingerprint string, family string, text string, text_hash string, segments {SEG}")


def test_sentence_spans_equal_a_plain_scan(spark):
    rng = random.Random(2)
    texts = [TEXT, "", " \n ", "no end", "a.b c. d!? e", "一。二！三", "x.\n\n y?\n", "tail \n", None] + ["".join(rng.choice("ab. !?\n。é\t") for _ in range(rng.randrange(60))) for _ in range(300)]
    got = {}
    for r in code.sentence_spans(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "k", "t").orderBy("k", "n").collect():
        got.setdefault(r.k, []).append((r.begin, r.end))
    pattern, want = re.compile(r"\S(?:.*?)(?:[.!?]+(?=\s|$)|[。！？]+|$)", re.S), {}
    for k, t in enumerate(texts):
        found = [(m.start(), m.start() + len(m[0].rstrip())) for m in pattern.finditer(t or "")]
        if found:
            want[k] = found
    assert got == want


def test_gate(spark):
    whole, part = [(0, len(TEXT), "#/1", 3, BOX)], [(0, 20, "#/1", 3, BOX), (20, 40, "#/2", 4, BOX)]
    ps = paragraphs(spark, [("p1", TEXT, None, whole), ("p2", TEXT, None, part), ("p3", TEXT, "other", whole), ("p4", TEXT, None, []), ("p5", "aaa bb bb", None, [(0, 9, "#/1", 1, BOX)])]).cache()
    known = exact_spans.sentences(ps).cache()
    ids = {(r.paragraph_id, r.n): r.sentence_id for r in known.collect()}
    assert len(set(ids.values())) == len(ids) == 4 * 4 + 1
    s = lambda p, *n: [ids[p, i] for i in n]
    by_ids = [("a", "p1", s("p1", 0, 1)), ("b", "p1", s("p1", 1, 0)), ("c", "p1", s("p1", 0, 2)), ("d", "p1", s("p2", 0)), ("e", "p1", []), ("f", "p2", s("p2", 0)), ("g", "p2", s("p2", 1)), ("h", "p2", s("p2", 0, 1)), ("i", "p3", s("p3", 3)), ("j", "p4", s("p4", 0)), ("k", "no", s("p1", 0)), ("l", "p1", None), ("m", "p1", s("p1", 3))]
    proposals = spark.createDataFrame([(i, p, n, "result_reporting", "strong", ["vague_claim"] if i == "m" else None, 1.0) for i, p, n in by_ids], "proposal_id string, paragraph_id string, sentence_ids array<string>, category string, claim_strength string, risk_flags array<string>, confidence double")
    got = {r.proposal_id: r for r in exact_spans.evidence(proposals, exact_spans.selected(proposals, known), ps, known).collect()}
    assert {i: r.error for i, r in got.items()} == {"a": None, "b": "sentences not contiguous", "c": "sentences not contiguous", "d": "sentence not in paragraph", "e": "no sentence", "f": None, "g": "not covered by places", "h": "not covered by places", "i": "paragraph changed", "j": "no place", "k": "unknown paragraph", "l": "no sentence", "m": None}
    assert got["a"].original_text == "First one here. Second, with 3 numbers!" and (got["a"].char_start, got["a"].char_end, got["a"].sentence_ids) == (2, 41, s("p1", 0, 1))
    assert (got["f"].page_start, got["f"].page_end, len(got["f"].source_spans)) == (3, 3, 1)
    assert got["m"].risk_flags == ["unsupported_superlative", "vague_claim"] and got["m"].risk_flag_sources == {"unsupported_superlative": "deterministic_heuristic", "vague_claim": "model_assessment"}
    assert got["a"].validation_status == "validated" and got["a"].evidence_id.startswith("evidence:") and got["b"].evidence_id is None


def test_quotations(spark):
    ps = paragraphs(spark, [("p1", TEXT, None, [(0, len(TEXT), "#/1", 1, BOX)]), ("p5", "aaa bb bb", None, [(0, 9, "#/1", 1, BOX)])])
    rows = [("a", "p1", "First one"), ("b", "p1", "one here"), ("c", "p1", "first"), ("d", "p5", "aa"), ("e", "p5", "bb"), ("f", "p5", "a bb"), ("g", "p1", ""), ("h", "p1", None), ("i", "no", "x"), ("j", "p1", "First one"), ("k", "p1", "Second")]
    got = {r.proposal_id: (r.begin, r.end, r.error) for r in exact_spans.quoted(spark.createDataFrame(rows, "proposal_id string, paragraph_id string, original_text string"), ps).collect()}
    late = (None, None, "overlaps an earlier span")
    assert got == {"a": (2, 11, None), "b": late, "c": (None, None, "text not in paragraph"), "d": (None, None, "text stands twice"), "e": (None, None, "text stands twice"), "f": (2, 6, None), "g": (None, None, "no text"), "h": (None, None, "no text"), "i": (None, None, "unknown paragraph"), "j": late, "k": (18, 24, None)}
    assert code.sentence_spans(ps.where(F.lit(False)), "paragraph_id", "text").count() == 0


def test_spans_take_few_texts_along(spark):
    """Sentences do not meet their texts again one by one, and proposals are judged once."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab.. !?\n　。\x1c") for _ in range(rng.randrange(80))) for _ in range(60)]
    ps = paragraphs(spark, [(f"p{i}", t, None, [(0, len(t), "#/1", 1, BOX)]) for i, t in enumerate(texts)])
    asked = spark.createDataFrame([(f"{i}{j}", f"p{i}", t[j * 9 : j * 9 + 12], "future_work", "strong", None, 0.9) for i, t in enumerate(texts) for j in range(2)], "proposal_id string, paragraph_id string, original_text string, category string, claim_strength string, risk_flags array<string>, confidence double")
    made = lambda known: exact_spans.evidence(asked.drop("original_text"), exact_spans.quoted(asked, ps), ps, known)
    late, early = made(code.sentence_spans(ps, "paragraph_id", "text")), made(exact_spans.sentences(ps))
    told = ("error", "char_start", "char_end", "evidence_id", "sentence_ids")
    got = {r.proposal_id: tuple(r[c] for c in told) for r in late.collect()}
    assert got == {r.proposal_id: tuple(r[c] for c in told) for r in early.collect()} and len(got) == 120
    assert max(len(row[4] or ()) for row in got.values()) > 1
    pattern = re.compile(r"\S(?:.*?)(?:[.!?]+(?=\s|$)|[。！？]+|$)", re.S)
    for name, (error, begin, end, _, ids) in got.items():
        if error is None:
            spans = [(m.start(), m.start() + len(m[0].rstrip())) for m in pattern.finditer(texts[int(name[:-1])])]
            assert len(ids) == sum(b < end and e > begin for b, e in spans)
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and plan.count("Join ") == 4
