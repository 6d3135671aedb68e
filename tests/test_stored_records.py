"""Closed-schema checks: valid records of each kind, and one fault at a time."""

import copy
import json

from lodestone.operators import stored_records as stored

TRACE = {"analyzer_provider": "p", "analyzer_model": "m", "prompt_version": "1", "prompt_hash": "h", "analyzer_request_hash": "q", "analyzer_response_hash": "r", "taxonomy_version": "writing-taxonomy-v1", "cluster_id": None}
MATERIAL = {"evidence_ids": ["evidence:1", "evidence:2"], "category": "future_work", "language": "en", "quality_score": 1, "response_schema_version": "abstraction-v7", "schema_version": "writing-material-v1"} | TRACE
SPAN = {"self_ref": "#/texts/1", "source_start": 4, "source_end": 9, "paragraph_start": 10, "paragraph_end": 15, "page_no": 2, "bbox": {"l": 1}}
GOOD = {
    "evidence": {f: "x" for f in ("zotero_item_key", "attachment_key", "source_content_fingerprint", "parse_fingerprint", "parser_name", "parser_version", "section_id", "section_title", "section_family", "paragraph_id", "source_paragraph_hash")}
    | {"evidence_id": "evidence:1", "document_id": "zotero:1", "original_text": "éxact tex", "language": "zh", "category": "motivation", "claim_strength": "strong", "validation_status": "validated", "provenance_coverage": 0.5, "confidence": 0, "quality_score": 1.0, "section_path": ["A"], "sentence_ids": ["s"], "risk_flags": ["vague_claim"], "risk_flag_sources": {"vague_claim": "model_assessment"}, "page_start": 2, "page_end": 3, "char_start": 10, "char_end": 19}
    | {"source_spans": [SPAN, SPAN | {"source_start": 0, "source_end": 4, "paragraph_start": 15, "paragraph_end": 19, "page_no": 3}], "response_schema_version": "classification-v9", "schema_version": "evidence-v1"}
    | TRACE,
    "strategy": MATERIAL | {"strategy_id": "strategy:1", "asset_type": "strategy", "label": "l", "description": "d", "applicability": "a", "claim_strength_guidance": "g", "explanation_zh": "图", "explanation_en": "e", "steps": [], "risk_flags": []},
    "template": MATERIAL | {"template_id": "template:1", "asset_type": "template", "template_text": "t", "claim_strength_guidance": "g", "constraints": ["c"], "slots": [{"name": "n", "semantic_type": "s", "required": True}]},
    "phrase": MATERIAL | {"phrase_id": "phrase:1", "asset_type": "phrase", "text": "t", "function": "f", "position": "p", "register": "r", "claim_strength": "moderate", "constraints": []},
}
#: (kind, path, value, faults); a value of ... deletes the field.
CASES = [
    ("evidence", ["language"], "fr", ["language"]),
    ("evidence", ["confidence"], True, ["confidence"]),
    ("evidence", ["confidence"], "0.5", ["confidence"]),
    ("evidence", ["confidence"], 1.01, ["confidence"]),
    ("evidence", ["page_start"], 2.0, ["page_start"]),
    ("evidence", ["document_id"], "doc", ["document_id"]),
    ("evidence", ["section_path"], [], ["section_path"]),
    ("evidence", ["section_path"], ["a", 1], ["section_path"]),
    ("evidence", ["section_title"], " \t ", ["section_title"]),
    ("evidence", ["section_title"], "x" * 513, ["section_title"]),
    ("evidence", ["extra"], 1, ["unknown extra"]),
    ("evidence", ["confidence"], ..., ["missing confidence"]),
    ("evidence", ["cluster_id"], "group:1", ["cluster_id"]),
    ("evidence", ["cluster_id"], "cluster:1", []),
    ("evidence", ["risk_flag_sources"], {}, ["risk_flag_sources of risk_flags"]),
    ("evidence", ["risk_flag_sources"], {"vague_claim": "guess"}, ["risk_flag_sources of risk_flags"]),
    ("evidence", ["char_end"], 20, ["character range", "contiguous spans"]),
    ("evidence", ["page_end"], 1, ["page range", "pages of spans"]),
    ("evidence", ["page_end"], 4, ["pages of spans"]),
    ("evidence", ["source_spans", 0, "bbox"], {}, ["source_spans"]),
    ("evidence", ["source_spans", 0, "more"], 1, ["source_spans"]),
    ("evidence", ["source_spans", 1, "source_end"], 5, ["contiguous spans"]),
    ("evidence", ["source_spans", 1, "paragraph_start"], 16, ["contiguous spans"]),
    ("evidence", ["schema_version"], "evidence-v2", ["schema_version"]),
    ("strategy", ["evidence_ids"], ["evidence:1", "evidence:1"], ["evidence_ids"]),
    ("strategy", ["evidence_ids"], ["evidence:1", None], ["evidence_ids"]),
    ("strategy", ["risk_flags"], ["other"], ["risk_flags"]),
    ("strategy", ["asset_type"], "phrase", ["asset_type"]),
    ("strategy", ["steps"], ["s"] * 13, ["steps"]),
    ("template", ["slots", 0, "required"], 1, ["slots"]),
    ("template", ["slots", 0, "name"], ..., ["slots"]),
    ("template", ["slots"], [], []),
    ("phrase", ["response_schema_version"], "abstraction-v8", ["response_schema_version"]),
    ("phrase", ["category"], None, ["category"]),
]


def test_stored_records(spark):
    rows, want = [(k, k, json.dumps(v)) for k, v in GOOD.items()], {k: [] for k in GOOD}
    for n, (kind, path, value, faults) in enumerate(CASES):
        record = copy.deepcopy(GOOD[kind])
        inner = record
        for step in path[:-1]:
            inner = inner[step]
        if value is ...:
            del inner[path[-1]]
        else:
            inner[path[-1]] = value
        rows.append((str(n), kind, json.dumps(record, ensure_ascii=bool(n % 2))))
        want[str(n)] = faults
    for name, kind, text, faults in [("list", "phrase", "[1]", ["record"]), ("bad", "phrase", "{", ["record"]), ("null", "phrase", None, ["record"]), ("kind", "poem", "{}", ["kind"]), ("none", None, "{}", ["kind"])]:
        rows.append((name, kind, text))
        want[name] = faults
    rows.append(("two", "phrase", json.dumps(GOOD["phrase"] | {"a": 1, "text": ""})))
    rows[-1] = ("two", "phrase", rows[-1][2])
    want["two"] = ["unknown a", "text"]
    got = {r.key: r.faults for r in stored.checked(spark.createDataFrame(rows, "key string, kind string, record string"), "key", "kind", "record").collect()}
    assert {k: v for k, v in got.items() if v != want[k]} == {} and len(got) == len(want)
