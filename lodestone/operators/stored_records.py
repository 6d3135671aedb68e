"""Closed-schema checks of stored records: a table of rules for each kind, compiled to one Column that lists all faults of a record.

Records are JSON texts, read once as variants, so that types are seen as they are written: 1 is no text, true is no number, "1" no integer. A fault is
"missing f", "unknown f", or the name of the field or of the rule over several fields that doesn't hold, in the rules' order. Null and unreadable
records, and those that are no objects, have the one fault "record".
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.features import TAXONOMY
from lodestone.functions.text import RISK

Rule = Callable[[Column], Column]

# What fields of records may hold.
STRENGTHS = ("cautious", "moderate", "strong")
LANGUAGES = ("en", "zh", "und")
FLAGS = ("unsupported_superlative", "exaggerated_novelty", "vague_claim", "missing_comparison", "causal_overclaim")
CLASSIFICATIONS = tuple(f"classification-v{i}" for i in range(1, 10))
ABSTRACTIONS = tuple(f"abstraction-v{i}" for i in range(1, 8))
assert set(FLAGS) == {*RISK, "missing_comparison"}


def _kind(x: Column) -> Column:
    return F.coalesce(F.schema_of_variant(x), F.lit(""))


def _as(x: Column, kind: str) -> Column:
    return F.try_variant_get(x, "$", kind)


def _list(x: Column) -> Column:
    """The elements of a list, none of anything else."""
    return F.coalesce(F.when(_kind(x).startswith("ARRAY<"), _as(x, "array<variant>")), F.array().cast("array<variant>"))


def _at(x: Column, field: str) -> Column:
    return F.try_variant_get(x, f"$.{field}", "variant")


def text(most: int) -> Rule:
    return lambda x: (_kind(x) == "STRING") & _as(x, "string").rlike(r"(?U)\S") & (F.length(_as(x, "string")) <= most)


def prefixed(prefix: str) -> Rule:
    return lambda x: text(512)(x) & _as(x, "string").startswith(prefix)


def one_of(*values: str) -> Rule:
    return lambda x: (_kind(x) == "STRING") & _as(x, "string").isin(*values)


def score(x: Column) -> Column:
    return (_kind(x).isin("BIGINT", "DOUBLE", "FLOAT") | _kind(x).startswith("DECIMAL")) & _as(x, "double").between(0, 1)


def integer(least: int) -> Rule:
    return lambda x: (_kind(x) == "BIGINT") & (_as(x, "bigint") >= least)


def flag(x: Column) -> Column:
    return _kind(x) == "BOOLEAN"


def each(rule: Rule, least: int, most: int, distinct: bool = False) -> Rule:  # noqa: FBT001, FBT002
    """A list of ``least`` to ``most`` elements that all meet a rule."""

    def met(x: Column) -> Column:
        ok = _kind(x).startswith("ARRAY<") & F.size(_list(x)).between(least, most) & F.forall(_list(x), lambda e: F.coalesce(rule(e), F.lit(False)))
        return ok & (F.size(F.array_distinct(F.transform(_list(x), lambda e: _as(e, "string")))) == F.size(_list(x))) if distinct else ok

    return met


def maybe(rule: Rule) -> Rule:
    """Null, or what meets the rule."""
    return lambda x: (_kind(x) == "VOID") | rule(x)


def closed(fields: dict[str, Rule]) -> Rule:
    """An object with just these fields, all of which meet their rules."""

    def met(x: Column) -> Column:
        keys = F.coalesce(F.json_object_keys(F.to_json(x)), F.array().cast("array<string>"))
        same = (F.size(F.array_except(keys, F.array(*map(F.lit, fields)))) == 0) & (F.size(F.array_intersect(keys, F.array(*map(F.lit, fields)))) == len(fields))
        return reduce(lambda a, b: a & b, (F.coalesce(rule(_at(x, f)), F.lit(False)) for f, rule in fields.items()), _kind(x).startswith("OBJECT<") & same)

    return met


_TRACE: dict[str, Rule] = {f: text(256) for f in ("analyzer_provider", "analyzer_model", "prompt_version", "prompt_hash", "analyzer_request_hash", "analyzer_response_hash")}
_NUMBER: Rule = integer(-(2**63))
_SPAN: dict[str, Rule] = {"self_ref": text(512), "source_start": integer(0), "source_end": integer(1), "paragraph_start": integer(0), "paragraph_end": integer(1), "page_no": integer(1), "bbox": lambda x: _kind(x).startswith("OBJECT<") & (_kind(x) != "OBJECT<>")}


def _trace(responses: tuple[str, ...], version: str) -> dict[str, Rule]:
    return _TRACE | {"response_schema_version": one_of(*responses), "taxonomy_version": one_of("writing-taxonomy-v1"), "schema_version": one_of(version), "cluster_id": maybe(prefixed("cluster:"))}


EVIDENCE: dict[str, Rule] = (
    {"evidence_id": prefixed("evidence:"), "document_id": prefixed("zotero:")}
    | {f: text(5000 if f == "original_text" else 512) for f in ("zotero_item_key", "attachment_key", "source_content_fingerprint", "parse_fingerprint", "parser_name", "parser_version", "section_id", "section_title", "section_family", "paragraph_id", "original_text", "source_paragraph_hash")}
    | {"language": one_of(*LANGUAGES), "category": one_of(*TAXONOMY), "claim_strength": one_of(*STRENGTHS), "validation_status": one_of("validated", "rejected_candidate")}
    | {f: score for f in ("provenance_coverage", "confidence", "quality_score")}
    | {"section_path": each(text(500), 1, 32), "sentence_ids": each(text(256), 1, 100), "risk_flags": each(one_of(*FLAGS), 0, 5)}
    | {"risk_flag_sources": lambda x: _kind(x).startswith("OBJECT<"), "page_start": integer(1), "page_end": integer(1), "char_start": integer(0), "char_end": integer(1), "source_spans": each(closed(_SPAN), 1, 64)}
    | _trace(CLASSIFICATIONS, "evidence-v1")
)


def _material(kind: str) -> dict[str, Rule]:
    own = {f"{kind}_id": prefixed(f"{kind}:"), "asset_type": one_of(kind), "evidence_ids": each(prefixed("evidence:"), 1, 20, distinct=True), "category": one_of(*TAXONOMY), "language": one_of(*LANGUAGES), "quality_score": score}
    return own | _trace(ABSTRACTIONS, "writing-material-v1")


STRATEGY = _material("strategy") | {"label": text(160), "description": text(2000), "applicability": text(1000), "claim_strength_guidance": text(1000), "explanation_zh": text(2000), "explanation_en": text(2000), "steps": each(text(300), 0, 12), "risk_flags": each(one_of(*FLAGS), 0, 5)}
TEMPLATE = _material("template") | {"template_text": text(2000), "claim_strength_guidance": text(1000), "constraints": each(text(500), 0, 20), "slots": each(closed({"name": text(80), "semantic_type": text(120), "required": flag}), 0, 20)}
PHRASE = _material("phrase") | {"text": text(500), "function": text(300), "position": text(120), "register": text(120), "claim_strength": one_of(*STRENGTHS), "constraints": each(text(500), 0, 20)}
RULES = {"evidence": EVIDENCE, "strategy": STRATEGY, "template": TEMPLATE, "phrase": PHRASE}


def _evidence_whole(v: Column) -> dict[str, Column]:
    """Rules over several fields of evidence, for values of the right types."""
    n, t = (lambda f: _as(_at(v, f), "bigint")), (lambda f: _as(_at(v, f), "string"))
    spans = F.transform(_list(_at(v, "source_spans")), lambda s: F.struct(*(_as(_at(s, f), "bigint").alias(f) for f in ("source_start", "source_end", "paragraph_start", "paragraph_end", "page_no"))))
    # each span begins where the one before ends
    begins = lambda i: F.when(i == 0, n("char_start")).otherwise(F.get(spans, i - 1)["paragraph_end"])
    joined = F.forall(F.transform(spans, lambda s, i: (s["paragraph_start"] == begins(i)) & (s["paragraph_end"] > s["paragraph_start"]) & (s["source_end"] - s["source_start"] == s["paragraph_end"] - s["paragraph_start"])), lambda ok: F.coalesce(ok, F.lit(False)))
    pages = F.transform(spans, lambda s: s["page_no"])
    sources = F.coalesce(F.try_variant_get(_at(v, "risk_flag_sources"), "$", "map<string,string>"), F.create_map().cast("map<string,string>"))
    flags = F.transform(_list(_at(v, "risk_flags")), lambda x: _as(x, "string"))
    known = F.forall(F.map_values(sources), lambda s: F.coalesce(s.isin("model_assessment", "deterministic_heuristic"), F.lit(False)))
    return {
        "risk_flag_sources of risk_flags": (F.size(F.array_except(F.map_keys(sources), flags)) == 0) & (F.size(F.array_except(flags, F.map_keys(sources))) == 0) & known,
        "page range": n("page_end") >= n("page_start"),
        "character range": (n("char_end") > n("char_start")) & (n("char_end") - n("char_start") == F.length(t("original_text"))),
        "contiguous spans": joined & (F.element_at(spans, -1)["paragraph_end"] == n("char_end")),
        "pages of spans": (F.array_min(pages) == n("page_start")) & (F.array_max(pages) == n("page_end")),
    }


def faults(record: Column, kind: str) -> Column:
    """The faults of a record (JSON text) of a kind; an empty list if it is valid."""
    return _faults(F.try_parse_json(record), F.json_object_keys(record), kind)


def _faults(v: Column, keys: Column, kind: str) -> Column:
    """``faults`` of a record that is read already, and its keys."""
    rules = RULES[kind]
    names = F.array(*map(F.lit, rules))
    missing = F.transform(F.array_sort(F.array_except(names, keys)), lambda f: F.concat(F.lit("missing "), f))
    unknown = F.transform(F.array_sort(F.array_except(keys, names)), lambda f: F.concat(F.lit("unknown "), f))
    held = lambda f: F.array_contains(keys, f)
    fields = F.array_compact(F.array(*(F.when(held(f) & ~F.coalesce(rule(_at(v, f)), F.lit(False)), F.lit(f)) for f, rule in rules.items())))
    own = F.concat(missing, unknown, fields)
    if kind == "evidence":
        whole = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in _evidence_whole(v).items())))
        own = F.when(F.size(own) > 0, own).otherwise(whole)
    return F.when(keys.isNull(), F.array(F.lit("record"))).otherwise(own)


def checked(records: DataFrame, key: str, kind: str, record: str) -> DataFrame:
    """(key, kind, faults) of records of known kinds; an unknown kind is a fault itself."""
    # an explode of one element, so that the rules don't read the record anew
    read = F.explode_outer(F.array(F.struct(F.try_parse_json(record).alias("v"), F.json_object_keys(record).alias("keys"))))
    rows = records.select(key, kind, read.alias("_r"))
    found = F.coalesce(*(F.when(F.col(kind) == k, _faults(F.col("_r.v"), F.col("_r.keys"), k)) for k in RULES), F.array(F.lit("kind")))
    return rows.select(key, kind, found.alias("faults"))
