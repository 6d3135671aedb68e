"""Paragraphs of parsed documents with the places they come from, rebuilt from nested structures, and how much of each section family
is covered by places. Documents that don't meet the contract fail closed: they give an error and no paragraph.

The structure of a document is one JSON text, read once with a fixed schema. Its items hang below the body and below groups, which may refer to
each other; the walk visits each group once. Headings of the items are aligned with those of the Markdown text by a cursor that only moves forward.
Both folds are small generators over one document's references or headings; texts, places, sections and counts are Spark expressions, windows and
groups.
"""

from __future__ import annotations

import html
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import hashing, text
from lodestone.functions.rows import rowwise
from lodestone.operators.records import release_key
from lodestone.plans.markdown import HEADING, REFERENCES

# The parser's contract, and what identities are made of.
PARSER, SCHEMA_NAME, SCHEMA_VERSIONS = "docling", "DoclingDocument", ["1.10.0"]
LEAST_VERSION, BELOW_VERSION = [2, 112], [2, 113]
RECONSTRUCTION = "docling-provenance-v3"
LINK = r"\[([^\]]+)\]\((?:[^()]|\([^()]*\))*\)"
AHEAD = 8

_CHILDREN = "array<struct<cref: string>>"
_PROV = "array<struct<page_no: bigint, bbox: struct<l: double, t: double, r: double, b: double>, charspan: array<bigint>>>"
PAYLOAD = (
    "document_id string, parser_name string, parser_version string, parse_fingerprint string, structured struct<schema_name: string, version: string, "
    f"body: struct<children: {_CHILDREN}>, groups: array<struct<children: {_CHILDREN}>>, "
    f"texts: array<struct<label: string, orig: string, text: string, self_ref: string, prov: {_PROV}>>>"
)
_EDGES = r"(?U)^\s+|\s+$"


def walk(body: list[str | None], groups: list[list[str | None] | None], n: int) -> Iterator[int]:
    """The numbers of the texts below body, in order. A group is visited where it is first met; unknown references are passed over."""
    seen: set[int] = set()
    open_lists = [iter(body)]
    while open_lists:
        for ref in open_lists[-1]:
            kind, _, number = (ref or "").rpartition("/")
            i = int(number) if number.isascii() and number.isdigit() else -1
            if kind.startswith("#/texts") and 0 <= i < n:
                yield i
            elif kind.startswith("#/groups") and 0 <= i < len(groups) and i not in seen and groups[i] is not None:
                seen.add(i)
                open_lists.append(iter(groups[i]))
                break
        else:
            open_lists.pop()


def aligned(keys: Iterable[str], headings: list[str], ahead: int = AHEAD) -> Iterator[int | None]:
    """For each key the first equal heading among the next ``ahead`` behind the last one found, null if there is none."""
    cursor = 0
    for key in keys:
        found = next((i for i in range(cursor, min(len(headings), cursor + ahead)) if headings[i] == key), None)
        cursor = cursor if found is None else found + 1
        yield found


def reading_order(body: Column, groups: Column, n: Column) -> Column:
    """``walk`` of reference lists."""
    return rowwise(lambda b, g, k: list(walk(b or [], g or [], k or 0)), "array<int>")(body, groups, n)


def alignment(keys: Column, headings: Column, ahead: int = AHEAD) -> Column:
    """``aligned`` of lists of keys."""
    return rowwise(lambda k, h: list(aligned(k or [], h or [], ahead)), "array<int>")(keys, headings)


def heading_keys(values: Column) -> Column:
    """What headings are compared by: entities resolved, links as their texts, then normal headings."""
    plain = rowwise(lambda v: [html.unescape(x or "") for x in v or []], "array<string>")(values)
    return F.transform(plain, lambda x: text.section_heading(F.regexp_replace(x, LINK, "$1")))


def supported(version: Column) -> Column:
    """Whether a parser version lies in the verified range; early releases come before their release."""
    pattern = r"(?i)^\s*v?(?:0+!)?(\d+(?:\.\d+)*)([-_.]?(?:a|b|c|rc|alpha|beta|pre|preview)[-_.]?\d*)?(-\d+|[-_.]?(?:post|rev|r)[-_.]?\d*)?([-_.]?dev[-_.]?\d*)?(?:\+[a-z0-9]+(?:[-_.][a-z0-9]+)*)?\s*$"
    part = lambda i: F.regexp_extract(version, pattern, i)
    key, early = release_key(F.coalesce(F.nullif(part(1), F.lit("")), F.lit("0"))), (part(2) != "") | ((part(4) != "") & (part(3) == ""))
    least, below = (F.array(*(F.lit(x).cast("bigint") for x in v)) for v in (LEAST_VERSION, BELOW_VERSION))
    inside = ((key > least) | ((key == least) & ~early)) & ((key < below) | ((key == below) & early))
    return F.coalesce(version.rlike(pattern) & inside, F.lit(False))


def places(item: Column, said: Column) -> Column:
    """An item's places in order: none if one is invalid or two overlap."""
    span = lambda p, i: F.get(p["charspan"], F.lit(i))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    def valid(p: Column) -> Column:
        box = p["bbox"]
        ok = (p["page_no"] > 0) & finite(box["l"]) & finite(box["t"]) & finite(box["r"]) & finite(box["b"])
        ok &= (F.size(p["charspan"]) == 2) & (span(p, 0) >= 0) & (span(p, 1) > span(p, 0)) & (span(p, 1) <= F.length(said))
        return F.coalesce(ok, F.lit(False))

    made = F.array_sort(F.transform(item["prov"], lambda p: F.struct(span(p, 0).alias("begin"), span(p, 1).alias("end"), item["self_ref"].alias("self_ref"), p["page_no"].alias("page_no"), p["bbox"].alias("bbox"))))
    apart = F.forall(F.sequence(F.lit(1), F.greatest(F.size(made) - 1, F.lit(1))), lambda i: F.coalesce(F.get(made, i)["begin"] >= F.get(made, i - 1)["end"], F.lit(True)))
    good = (F.size(item["prov"]) > 0) & (F.coalesce(item["self_ref"], F.lit("")) != "") & F.forall(item["prov"], valid) & apart
    return F.when(F.coalesce(good, F.lit(False)), made).otherwise(F.slice(made, 1, 0))


def documents(wanted: DataFrame, state: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(document_id, error, parse_fingerprint, structured, markdown, ...) of the wanted documents; error: the first gate that doesn't hold.
    state: (document_id, source_status, parse_status, parser_name, parser_version, parse_fingerprint, item_key, attachment_key); artifacts: (document_id,
    payload JSON, markdown). Ids are unique in both."""
    ready = state.where("source_status = 'ready'").withColumn("known", F.lit(True))
    parsed = artifacts.select("document_id", F.from_json("payload", PAYLOAD).alias("p"), "markdown", F.lit(True).alias("stored"))
    rows = wanted.select("document_id").distinct().join(ready, "document_id", "left").join(parsed, "document_id", "left")
    p, s, same = F.col("p"), F.col("p.structured"), lambda c: F.col("p." + c).eqNullSafe(F.col(c))
    error = (
        F.when(F.col("known").isNull(), "unknown_document")
        .when(~F.col("parse_status").eqNullSafe(F.lit("ready")), "parse_not_ready")
        .when(~F.col("parser_name").eqNullSafe(F.lit(PARSER)), "unsupported_provenance")
        .when(F.col("stored").isNull() | F.col("markdown").isNull(), "missing_parsed_artifact")
        .when(~p["document_id"].eqNullSafe(F.col("document_id")), "parsed_identity_mismatch")
        .when(s.isNull(), "invalid_parsed_structure")
        .when(~(same("parser_name") & same("parser_version") & same("parse_fingerprint")), "parsed_contract_mismatch")
        .when(~supported(F.coalesce("parser_version", F.lit(""))), "unsupported_parser_version")
        .when(~s["schema_name"].eqNullSafe(F.lit(SCHEMA_NAME)) | ~F.coalesce(s["version"].isin(SCHEMA_VERSIONS), F.lit(False)), "unsupported_docling_schema")
        .when(s["texts"].isNull() | s["groups"].isNull() | s["body"].isNull(), "invalid_docling_structure")
    )
    return rows.select("document_id", error.alias("error"), "parse_fingerprint", "item_key", "attachment_key", "markdown", s.alias("structured"))


def items(docs: DataFrame) -> DataFrame:
    """(document_id, parse_fingerprint, place, label, said, exact, segments, nth): the items that hold text, in reading order; nth counts the headings so far.
    With each heading: (level, matched, title)."""
    refs = lambda c: F.transform(c, lambda x: x["cref"])
    s = F.col("structured")
    order = reading_order(refs(s["body"]["children"]), F.transform(s["groups"], lambda g: refs(g["children"])), F.size(s["texts"]))
    listed = docs.where("error IS NULL").select("document_id", "parse_fingerprint", "markdown", s["texts"].alias("texts"), order.alias("order"))
    item = F.transform("order", lambda i: F.get(F.col("texts"), i))
    kept = F.filter(item, lambda t: F.coalesce(F.regexp_replace(F.coalesce(t["orig"], t["text"]), _EDGES, "") != "", F.lit(False)))
    return listed.select("document_id", "parse_fingerprint", "markdown", kept.alias("items"))


def outline(listed: DataFrame) -> DataFrame:
    """(document_id, nth, title, level, matched, path): the headings of ``items``' rows, with their sections' paths."""
    titles = F.transform(F.filter("items", lambda t: t["label"] == "section_header"), lambda t: F.regexp_replace(F.coalesce(t["orig"], t["text"]), _EDGES, ""))
    lines = F.filter(F.split("markdown", r"\r\n|[\r\n\x0b\f\x1c-\x1e\x85  ]"), lambda x: x.rlike(HEADING))
    rows = listed.select("document_id", titles.alias("titles"), F.transform(lines, lambda x: F.regexp_extract(x, HEADING, 2)).alias("headings"), F.transform(lines, lambda x: F.length(F.regexp_extract(x, HEADING, 1))).alias("levels"))
    rows = rows.select("document_id", "titles", "levels", alignment(heading_keys(F.col("titles")), heading_keys(F.col("headings"))).alias("matched"))
    rows = rows.select("document_id", "levels", F.posexplode_outer(F.arrays_zip("titles", "matched")).alias("nth", "h")).where("nth IS NOT NULL")
    level = F.coalesce(F.get("levels", F.col("h.matched")), F.lit(1))
    rows = rows.select("document_id", (F.col("nth") + 1).alias("nth"), F.col("h.titles").alias("title"), F.col("h.matched").alias("matched"), level.cast("int").alias("level"))
    # a path holds, for each depth, the last heading so shallow with none shallower behind it
    by = Window.partitionBy("document_id").orderBy("nth")
    step = lambda path, x: F.concat(F.slice(path, F.lit(1), F.least(F.size(path), x["level"] - 1)), F.array(x["title"]))
    # headings of level 1 begin anew, so a path is folded from the last of them on
    rows = rows.withColumn("top", F.count_if(F.col("level") == 1).over(by))
    own = Window.partitionBy("document_id", "top").orderBy("nth")
    path = F.aggregate(F.collect_list(F.struct("level", "title")).over(own), F.array().cast("array<string>"), step)
    return rows.withColumn("path", path).drop("top")


def texts(docs: DataFrame) -> DataFrame:
    """(document_id, parse_fingerprint, place, nth, section_title, family, paragraph_no, text, segments, exact) of the texts below the nth heading, unless that is one of
    references; paragraph_no is null where there is no place. docs: ``documents``. A text's heading is the last one before it, so each document is read once."""
    # outer explodes, since a filter inferred from inner ones would repeat the walk
    rows = items(docs).select("document_id", "parse_fingerprint", F.posexplode_outer("items").alias("place", "item")).where("place IS NOT NULL")
    by = Window.partitionBy("document_id").orderBy("place")
    said, heading = F.coalesce("item.orig", "item.text"), F.col("item.label") == "section_header"
    rows = rows.withColumns({"nth": F.count_if(heading).over(by), "title": F.last(F.when(heading, F.regexp_replace(said, _EDGES, "")), ignorenulls=True).over(by)})
    rows = rows.where(F.col("item.label").isin("text", "list_item")).where(~text.section_heading(F.col("title")).rlike(REFERENCES)).select("document_id", "parse_fingerprint", "place", "nth", "title", said.alias("text"), F.col("item.orig").isNotNull().alias("exact"), "item")
    rows = rows.withColumn("segments", places(F.col("item"), F.col("text"))).drop("item")
    placed = F.size("segments") > 0
    number = F.when(placed, F.count_if(placed).over(Window.partitionBy("document_id", "nth").orderBy("place")))
    return rows.select("document_id", "parse_fingerprint", "place", "nth", F.col("title").alias("section_title"), text.section_family(F.col("title")).alias("family"), number.alias("paragraph_no"), "text", "segments", "exact")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(document_id, section_id, section_title, section_path, family, paragraph_no, paragraph_id, text, text_hash, segments, exact): ``texts`` with the ids and paths
    of their sections, and their own; ids are null where there is no place. docs: ``documents``."""
    paths = outline(items(docs)).select("document_id", "nth", "path")
    placed = F.size("segments") > 0
    rows = texts(docs).join(paths, ["document_id", "nth"]).withColumn("text_hash", hashing.sha256(F.col("text")))
    parse = F.coalesce("parse_fingerprint", F.lit(""))
    section = F.concat(F.lit("section:"), hashing.sha256(hashing.canonical_json(document=F.col("document_id"), path=F.col("path"), parse=parse)))
    rows = rows.withColumn("section_id", section).withColumn("parse", parse)
    identity = hashing.canonical_json(document=F.col("document_id"), parse=F.col("parse"), section=F.col("section_id"), index=F.col("paragraph_no"), text=F.col("text_hash"), reconstruction=F.lit(RECONSTRUCTION))
    ident = F.when(placed, F.concat(F.lit("paragraph:"), hashing.sha256(identity)))
    return rows.select("document_id", "place", "section_id", "section_title", F.col("path").alias("section_path"), "family", "paragraph_no", ident.alias("paragraph_id"), "text", "text_hash", "segments", "exact")


def coverage(found: DataFrame) -> DataFrame:
    """(document_id, family, eligible, covered): characters of ``texts``, and those with a place."""
    own = F.aggregate("segments", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["begin"])
    return found.groupBy("document_id", "family").agg(F.sum(F.length("text")).cast("bigint").alias("eligible"), F.sum(own).alias("covered"))


def loaded(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(document_id, error, paragraphs, eligible, covered, coverage) of every wanted document, by the gates that need the whole document too.
    docs: ``documents``; found: its ``texts`` or ``paragraphs``."""
    own = F.aggregate("segments", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["begin"])
    facts = found.groupBy("document_id").agg(F.count("paragraph_no").alias("n"), F.every("exact").alias("exact"), F.sum(F.length("text")).cast("bigint").alias("eligible"), F.sum(own).alias("covered"))
    straight = outline(items(docs)).groupBy("document_id").agg(F.every(F.col("matched").isNotNull()).alias("aligned"))
    rows = docs.select("document_id", "error", "item_key", "attachment_key").join(facts, "document_id", "left").join(straight, "document_id", "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(~F.coalesce("exact", F.lit(True)), "unsupported_charspan_contract")
        .when(F.coalesce("n", F.lit(0)) == 0, "no_provenance_paragraphs")
        .when(~F.coalesce("aligned", F.lit(True)), "section_alignment_failed")
        .when(blank("item_key") | blank("attachment_key"), "missing_zotero_identity")
    )
    good = lambda c: F.when(error.isNull(), c)
    return rows.select("document_id", error.alias("error"), good(F.col("n")).alias("paragraphs"), good(F.col("eligible")).alias("eligible"), good(F.col("covered")).alias("covered"), good(F.col("covered") / F.col("eligible")).alias("coverage"))
