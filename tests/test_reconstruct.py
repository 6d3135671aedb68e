"""Reconstruction of paragraphs against a recursive brute force on random structures, and the gates one by one."""

import hashlib
import html
import json
import random
import re

import pytest

from lodestone.operators import reconstruct

TITLES = ["1 Introduction", "Introduction", "2. Methods &amp; Data", "[Results](http://x.org/a(b))", "References", "III. Related Work", "Analysis", "结论", "Odd Heading"]


def normal(title):
    title = re.sub(r"\[([^\]]+)\]\((?:[^()]|\([^()]*\))*\)", r"\1", html.unescape(title)).strip().lower()
    title = re.sub(r"^\s*(?:(?:section|chapter|appendix)\s+)?(?:[a-z]\.\d+(?:\.\d+)*|\d+(?:\.\d+)*|[ivxlcdm]+)(?:\s*[.):-]\s*|\s+)", "", title)
    return re.sub(r"[^a-z0-9㐀-䶿一-鿿]+", " ", title).strip()


def visit(children, doc, seen):
    for child in children:
        kind, n = child["cref"].rsplit("/", 1)
        if kind == "#/texts" and int(n) < len(doc["texts"]):
            yield doc["texts"][int(n)]
        elif kind == "#/groups" and int(n) < len(doc["groups"]) and int(n) not in seen:
            seen.add(int(n))
            yield from visit(doc["groups"][int(n)]["children"], doc, seen)


def spans(item, said):
    out = []
    for p in item.get("prov") or []:
        begin, end = p["charspan"]
        if not (p["page_no"] > 0 and 0 <= begin < end <= len(said) and item["self_ref"] and all(v is not None for v in p["bbox"].values())):
            return []
        out.append((begin, end))
    out.sort()
    return [] if any(b[0] < a[1] for a, b in zip(out, out[1:], strict=False)) else out


def digest(value):
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def brute(ident, parse, doc, markdown):
    """(aligned, [(title, path, number, text, spans)])"""
    heads = [(len(m[1]), normal(m[2])) for line in markdown.splitlines() if (m := re.match(r"^(#{1,6})\s+(.+?)\s*$", line))]
    cursor, path, title, number, straight, out, section = 0, [], None, 0, True, [], None
    for item in visit(doc["body"]["children"], doc, set()):
        said = item["orig"] if item.get("orig") is not None else item.get("text") or ""
        if not said.strip():
            continue
        if item["label"] == "section_header":
            hit = next((i for i in range(cursor, min(len(heads), cursor + 8)) if heads[i][1] == normal(said)), None)
            straight &= hit is not None
            level, cursor = (1, cursor) if hit is None else (heads[hit][0], hit + 1)
            title, path, number = said.strip(), [*path[: level - 1], said.strip()], 0
            section = "section:" + digest({"document": ident, "path": path, "parse": parse})
        elif item["label"] in ("text", "list_item") and title and not re.match("^(references|bibliography|acknowledge?ments?)$", normal(title)):
            found = spans(item, said)
            number += bool(found)
            sha = hashlib.sha256(said.encode()).hexdigest()
            name = "paragraph:" + digest({"document": ident, "parse": parse, "section": section, "index": number, "text": sha, "reconstruction": "docling-provenance-v3"}) if found else None
            out.append((title, tuple(path), number if found else None, said, tuple(found), section, name))
    return straight, out


def structure(rng):
    texts, lines = [], []
    for i in range(rng.randrange(40)):
        said = rng.choice(["", " \n", "Short.", "One sentence. And é another!", "x" * rng.randrange(1, 60), "a\0b 中文"])
        item = {"label": rng.choice(["text", "text", "list_item", "caption", "section_header"]), "orig": said, "text": "t", "self_ref": f"#/texts/{i}" if rng.random() < 0.95 else ""}
        if item["label"] == "section_header":
            item["orig"] = rng.choice(TITLES)
            level = rng.randrange(1, 4)
            lines += ["#" * level + " " + html.unescape(item["orig"]), "prose"]
            if rng.random() < 0.2:
                lines += ["## Between"] * rng.randrange(1, 9)
            if rng.random() < 0.05:
                lines = lines[:-2]
        n, cut = len(said), rng.randrange(0, len(said) + 1)
        item["prov"] = [{"page_no": rng.choice([1, 2, 3, 3, 3, 0]) if rng.random() < 0.1 else 1, "bbox": {"l": 0, "t": 1.5, "r": 2, "b": None if rng.random() < 0.03 else 3}, "charspan": list(c)} for c in rng.choice([[(0, n)], [(cut, n), (0, cut)], [(0, cut)], [], [(0, n), (0, 1)]])]
        texts.append(item)
    refs = [{"cref": f"#/texts/{i}"} for i in range(len(texts))]
    groups = []
    while refs and rng.random() < 0.8:  # parts move into groups, which also name each other
        at = rng.randrange(len(refs))
        size = rng.randrange(1, 6)
        part = refs[at : at + size]
        refs[at : at + size] = [{"cref": f"#/groups/{len(groups)}"}]
        groups.append({"children": [*part, *({"cref": f"#/groups/{rng.randrange(len(groups) + 2)}"} for _ in range(rng.randrange(3)))]})
    return {"schema_name": "DoclingDocument", "version": "1.10.0", "texts": texts, "groups": groups, "body": {"children": [*refs, {"cref": "#/tables/1"}, {"cref": "#/texts/999"}]}}, "\n".join(lines)


def frames(spark, made, **changes):
    state, artifacts = [], []
    for ident, (doc, markdown) in made.items():
        row = {"source_status": "ready", "parse_status": "ready", "parser_name": "docling", "parser_version": "2.112.3", "parse_fingerprint": "fp", "item_key": "K", "attachment_key": "A"}
        payload = {"document_id": ident, "parser_name": "docling", "parser_version": "2.112.3", "parse_fingerprint": "fp", "structured": doc}
        row |= changes.get("row", {})
        payload |= changes.get("payload", {})
        state.append((ident, *row.values()))
        artifacts.append((ident, json.dumps(payload), markdown))
    kind = "document_id string, source_status string, parse_status string, parser_name string, parser_version string, parse_fingerprint string, item_key string, attachment_key string"
    wanted = spark.createDataFrame([(i,) for i in made], "document_id string")
    return wanted, spark.createDataFrame(state, kind), spark.createDataFrame(artifacts, "document_id string, payload string, markdown string")


def test_paragraphs_equal_a_recursive_walk(spark):
    rng = random.Random(3)
    made = {f"zotero:{i}": structure(rng) for i in range(60)}
    docs = reconstruct.documents(*frames(spark, made))
    found = reconstruct.paragraphs(docs).cache()
    got = {}
    for r in found.orderBy("document_id", "place").collect():
        got.setdefault(r.document_id, []).append((r.section_title, tuple(r.section_path), r.paragraph_no, r.text, tuple((s.begin, s.end) for s in r.segments), r.section_id, r.paragraph_id))
    want = {i: brute(i, "fp", *d) for i, d in made.items()}
    assert got == {i: rows for i, (_, rows) in want.items() if rows}
    totals = {}
    for r in reconstruct.coverage(found).collect():
        e, c = totals.get(r.document_id, (0, 0))
        totals[r.document_id] = e + r.eligible, c + r.covered
    errors = set()
    for r in reconstruct.loaded(docs, found).collect():
        straight, rows = want[r.document_id]
        wrong = "no_provenance_paragraphs" if not any(x[4] for x in rows) else None if straight else "section_alignment_failed"
        errors.add(wrong)
        assert r.error == wrong
        chars = sum(len(x[3]) for x in rows), sum(e - b for x in rows for b, e in x[4])
        assert totals.get(r.document_id, (0, 0)) == chars
        assert (r.eligible, r.covered) == ((None, None) if wrong else chars)
    assert len(errors) == 3


GOOD = {"schema_name": "DoclingDocument", "version": "1.10.0", "groups": [], "body": {"children": [{"cref": "#/texts/0"}, {"cref": "#/texts/1"}]}, "texts": [{"label": "section_header", "orig": "Methods"}, {"label": "text", "orig": "Some text.", "self_ref": "#/texts/1", "prov": [{"page_no": 1, "bbox": {"l": 0, "t": 0, "r": 1, "b": 1}, "charspan": [0, 10]}]}]}


@pytest.mark.parametrize(
    ("changes", "error"),
    [
        ({}, None),
        ({"row": {"source_status": "gone"}}, "unknown_document"),
        ({"row": {"parse_status": "failed"}}, "parse_not_ready"),
        ({"row": {"parser_name": "other"}}, "unsupported_provenance"),
        ({"payload": {"document_id": "zotero:2"}}, "parsed_identity_mismatch"),
        ({"payload": {"structured": [1]}}, "invalid_parsed_structure"),
        ({"payload": {"parse_fingerprint": "x"}}, "parsed_contract_mismatch"),
        ({"row": {"parser_version": "2.111"}, "payload": {"parser_version": "2.111"}}, "unsupported_parser_version"),
        ({"payload": {"structured": GOOD | {"version": "1.9.0"}}}, "unsupported_docling_schema"),
        ({"payload": {"structured": GOOD | {"texts": None}}}, "invalid_docling_structure"),
        ({"payload": {"structured": GOOD | {"texts": [GOOD["texts"][0], {k: v for k, v in GOOD["texts"][1].items() if k != "orig"} | {"text": "Some"}]}}}, "unsupported_charspan_contract"),
        ({"row": {"item_key": ""}}, "missing_zotero_identity"),
    ],
)
def test_gates(spark, changes, error):
    docs = reconstruct.documents(*frames(spark, {"zotero:1": (GOOD, "# Methods")}, **changes))
    (r,) = reconstruct.loaded(docs, reconstruct.paragraphs(docs)).collect()
    assert r.error == error and r.coverage == (1.0 if error is None else None)


def test_supported_versions(spark):
    good = ["2.112", "2.112.0", "v2.112.9", "2.112.1rc1", "2.113rc1", "2.113.0.dev3", "2.112.post1", "2.112+cpu", "2.112.0.post1.dev2"]
    bad = ["2.113", "2.112rc1", "2.112.dev1", "2.111.9", "3.0", "x", "", "1!2.112", "2.113.0", "2.113.post1"]
    df = spark.createDataFrame([(v,) for v in good + bad], "v string")
    from pyspark.sql import functions as F

    assert {r.v for r in df.where(reconstruct.supported(F.col("v"))).collect()} == set(good)
