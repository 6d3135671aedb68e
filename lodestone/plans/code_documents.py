"""Chunks of code documents with their metadata, tags, fingerprints and ids.

A document's text is cut once, in Arrow batches, by its kind: Python files by symbol, release notes and all others by section. What a cut knows of a
chunk joins the document's metadata; later names win. Tags, categories, hashes and ids are Spark expressions.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import code, features, hashing, text
from lodestone.functions.code import _rowwise
from lodestone.functions.rows import rowwise

# What fingerprints and ids are made of.
PROCESSOR = "code-structural-v1"
NAMESPACE = uuid.UUID("79cbf091-1a02-51e9-885d-3205873df04b")


def canonical(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def cuts(source_type: str | None, path: str | None, body: str | None) -> Iterator[dict]:
    """(text, extra) of a document's chunks: extra is JSON of what the cut knows."""
    python = source_type == "source_code" and (path or "").endswith(".py")
    for found in code.python_chunks(body or "", path) if python else code.markup_chunks(body or ""):
        part = {} if found["first_line"] is None else {"part_start_line": found["first_line"], "part_end_line": found["last_line"]}
        if not python:
            extra = {"section": found["section"]}
        elif found["symbol"] is not None:
            extra = {"module": found["module"], "symbol": found["symbol"], "symbol_type": found["symbol_type"], "parent_symbol": found["parent"], "start_line": found["start_line"], "end_line": found["end_line"]}
        else:
            extra = ({"module": found["module"]} if found["parsed"] else {"path": path}) | {"symbol_type": "module"}
        yield {"text": found["text"], "extra": canonical(extra | part)}


def _merged(metadata: str | None, extra: str, category: str | None, source_type: str | None, url: str | None, title: str | None, tags: list[str]) -> str:
    own = json.loads(metadata or "{}") | json.loads(extra) | ({} if category is None else {"change_category": category})
    return canonical(own | {"knowledge_base": "code", "source_type": source_type, "source_url": url, "title": title, "task_tags": tags})


def _named(document: str | None, index: int, body: str, *facts) -> list[str]:  # noqa: ANN002
    """A chunk's metadata and its fingerprint."""
    metadata = _merged(*facts)
    identity = canonical({"document_id": document, "index": index, "processor": PROCESSOR, "text": body, "metadata": json.loads(metadata)})
    return [metadata, hashlib.sha256(identity.encode()).hexdigest()]


def chunks(documents: DataFrame) -> DataFrame:
    """(document_id, chunk_index, chunk_id, chunk_fingerprint, text, text_sha256, token_count, section_path, metadata) of documents (document_id, source_type,
    path, source_url, title, content, metadata JSON), ids unique. Null contents have no chunks; null metadata is empty."""
    facts = ["document_id", "source_type", "path", "source_url", "title", "metadata"]
    rows = documents.select(F.to_json(F.struct(*facts), {"ignoreNullFields": "false"}).alias("facts"), "source_type", "path", "content")
    found = _rowwise(rows, ["facts", "source_type", "path", "content"], cuts, {"text": "string", "extra": "string"})
    found = found.withColumn("d", F.from_json("facts", ", ".join(f"{c} string" for c in facts)))
    found = found.select("n", "text", "extra", *(F.col(f"d.{c}").alias(c) for c in facts))
    category = F.when(F.col("source_type") == "release_note", features.release_category(F.col("text")))
    found = found.withColumns({"category": category, "tags": text.task_tags(F.coalesce("source_type", F.lit("")), F.col("text"))})
    named = rowwise(_named, "array<string>")(*map(F.col, ("document_id", "n", "text", "metadata", "extra", "category", "source_type", "source_url", "title", "tags")))
    found = found.withColumn("named", named).withColumns({"metadata": F.get("named", F.lit(0)), "chunk_fingerprint": F.get("named", F.lit(1))})
    said = F.regexp_replace("text", r"(?U)^\s+|\s+$", "")
    section = F.get_json_object("extra", "$.section")
    ident = F.array_join(F.array(F.col("document_id"), F.col("n").cast("string"), F.col("chunk_fingerprint")), "\0")
    return found.select(
        "document_id",
        F.col("n").alias("chunk_index"),
        hashing.uuid5(NAMESPACE, ident).alias("chunk_id"),
        "chunk_fingerprint",
        said.alias("text"),
        hashing.sha256(said).alias("text_sha256"),
        text.token_count(said).alias("token_count"),
        F.when(F.coalesce(section, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(section, " > ")).alias("section_path"),
        "metadata",
    )
