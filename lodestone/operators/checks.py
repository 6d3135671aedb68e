"""Checks of snapshots, deltas, collections, indexes, evidence and materials: rows of (code, key)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.hashing import sha256


def _found(rows: DataFrame, code: str, key: Column) -> DataFrame:
    return rows.select(F.lit(code).alias("code"), key.cast("string").alias("key"))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def snapshot_findings(lines: DataFrame, state: DataFrame, required: list[str]) -> DataFrame:
    """Lines (line, document_id, json, fingerprint, recomputed, required...) of a snapshot against the state (document_id, manifest_json): ids that
    repeat, lines out of order, missing fields, fingerprints that don't follow from the record, records that differ from the state."""
    again = lines.groupBy("document_id").count().where("count > 1")
    # neighbours in the order of lines meet by an equi-join, so that no window holds all lines
    after = lines.select((F.col("line") - 1).alias("line"), F.col("document_id").alias("next_id"))
    falls = lines.join(after, "line").where(F.col("document_id") > F.col("next_id"))
    parts = [_found(again, "duplicate_document_id", F.col("document_id")), _found(falls, "snapshot_order", F.col("next_id"))]
    parts += [_found(lines.where(F.col(c).isNull()), f"missing_{c}", F.col("document_id")) for c in required]
    parts.append(_found(lines.where(~F.col("fingerprint").eqNullSafe(F.col("recomputed"))), "fingerprint_mismatch", F.col("document_id")))
    differ = lines.join(state, "document_id").where(~F.col("json").eqNullSafe(F.col("manifest_json")))
    return _all([*parts, _found(differ, "manifest_db_mismatch", F.col("document_id"))])


def delta_findings(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows (file, line, document_id, operation, sync_id, file_sync) of delta files: unknown operations, rows of another sync, ids that repeat in a
    file, rows out of order, upserts of unknown documents."""
    parts = [_found(rows.where(~F.coalesce(F.col("operation").isin("upsert", "delete"), F.lit(False))), "invalid_operation", F.col("document_id"))]
    parts.append(_found(rows.where(~F.col("sync_id").eqNullSafe(F.col("file_sync"))), "sync_id_mismatch", F.col("document_id")))
    parts.append(_found(rows.groupBy("file", "document_id").count().where("count > 1"), "duplicate_delta_document", F.col("document_id")))
    ordered = rows.withColumn("before", F.lag("document_id").over(Window.partitionBy("file").orderBy("line")))
    parts.append(_found(ordered.where(F.col("before") > F.col("document_id")), "delta_order", F.col("document_id")))
    unknown = rows.where("operation = 'upsert'").join(documents.select("document_id"), "document_id", "left_anti")
    return _all([*parts, _found(unknown, "unknown_document", F.col("document_id"))])


def collection_findings(stored: DataFrame, paths: DataFrame) -> DataFrame:
    """Collections whose stored path (key, path) isn't the one that follows from their parents (key, path, fault), and the faults of those."""
    both = paths.join(stored.select("key", F.col("path").alias("stored")), "key", "full")
    parts = [_found(both.where("fault IS NOT NULL"), "collection_fault", F.concat_ws(":", "fault", "key"))]
    parts.append(_found(both.where("path IS NULL"), "unknown_collection", F.col("key")))
    parts.append(_found(both.where("stored IS NULL AND path IS NOT NULL"), "missing_collection", F.col("key")))
    return _all([*parts, _found(both.where("path <> stored"), "collection_path_mismatch", F.col("key"))])


def index_findings(state: DataFrame, tombstones: DataFrame, chunks: DataFrame, sources: DataFrame, points: DataFrame) -> DataFrame:
    """An index's state (document_id, active, content, chunk_count) against its tombstones (document_id), chunks (chunk_id, document_id), sources (document_id,
    content) and remote points (point_id, document_id)."""
    live, ids = state.where("active"), lambda df: df.select("document_id").distinct()
    known = live.join(sources.withColumnRenamed("content", "own"), "document_id", "left")
    counted = chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("found"))
    parts = [
        _found(live.join(ids(tombstones), "document_id", "left_semi"), "active_tombstone", F.col("document_id")),
        _found(state.where("NOT active").join(ids(tombstones), "document_id", "left_anti"), "inactive_without_tombstone", F.col("document_id")),
        _found(known.where("own IS NULL"), "missing_source", F.col("document_id")),
        _found(known.where("own <> content"), "stale_content", F.col("document_id")),
        _found(live.join(counted, "document_id", "left").where(F.coalesce("found", F.lit(0)) != F.col("chunk_count")), "chunk_count_mismatch", F.col("document_id")),
        _found(chunks.join(ids(live), "document_id", "left_anti"), "orphan_chunk", F.col("chunk_id")),
        _found(chunks.join(ids(live), "document_id", "left_semi").join(points.select(F.col("point_id").alias("chunk_id")), "chunk_id", "left_anti"), "missing_point", F.col("chunk_id")),
        _found(points.join(chunks.select(F.col("chunk_id").alias("point_id")), "point_id", "left_anti"), "extra_point", F.col("point_id")),
    ]
    return _all(parts)


def evidence_findings(evidence: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(evidence_id, error) of evidence whose source changed, the first of the reasons. evidence: (evidence_id, document_id, paragraph_id, parse, content,
    begin, end, text, paragraph_hash); paragraphs: (document_id, paragraph_id, p_parse, p_content, p_text)."""
    both = evidence.join(paragraphs, ["document_id", "paragraph_id"], "left")
    span = F.substring(F.col("p_text"), F.col("begin") + 1, F.col("end") - F.col("begin"))
    error = F.when(F.col("p_text").isNull(), "paragraph not found").when(~F.col("parse").eqNullSafe(F.col("p_parse")), "parse fingerprint changed")
    error = error.when(~F.col("content").eqNullSafe(F.col("p_content")), "source content fingerprint changed").when(~F.col("text").eqNullSafe(span), "exact span no longer matches source")
    error = error.when(~F.col("paragraph_hash").eqNullSafe(sha256(F.col("p_text"))), "source paragraph hash changed")
    return both.select("evidence_id", error.alias("error")).where("error IS NOT NULL")


def repeated_segments(text: Column) -> Column:
    """How often the most frequent segment between full stops stands in a text; white space and case do not count."""
    parts = F.filter(F.transform(F.split(F.lower(text), r"[.!?。！？\n]+"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))), lambda s: F.length(s) >= 8)
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(state: Column, part: Column) -> Column:
        run = F.when(part.eqNullSafe(state["last"]), state["run"] + 1).otherwise(F.lit(1))
        return F.struct(part.alias("last"), run.alias("run"), F.greatest(state["most"], run).alias("most"))

    return F.coalesce(F.aggregate(F.array_sort(parts), start, step, lambda s: s["most"]), F.lit(0))


def quality_findings(assets: DataFrame, least_score: float, most_characters: int, most_repeats: int, most_members: int) -> DataFrame:
    """(code, key, observed) of materials (asset_id, asset_type, category, language, text, items array, score, cluster): low scores, list items that
    repeat, texts that are too long or repeat a segment, equal texts, clusters that are too large. Groups are named by their least id."""
    normal = F.lower(F.trim(F.regexp_replace("text", r"(?U)\s+", " ")))
    row = lambda df, code, key, observed: df.select(F.lit(code).alias("code"), key.cast("string").alias("key"), observed.cast("double").alias("observed"))
    told = assets.withColumns({"normal": normal, "repeats": F.size("items") - F.size(F.array_distinct("items")), "segments": repeated_segments(F.col("text"))})
    one = F.col("asset_id")
    equal = told.groupBy("asset_type", "category", "language", "normal").agg(F.min("asset_id").alias("asset_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = assets.where("cluster IS NOT NULL").groupBy("asset_type", "cluster").agg(F.min("asset_id").alias("asset_id"), F.count(F.lit(1)).alias("n")).where(F.col("n") > most_members)
    parts = [
        row(told.where(F.col("score") < least_score), "low_quality_score", one, F.col("score")),
        row(told.where("repeats > 0"), "repeated_list_item", one, F.col("repeats")),
        row(told.where(F.length("text") > most_characters), "oversized_text_field", one, F.length("text")),
        row(told.where(F.col("segments") > most_repeats), "repeated_text_segment", one, F.col("segments")),
        row(equal, "exact_duplicate_primary_text", one, F.col("n")),
        row(crowded, "near_duplicate_cluster", one, F.col("n")),
    ]
    return _all(parts)
