"""Incremental maintenance: snapshot diffs, stage decisions, delta logs and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INVALID = ["unstable_archive", "invalid_archive", "missing_pdf", "ambiguous_attachment", "unsupported_attachment"]


def change_reason(old: str = "old", new: str = "new") -> Column:
    """Why a document changed: the first rule that holds, else null."""
    o, n = F.col(old), F.col(new)
    differs = lambda field: ~o[field].eqNullSafe(n[field])
    return (
        F.when((o["status"] != "ready") & (n["status"] == "ready"), "attachment_became_available")
        .when((o["status"] == "ready") & (n["status"] == "missing_archive"), "attachment_missing")
        .when(differs("status") & n["status"].isin(INVALID), "attachment_became_invalid")
        .when(differs("content"), "content_changed")
        .when(differs("archive"), "attachment_replaced")
        .when(differs("metadata") & differs("collections"), "collection_changed")
        .when(differs("metadata"), "metadata_changed")
        .when(differs("status"), "attachment_became_invalid")
    )


def snapshot_diff(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, operation, reason) of changed rows; both have status, content, archive, metadata and collections."""
    fields = ["status", "content", "archive", "metadata", "collections"]
    old = previous.select(key, F.struct(*fields).alias("old"))
    new = current.select(key, F.struct(*fields).alias("new"))
    both = old.join(new, key, "full_outer")
    reason = F.when(F.col("new").isNull(), "deleted").when(F.col("old").isNull(), "new_document").otherwise(change_reason())
    operation = F.when(F.col("new").isNull(), "delete").otherwise("upsert")
    return both.select(key, operation.alias("operation"), reason.alias("reason")).where("reason IS NOT NULL")


def chunk_required(reason: Column, ready: Column, metadata_too: bool = False) -> Column:
    wanted = ["new_document", "attachment_became_available", "content_changed", "attachment_replaced", *(["metadata_changed", "collection_changed"] if metadata_too else [])]
    return ready & reason.isin(wanted)


def stage(docs: DataFrame, state: DataFrame, key: str, force: bool = False) -> DataFrame:
    """(key, stage): parse, payload, chunk, embed or skip. docs: content, metadata, parse_fp, chunk_fp, embed_fp;
    state: the same with an s_ prefix and the statuses s_parse, s_chunk, s_embed."""
    both = docs.join(state, key, "left")
    differs = lambda name: ~F.col(name).eqNullSafe(F.col("s_" + name))
    stale = lambda name: ~F.col("s_" + name).eqNullSafe(F.lit("ready"))
    parse = F.lit(force) | differs("content") | stale("parse") | differs("parse_fp")
    return both.select(
        key,
        F.when(parse, "parse")
        .when(differs("metadata"), "payload")
        .when(stale("chunk") | differs("chunk_fp"), "chunk")
        .when(stale("embed") | differs("embed_fp"), "embed")
        .otherwise("skip")
        .alias("stage"),
    )


def symbol_status(old: Column, new: Column) -> Column:
    """What became of a symbol: structs of ast_hash, signature and path, null where a version lacks it."""
    return (
        F.when(old.isNull(), "introduced")
        .when(new.isNull(), "removed")
        .when(old["ast_hash"] == new["ast_hash"], "unchanged")
        .when(old["signature"] != new["signature"], "signature_changed")
        .when(old["path"] != new["path"], "moved")
        .otherwise("modified")
    )


def pair_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, status, confidence) of symbols of two versions: ast_hash, signature and path."""
    fields = ["ast_hash", "signature", "path"]
    both = old.select(key, F.struct(*fields).alias("old")).join(new.select(key, F.struct(*fields).alias("new")), key, "full_outer")
    status = symbol_status(F.col("old"), F.col("new"))
    return both.select(key, status.alias("status")).withColumn("confidence", F.when(F.col("status").isin("moved", "modified"), 0.8).otherwise(1.0))


def skippable(docs: DataFrame, state: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """docs with ``skip``: active in the state with equal fields."""
    held = state.where("active").select(key, *(F.col(f).alias("s_" + f) for f in fields), F.lit(True).alias("held"))
    same = F.coalesce(F.col("held"), F.lit(False))
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col("s_" + f))
    return docs.join(held, key, "left").withColumn("skip", same).select(*docs.columns, "skip")


def pruned(state: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Active rows of the state that the build no longer has."""
    return state.where("active").join(docs, key, "left_anti")


def latest(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last row of each key in the given order."""
    by = Window.partitionBy(key).orderBy(*(c.desc_nulls_last() for c in order))
    return rows.withColumn("_place", F.row_number().over(by)).where("_place = 1").drop("_place")


def folded(deltas: DataFrame, key: str, sequence: str, operation: str) -> DataFrame:
    """The state after a delta log: the last operation of each key, without deleted ones."""
    return latest(deltas, key, F.col(sequence)).where(F.col(operation) != "delete")


def chain_faults(catalog: DataFrame) -> DataFrame:
    """(sequence, fault) of a delta catalogue: gaps, wrong predecessors, version gaps.

    A row whose predecessor isn't the sequence before its own is a gap, so the others meet theirs by an equi-join and no
    window spans the catalogue. Of rows that share a sequence, the first by sync_id follows the sequence before; the rest are gaps.
    """
    first = F.row_number().over(Window.partitionBy("sequence").orderBy("sync_id")) == 1
    last = catalog.groupBy((F.col("sequence") + 1).alias("sequence")).agg(F.max(F.struct("sync_id", "target_version")).alias("before"))
    start = F.broadcast(catalog.agg(F.min("sequence").alias("start")))  # one row
    rows = catalog.withColumn("first", first).join(last, "sequence", "left").join(start, F.lit(True))
    before = F.col("before")
    follows = F.col("first") & (before.isNotNull() | ((F.col("sequence") == 1) & (F.col("start") == 1)))
    fault = (
        F.when(~follows, "sequence_gap")
        .when(~F.col("previous_sync_id").eqNullSafe(before["sync_id"]), "wrong_predecessor")
        .when(F.col("from_version") != before["target_version"], "version_gap")
    )
    return rows.select("sequence", fault.alias("fault")).where("fault IS NOT NULL")


def contiguous(chunks: DataFrame, key: str, index: str) -> DataFrame:
    """(key, contiguous): indices are 0 to n - 1."""
    n = F.count(F.lit(1))
    return chunks.groupBy(key).agg(((F.min(index) == 0) & (F.max(index) == n - 1) & (F.countDistinct(index) == n)).alias("contiguous"))


def expired(rows: DataFrame, group: str, keep: int, newest: Column, tie: str, protected: Column) -> DataFrame:
    """Rows beyond the ``keep`` newest of a group, except protected ones."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(newest.desc(), F.col(tie)))
    return rows.withColumn("place", place).where((F.col("place") > keep) & ~protected)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: whether both hold the same rows, as often."""
    left = a.exceptAll(b).agg(F.count(F.lit(1)).alias("gone"))
    return left.join(b.exceptAll(a).agg(F.count(F.lit(1)).alias("come")), F.lit(True)).withColumn("same", (F.col("gone") == 0) & (F.col("come") == 0))
