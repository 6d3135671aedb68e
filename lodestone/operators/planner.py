"""One planner for every way of bringing an index up to date: full, reconcile, incremental, resume, parse and embed.

A mode is a row of data: which documents it starts from, whether it may prune, and how far it goes. All modes read the same table, the snapshot, the
state and the last pending change of each document in one full outer join, and take the first stage that a document needs. Only a full run over the unfiltered
snapshot prunes what the snapshot lacks, and marks the whole change log as consumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mode:
    """``starts``: snapshot, changes or state; ``pending``: only documents whose chunks wait for an index."""

    starts: str
    prunes: bool = False
    parse_only: bool = False
    pending: bool = False
    never_forced: bool = False


MODES = {
    "full": Mode("snapshot"),
    "reconcile": Mode("snapshot", prunes=True, never_forced=True),
    "incremental": Mode("changes", never_forced=True),
    "resume": Mode("state", never_forced=True),
    "parse": Mode("snapshot", parse_only=True),
    "embed": Mode("state", pending=True),
}


def joined(snapshot: DataFrame, state: DataFrame, changes: DataFrame) -> DataFrame:
    """(document_id, now, was, change): what the snapshot, the state and the last pending change say of each document, null where they don't. snapshot:
    (document_id, attachment_key, line, content, metadata, parse_fp, chunk_fp, embed_fp); state: (document_id, attachment_key, active, content, metadata, parse_fp,
    chunk_fp, embed_fp, parse, chunk, embed, dense, sparse); changes: (sequence, place, document_id, operation, ready). Ids are unique in the first two."""
    side = lambda df, c: df.select("document_id", F.struct(*(x for x in df.columns if x != "document_id")).alias(c))
    last = changes.groupBy("document_id").agg(F.max_by(F.struct("operation", "ready", "sequence", "place"), F.struct("sequence", "place")).alias("change"))
    return side(snapshot, "now").join(side(state, "was"), "document_id", "full_outer").join(last, "document_id", "full_outer")


def stage(now: Column, was: Column, force: bool) -> Column:  # noqa: FBT001
    """The first stage that a document needs: parse, payload, chunk, embed or skip."""
    differs = lambda c: ~now[c].eqNullSafe(was[c])
    stale = lambda c: ~was[c].eqNullSafe(F.lit("ready"))
    return (
        F.when(F.lit(force) | was.isNull() | differs("content") | stale("parse") | differs("parse_fp"), "parse")
        .when(differs("metadata"), "payload")
        .when(stale("chunk") | differs("chunk_fp"), "chunk")
        .when(stale("embed") | differs("embed_fp") | stale("dense") | stale("sparse"), "embed")
        .otherwise("skip")
    )


def plan(every: DataFrame, mode: str, limit: int | None = None, document_id: str | None = None, attachment_key: str | None = None, force: bool = False, prune: bool = False, parse_only: bool = False) -> DataFrame:  # noqa: FBT001, FBT002
    """(document_id, action): parse, payload, chunk, embed, skip or delete for each document of a run. every: ``joined``. ``limit`` keeps the
    first documents, of a snapshot by lines, of the state by ids; incremental runs take all changes and no filters."""
    kind = MODES[mode]
    force, only_parse = force and not kind.never_forced, parse_only or kind.parse_only
    now, was, change = F.col("now"), F.col("was"), F.col("change")
    filtered = limit is not None or document_id is not None or attachment_key is not None
    if kind.starts == "changes":
        if filtered:
            raise ValueError("incremental runs take no filters")
        rows = every.where(change.isNotNull())
        gone = (change["operation"] == "delete") | ~F.coalesce(change["ready"], F.lit(False))
        unknown = was.isNull() | ~F.coalesce(was["active"], F.lit(False))
        # what is gone and was never there needs nothing
        action = F.when(gone, F.when(unknown, "skip").otherwise("delete")).otherwise(stage(now, was, force))
    else:
        from_state = kind.starts == "state"
        own = was if from_state else now
        rows = every.where(F.coalesce(was["active"], F.lit(False)) if from_state else now.isNotNull())
        if document_id is not None:
            rows = rows.where(F.col("document_id") == document_id)
        if attachment_key is not None:
            rows = rows.where(own["attachment_key"] == attachment_key)
        # a document of the state that the snapshot lacks is judged by what the state says of it
        seen = F.coalesce(now, F.struct(*(was[c].alias(c) for c in ("attachment_key",)), F.lit(None).cast("bigint").alias("line"), *(was[c].alias(c) for c in ("content", "metadata", "parse_fp", "chunk_fp", "embed_fp")))) if from_state else now
        action = stage(seen, was, force)
        if kind.pending:
            waits = F.lit(force) | ~(was["embed"].eqNullSafe(F.lit("ready")) & was["embed_fp"].eqNullSafe(seen["embed_fp"]) & was["dense"].eqNullSafe(F.lit("ready")) & was["sparse"].eqNullSafe(F.lit("ready")))
            rows, action = rows.where((was["chunk"] == "ready") & waits), F.lit("embed")
        if limit is not None:
            rows = rows.orderBy(*([] if from_state else ["now.line"]), "document_id").limit(limit)
    if only_parse:
        action = F.when(action == "embed", "skip").otherwise(action)
    out = rows.select("document_id", action.alias("action"))
    if kind.starts == "snapshot" and (prune or kind.prunes) and not filtered:
        out = out.unionByName(every.where(now.isNull() & F.coalesce(was["active"], F.lit(False))).select("document_id", F.lit("delete").alias("action")))
    return out


def consumed(changes: DataFrame, mode: str, filtered: bool = False) -> DataFrame:  # noqa: FBT001, FBT002
    """(sequence) of the changes that a successful run marks as consumed: all of them in incremental and in unfiltered full runs, else none."""
    takes = MODES[mode].starts == "changes" or (MODES[mode].starts == "snapshot" and not MODES[mode].parse_only and not filtered)
    return changes.where(F.lit(takes)).select("sequence").distinct()


def batches(changes: DataFrame, by: str = "sequence") -> DataFrame:
    """changes with ``batch``: their rank among the pending ones, in the order they are consumed in."""
    ranks = changes.select(by).distinct().withColumn("batch", F.dense_rank().over(Window.orderBy(by)))  # a row for each batch
    return changes.join(ranks, by)
