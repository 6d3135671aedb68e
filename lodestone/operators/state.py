"""Incremental state as DataFrames: upserts, tombstones, invalidation, queues, mirrors and plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.rows import spread

STAGES = ("parse", "chunk", "embedding", "index")
#: Where each kind of invalidation starts; a document that is unavailable loses its place as well.
LEVELS = {"content": 0, "chunks": 1, "unavailable": 0}
#: The states that an experiment may go to.
TRANSITIONS = {"planned": ("running", "cancelled"), "running": ("completed", "failed", "cancelled")}
#: Fixed value: words of breaking releases.
BREAKING = r"(?i)\b(?:breaking|removed|incompatible|deprecat\w*)\b"
#: Rows that one row becomes at a time, where a join repeats it, and such blocks that are dealt together.
REPEATS, BLOCKS = 4096, 1 << 10


def upserted(state: DataFrame, new: DataFrame, key: str, sources: list[str]) -> DataFrame:
    """The state after an upsert: new rows bring their ``sources`` columns, all other columns of a known row stay."""
    own = new.select(F.col(key).alias("_key"), *(F.col(c).alias("_" + c) for c in sources), F.lit(True).alias("_new"))
    both = state.join(own, F.col(key) == F.col("_key"), "full")
    columns = [F.coalesce(key, "_key").alias(key) if c == key else F.when(F.col("_new"), F.col("_" + c)).otherwise(F.col(c)).alias(c) if c in sources else F.col(c) for c in state.columns]
    return both.select(*columns)


def tombstoned(index: DataFrame, tombstones: DataFrame, new: DataFrame, gone: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The index (key, active) and the tombstones (key, reason) after upserts (key), which clear tombstones, and removals (key, reason), which win."""
    added, lost = new.select(key).distinct(), gone.groupBy(key).agg(F.max("reason").alias("reason"))
    every = index.select(key, "active").join(added.withColumn("_added", F.lit(True)), key, "full").join(lost.withColumn("_lost", F.lit(True)), key, "left")
    active = F.when(F.col("_lost"), False).when(F.col("_added"), True).otherwise(F.col("active"))
    kept = tombstones.join(added, key, "left_anti").join(lost, key, "left_anti")
    return every.select(key, active.alias("active")), kept.unionByName(lost)


def invalidated(state: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The state (key, parse, chunk, embedding, index, active) after changes (key, level), of which the widest counts."""
    start = F.coalesce(*(F.when(F.col("level") == name, F.lit(at)) for name, at in LEVELS.items()))
    widest = changes.groupBy(key).agg(F.min(start).alias("_from"), F.bool_or(F.col("level") == "unavailable").alias("_gone"))
    both = state.join(widest, key, "left")
    stages = [F.when(F.col("_from") <= i, "stale").otherwise(F.col(c)).alias(c) for i, c in enumerate(STAGES)]
    return both.select(key, *stages, F.when(F.col("_gone"), False).otherwise(F.col("active")).alias("active"))


def replaced_chunks(chunks: DataFrame, new: DataFrame, document: str, chunk: str) -> DataFrame:
    """Chunks (document, chunk, text, active) after documents got new ones (document, chunk, text): all others of theirs are inactive."""
    touched = new.select(document).distinct().withColumn("_touched", F.lit(True))
    own = new.select(document, chunk, F.col("text").alias("_text"), F.lit(True).alias("_new"))
    both = chunks.join(own, [document, chunk], "full").join(touched, document, "left")
    return both.select(document, chunk, F.coalesce("_text", "text").alias("text"), F.when(F.col("_new"), True).when(F.col("_touched"), False).otherwise(F.col("active")).alias("active"))


def pending_operations(log: DataFrame, key: str, done: DataFrame) -> DataFrame:
    """(key, sequence, operation): the last operation of each document of a log (key, sequence, operation), unless that one is done (key, sequence)."""
    last = log.groupBy(key).agg(F.max_by(F.struct("sequence", "operation"), "sequence").alias("l")).select(key, "l.*")
    return last.join(done.select(key, "sequence"), [key, "sequence"], "left_anti")


def mirrored(local: DataFrame, remote: DataFrame, removed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The mirror (key, version, deleted) after remote rows (key, version) and removals (key), and the deletions (key, version) that are new."""
    own, lost = remote.select(key, F.col("version").alias("_version")), removed.select(key).distinct().withColumn("_lost", F.lit(True))
    both = local.join(own, key, "full").join(lost, key, "left")
    deleted = F.when(F.col("_version").isNotNull(), False).when(F.col("_lost"), True).otherwise(F.col("deleted"))
    after = both.select(key, F.coalesce("_version", "version").alias("version"), deleted.alias("deleted"), F.coalesce("deleted", F.lit(True)).alias("_before"))
    return after.drop("_before"), after.where("deleted AND NOT _before").select(key, "version")


def to_fetch(remote: DataFrame, local: DataFrame, key: str, full: bool = False) -> DataFrame:
    """Keys of a remote version map (key, version) that the mirror (key, version, deleted) lacks, has in another version or has deleted; all, if ``full``."""
    own = local.select(key, F.col("version").alias("_version"), F.col("deleted").alias("_deleted"), F.lit(True).alias("_known"))
    both = remote.join(own, key, "left")
    return both.where(F.lit(full) | F.col("_known").isNull() | ~F.col("version").eqNullSafe(F.col("_version")) | F.coalesce("_deleted", F.lit(False))).select(key)


def embed_pending(state: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Active documents whose chunks are ready and whose vectors aren't. state: (key, active, chunk, embedding, dense, sparse, fingerprint, expected)."""
    ready = F.lit(True)
    for c in ("embedding", "dense", "sparse"):
        ready &= F.col(c).eqNullSafe(F.lit("ready"))
    done = ready & F.col("fingerprint").eqNullSafe(F.col("expected"))
    return state.where(F.col("active") & (F.col("chunk") == "ready") & (F.lit(force) | ~done)).select(key)


def attempts(log: DataFrame, task: str) -> DataFrame:
    """(task, attempt): the number of each task's next attempt."""
    return log.groupBy(task).agg((F.max("attempt") + 1).alias("attempt"))


def transition_faults(log: DataFrame, by: str, order: str, status: str) -> DataFrame:
    """Events of a log whose status can't follow the one before (the first must be planned)."""
    told = log.withColumn("before", F.coalesce(F.lag(status).over(Window.partitionBy(by).orderBy(order)), F.lit("new")))
    allowed = F.col(status).isin("planned") & (F.col("before") == "new")
    for name, after in TRANSITIONS.items():
        allowed |= (F.col("before") == name) & F.col(status).isin(*after)
    return told.where(~allowed).select(by, order, "before", status)


def ingest_plan(sources: DataFrame, state: DataFrame, key: str, by: str) -> DataFrame:
    """(by, selected, known, fresh): how many documents an ingestion would take, without taking them."""
    known = sources.join(state.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    return known.groupBy(by).agg(F.count(F.lit(1)).alias("selected"), F.count("_known").alias("known"), F.count_if(F.col("_known").isNull()).alias("fresh"))


def consumed_all(consumed: DataFrame, catalog: DataFrame) -> DataFrame:
    """The offsets (sequence, delta_sha256) after a full run took the whole catalogue; those consumed before stay as they are."""
    return consumed.unionByName(catalog.select(*consumed.columns).join(consumed.select("sequence"), "sequence", "left_anti").select(*consumed.columns))


def attachment_findings(attachments: DataFrame, archives: DataFrame) -> DataFrame:
    """(code, key) of attachments (key, status, path, digest) that claim to be ready without a path, with another content than the archive (path, found), or
    that are gone."""
    both = attachments.where("status = 'ready'").join(archives, "path", "left")
    code = F.when(F.col("path").isNull(), "ready_without_path").when(F.col("found").isNull(), "missing_archive").when(F.col("found") != F.col("digest"), "hash_mismatch")
    return both.select(code.alias("code"), F.col("key").cast("string").alias("key")).where("code IS NOT NULL")


def cleanup(files: DataFrame, now: Column, hours: int, current: DataFrame) -> DataFrame:
    """Files (path, source, modified) older than so many hours whose source isn't current (source)."""
    old = files.where(F.col("modified") < now - F.make_interval(hours=F.lit(hours)))
    return old.join(current.select("source").distinct(), "source", "left_anti")


def unreferenced(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Artifacts (name, ...) that nothing expects (name)."""
    return files.join(expected.select("name").distinct(), "name", "left_anti")


def resolved_tags(wanted: DataFrame, tags: DataFrame, patterns: list[str]) -> DataFrame:
    """(library, version, tag): the tag of a version, by the first of the patterns ("v{version}") that fits, else by equal numbers."""
    numbers = lambda c: F.regexp_replace(F.regexp_extract(c, r"(\d+(?:\.\d+)*)$", 1), r"(\.0+)+$", "")
    named = wanted.select("library", "version", F.posexplode(F.array(*(F.replace(F.lit(p), F.lit("{version}"), F.col("version")) for p in patterns))).alias("rank", "tag"))
    exact = named.join(tags.select("library", "tag").distinct(), ["library", "tag"]).select("library", "version", "rank", "tag")
    other = wanted.withColumn("_n", numbers("version")).join(tags.select("library", F.col("tag"), numbers("tag").alias("_n")), ["library", "_n"]).where("_n <> ''")
    every = exact.unionByName(other.select("library", "version", F.lit(len(patterns)).alias("rank"), "tag"))
    return every.groupBy("library", "version").agg(F.min(F.struct("rank", "tag"))["tag"].alias("tag"))


def release_watch(releases: DataFrame, seen: DataFrame, by: str) -> DataFrame:
    """(by, latest, changed, breaking): the latest stable release of each library (by, version, notes), whether it is another than the one seen last (by, seen),
    and whether its notes tell of breaking changes."""
    from lodestone.operators.records import release_key

    stable = releases.where(F.col("version").rlike(r"^v?\d+(\.\d+)*$"))
    last = stable.groupBy(by).agg(F.max(F.struct(release_key(F.col("version")).alias("order"), "version", "notes")).alias("l")).select(by, F.col("l.version").alias("latest"), F.col("l.notes").alias("notes"))
    both = last.join(seen, by, "left")
    return both.select(by, "latest", (~F.col("latest").eqNullSafe(F.col("seen"))).alias("changed"), F.coalesce(F.col("notes").rlike(BREAKING), F.lit(False)).alias("breaking"))


def source_markers(symbols: DataFrame, markers: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits (symbol, point_id, score) of the symbols (symbol, path, version) that a marker (path, version) vouches for: one row for each hit and vouched entry of
    its symbol. Entries travel as a number for each symbol; hits are dealt over all tasks, once for ``BLOCKS`` blocks of at most ``REPEATS`` rows, and become
    blocks and rows there, so what is shuffled grows with the hits, not with the rows."""
    entries = symbols.join(markers, ["path", "version"]).groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"))
    shares = hits.join(entries, "symbol").withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(REPEATS * BLOCKS).cast("bigint"))))
    dealt = shares.repartition(spread(hits), "symbol", "point_id", "_from").withColumn("_to", F.least("_n", F.col("_from") + REPEATS * BLOCKS))
    # the function of each block keeps the two explosions apart in a task: one alone would hold all rows of a share
    left = F.transform(F.sequence("_from", F.col("_to") - 1, F.lit(REPEATS).cast("bigint")), lambda at: F.least(F.col("_to") - at, F.lit(REPEATS)).cast("int"))
    blocks = dealt.select("symbol", "point_id", "score", F.explode(left).alias("_left"))
    return blocks.select("symbol", "point_id", "score", F.explode(F.sequence(F.lit(1), F.col("_left"))).alias("_")).drop("_")


def contained(refs: DataFrame, chunks: DataFrame, document: str) -> DataFrame:
    """(document, paragraph_id, chunk_id, available): each paragraph's chunk. refs: (document, paragraph_id, ref); chunks: (document, chunk_id, ref). A document is available
    only if each reference of each of its paragraphs lies in exactly one chunk, the same for a paragraph. Both meet in one shuffle by document; repeated rows change nothing."""
    own = refs.select(document, "ref", "paragraph_id", F.lit(None).cast(chunks.schema["chunk_id"].dataType).alias("chunk_id"), F.lit(True).alias("_asked"))
    held = chunks.select(document, "ref", F.lit(None).cast(refs.schema["paragraph_id"].dataType).alias("paragraph_id"), "chunk_id", F.lit(False).alias("_asked"))
    by = Window.partitionBy(document, "ref")
    both = own.unionByName(held).repartition(spread(refs), document)
    both = both.withColumns({"_low": F.when(F.col(document).isNotNull() & F.col("ref").isNotNull(), F.min("chunk_id").over(by)), "_high": F.max("chunk_id").over(by)}).where("_asked")
    one = F.coalesce(F.col("_low") == F.col("_high"), F.lit(False))
    per = both.groupBy(document, "paragraph_id").agg((F.every(one) & (F.min("_low") == F.max("_low"))).alias("sound"), F.min("_low").alias("chunk_id"))
    per = per.withColumn("available", F.every(F.coalesce("sound", F.lit(False))).over(Window.partitionBy(document)))
    return per.select(document, "paragraph_id", F.when(F.col("available"), F.col("chunk_id")).alias("chunk_id"), "available")


def stage_chain(document: Column, *configs: Column) -> list[Column]:
    """Fingerprints of stages, each the hash of the one before and of its own configuration."""
    return reduce(lambda done, config: [*done, F.sha2(F.concat(F.lit('{"config":"'), config, F.lit('","before":"'), done[-1], F.lit('"}')).cast("binary"), 256)], configs, [document])[1:]
