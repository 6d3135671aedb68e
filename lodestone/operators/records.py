"""Snapshot records, fingerprints, versions, symbols, document views and selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.hashing import canonical_json, document_id, sha256

# What a digest and a commit look like, and a version's parts.
DIGEST = "^[0-9a-f]{64}$"
COMMIT = "(?i)^[0-9a-f]{7,40}$"
RELEASE = r"(?i)^v?(\d+(?:\.\d+)*)(?:[-_.]?(a|b|c|rc|alpha|beta|pre|preview)[-_.]?(\d*))?(?:[-_.]?post[-_.]?\d*)?(?:[-_.]?(dev)[-_.]?(\d*))?(?:\+([a-z0-9]+(?:[-_.][a-z0-9]+)*))?$"


def content_fingerprint(digest: Column) -> Column:
    """The PDF's own digest, normalised; null if it is none."""
    normal = F.lower(F.trim(digest))
    return F.when(normal.rlike(DIGEST), normal)


def fingerprints(metadata: Column, digest: Column, status: Column, schema_version: int = 1) -> list[Column]:
    """The fingerprints of metadata (canonical JSON), content and document."""
    meta, content = sha256(metadata), content_fingerprint(digest)
    document = canonical_json(schema_version=F.lit(schema_version), metadata_fingerprint=meta, content_fingerprint=content, status=status)
    return [meta.alias("metadata_fingerprint"), content.alias("content_fingerprint"), sha256(document).alias("document_fingerprint")]


def snapshot(attachments: DataFrame, objects: DataFrame, collections: DataFrame, library: str) -> DataFrame:
    """One record for each PDF attachment whose own object and parent are there and not deleted, with its parent's live collections by path.

    attachments: (attachment_key, parent_key, mime_type, digest, status); objects: (key, title, deleted, collections array); collections:
    (key, name, path, deleted)."""
    live = objects.where(~F.coalesce("deleted", F.lit(False)))
    pdfs = attachments.where(F.lower("mime_type") == "application/pdf")
    own = pdfs.join(live.select(F.col("key").alias("attachment_key")), "attachment_key", "left_semi")
    parents = live.select(F.col("key").alias("parent_key"), "title", "collections")
    named = collections.where(~F.coalesce("deleted", F.lit(False))).select("key", F.coalesce("name", F.lit("")).alias("name"), F.coalesce(F.nullif("path", F.lit("")), F.nullif("name", F.lit("")), "key").alias("path"))
    listed = parents.select("parent_key", F.explode("collections").alias("key")).join(named, "key")
    paths = listed.groupBy("parent_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("path", "key"))), lambda c: c["path"]).alias("paths"))
    rows = own.join(parents.drop("collections"), "parent_key").join(paths, "parent_key", "left").withColumn("paths", F.coalesce("paths", F.array().cast("array<string>")))
    metadata = canonical_json(title=F.col("title"), collections=F.col("paths"))
    identity = document_id(F.lit("user"), F.lit(library), F.col("parent_key"), F.col("attachment_key"), F.lit(0))
    return rows.select(identity.alias("document_id"), "attachment_key", "parent_key", "title", "paths", "status", *fingerprints(metadata, F.col("digest"), F.col("status")))


def reason(new: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """(key, reason): why a document must be processed again, the first of the reasons that holds. Both: (key, content, status, parse, chunk, embedding,
    metadata, sparse); the state's columns start with s_."""
    both = new.join(state.withColumn("known", F.lit(True)), key, "left")
    differs = lambda c: ~F.col(c).eqNullSafe(F.col("s_" + c))
    content = differs("content") | ~F.col("s_status").eqNullSafe(F.lit("ready")) | differs("parse")
    rules = F.when(F.col("known").isNull(), "new_document").when(content, "content_or_parser").when(differs("chunk"), "chunk_config")
    rules = rules.when(differs("embedding"), "embedding_config").when(differs("metadata"), "metadata").when(differs("sparse"), "sparse_config")
    return both.select(key, rules.otherwise("unchanged").alias("reason"))


def disposition(documents: DataFrame, prior: DataFrame, key: str, late: list[str]) -> DataFrame:
    """(key, disposition, reason, stage) of an extraction. documents: (key, content, parse, versions map); prior: (key, p_content, p_parse, p_versions map,
    p_status). Versions that differ in ``late`` keys only need the last stage again."""
    both = documents.join(prior.withColumn("known", F.lit(True)), key, "left")
    names = F.array_sort(F.array_distinct(F.concat(F.map_keys("versions"), F.map_keys("p_versions"))))
    changed = F.filter(names, lambda k: ~F.try_element_at("versions", k).eqNullSafe(F.try_element_at("p_versions", k)))
    both = both.withColumn("changed", changed)
    moved, failed = F.size("changed") > 0, F.col("p_status").isin("failed", "partial")
    first = lambda *values: F.when(F.col("known").isNull(), values[0]).when(~F.col("content").eqNullSafe(F.col("p_content")), values[1]).when(~F.col("parse").eqNullSafe(F.col("p_parse")), values[2]).when(moved, values[3]).when(failed, values[4]).when(F.col("p_status") == "inactive", values[5]).otherwise(values[6])
    none, only = F.lit(None).cast("string"), F.size(F.array_except("changed", F.array(*map(F.lit, late)))) == 0
    kinds = first(*map(F.lit, ("new", "changed", "changed", "changed", "failed", "changed", "unchanged")))
    why = first(none, F.lit("source_content_changed"), F.lit("parse_changed"), F.concat(F.lit("version_changed:"), F.array_join("changed", ",")), F.concat(F.lit("prior_"), "p_status"), F.lit("prior_inactive"), none)
    stage = first(none, F.lit("provenance"), F.lit("provenance"), F.when(only, "abstraction").otherwise("classification"), F.lit("failed_stage"), F.lit("provenance"), none)
    return both.select(key, kinds.alias("disposition"), why.alias("reason"), stage.alias("stage"))


def needs_scan(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, needs_scan): archives that were not ready, are gone, or differ in path, size, time or side file. Both: (key, path, size, mtime, ...)."""
    both = previous.join(current.select(key, *(F.col(c).alias("now_" + c) for c in ("path", "size", "mtime"))), key, "left")
    same = F.lit(True)
    for c in ("path", "size", "mtime"):
        same &= F.col(c).eqNullSafe(F.col("now_" + c))
    return both.select(key, (~F.col("status").eqNullSafe(F.lit("ready")) | F.col("now_path").isNull() | ~same | ~F.coalesce("prop_exists", F.lit(False))).alias("needs_scan"))


def wire_status(status: Column) -> Column:
    """The status that leaves the service."""
    kept = status.isin("ready", "missing_archive", "unstable_archive", "ambiguous_attachment")
    return F.when(kept, status).when(status.isin("missing_pdf", "no_pdf"), "missing_pdf").when(status == "extraction_error", "error").otherwise("invalid_archive")


def symbol_lookup(symbols: DataFrame, wanted: DataFrame) -> DataFrame:
    """(wanted, name): for each wanted symbol the shortest name that equals it or ends with it after a dot, ties by name. Names meet the wanted ones by
    their dotted ends, so no pair is tried in vain."""
    parts = F.split("name", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))
    found = symbols.select("name", F.explode(ends).alias("wanted")).join(wanted.select("wanted").distinct(), "wanted")
    return found.groupBy("wanted").agg(F.min(F.struct(F.length("name").alias("length"), F.col("name"))).alias("best")).select("wanted", "best.name")


def version_parts(raw: Column) -> list[Column]:
    """(normalized, release_type, local_build) of a version; the type is null for what is no version."""
    value = F.trim(raw)
    release = F.regexp_extract(value, RELEASE, 1)
    numbers = F.array_join(F.transform(F.split(release, r"\."), lambda p: p.cast("bigint").cast("string")), ".")
    is_version, named = value.rlike(RELEASE), value.isin("main", "master", "nightly")
    kind = F.when(value.isin("main", "master"), "branch").when(value == "nightly", "nightly").when(value.rlike(COMMIT), "commit")
    pre, dev = F.regexp_extract(value, RELEASE, 2) != "", F.regexp_extract(value, RELEASE, 4) != ""
    kind = kind.when(is_version & (pre | dev), "prerelease").when(is_version, "stable")
    normal = F.when(named, value).when(value.rlike(COMMIT), F.lower(value)).when(is_version, numbers)
    local = F.when(is_version & ~named & ~value.rlike(COMMIT), F.nullif(F.regexp_replace(F.lower(F.regexp_extract(value, RELEASE, 6)), "[-_]", "."), F.lit("")))
    return [normal.alias("normalized"), kind.alias("release_type"), local.alias("local_build")]


def release_key(version: Column) -> Column:
    """What sorts released versions: their numbers without zeros at the end."""
    numbers = F.transform(F.split(F.regexp_replace(version, r"^v", ""), r"\."), lambda p: p.cast("bigint"))
    last = F.coalesce(F.array_max(F.transform(numbers, lambda n, i: F.when(n != 0, i + 1).otherwise(0))), F.lit(0))
    return F.when(last > 0, F.slice(numbers, F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array(F.lit(0).cast("bigint")))


def selected_versions(tags: DataFrame, installed: DataFrame, by: str) -> DataFrame:
    """(by, strategy, version): the installed version, the latest stable one and the stable neighbours of the installed one. tags: (by, tag); installed:
    (by, installed). Equal versions count once, by their last tag."""
    plain = F.regexp_replace(F.regexp_replace("tag", "^refs/tags/", ""), "^v", "")
    stable = tags.withColumn("version", plain).where(F.col("version").rlike(r"^\d+(\.\d+)*$")).select(by, "version", release_key(F.col("version")).alias("order")).distinct()
    own = installed.withColumn("installed", F.regexp_replace("installed", r"\+.*$", "")).where(F.col("installed").rlike(r"^\d+(\.\d+)*$")).select(by, "installed", release_key(F.col("installed")).alias("own"))
    both = stable.join(own, by, "left")
    pick = lambda f, cond, name: both.where(cond).groupBy(by).agg(f(F.struct("order", "version"))["version"].alias("version")).select(by, F.lit(name).alias("strategy"), "version")
    listed = own.select(by, F.lit("installed").alias("strategy"), F.col("installed").alias("version"))
    for f, cond, name in ((F.max, F.lit(True), "latest"), (F.max, F.col("order") < F.col("own"), "lower"), (F.min, F.col("order") > F.col("own"), "higher")):
        listed = listed.unionByName(pick(f, cond, name))
    return listed


def page_of_chunks(chunks: DataFrame, by: str, order: list[str], cursor: int, limit: int) -> DataFrame:
    """The chunks of one page of each document, in order, with the cursor of the next page (null at the end)."""
    window = Window.partitionBy(by)
    placed = chunks.withColumns({"place": F.row_number().over(window.orderBy(*order)), "n": F.count(F.lit(1)).over(window)})
    page = placed.where((F.col("place") > cursor) & (F.col("place") <= cursor + limit))
    return page.withColumn("next_cursor", F.when(F.col("n") > cursor + limit, F.lit(cursor + limit))).drop("n")


def allowed_types(requested: Column, configured: Column) -> list[Column]:
    """(selected, refused): the requested types within those that are configured; all if none are. An empty choice is refused."""
    none = F.coalesce(F.size(configured), F.lit(0)) == 0
    selected = F.when(none, requested).otherwise(F.filter(requested, lambda t: F.array_contains(configured, t)))
    return [selected.alias("selected"), ((F.size(requested) > 0) & (F.size(selected) == 0)).alias("refused")]


def selected_documents(documents: DataFrame, key: str, ids: DataFrame, names: DataFrame) -> DataFrame:
    """The keys, once each and sorted, that are asked for by id or by one of their collections. documents: (key, collections array)."""
    by_id = documents.select(key).join(ids, key, "left_semi")
    listed = documents.select(key, F.explode("collections").alias("name")).join(names, "name", "left_semi").select(key)
    return by_id.union(listed).distinct().orderBy(key)


def status_counts(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: documents, pipeline_chunks and active_pipeline_chunks. chunks has a boolean ``active``."""
    own = documents.agg(F.count(F.lit(1)).alias("documents"))
    return own.join(chunks.agg(F.count(F.lit(1)).alias("pipeline_chunks"), F.count_if("active").alias("active_pipeline_chunks")), F.lit(True))  # one row each


def throughput(rows: DataFrame, by: str, seconds: str, counts: list[str]) -> DataFrame:
    """(by, count_per_second...): sums over summed seconds, which count as a nanosecond at least."""
    duration = F.greatest(F.sum(seconds), F.lit(1e-9))
    return rows.groupBy(by).agg(*(F.round(F.sum(c) / duration, 6).alias(f"{c}_per_second") for c in counts))


#: What each task reads: lists of a project, and which of their records.
TASKS = {
    "project_overview": {"recent_experiments": "true", "active_decisions": "status = 'accepted'", "known_failures": "status <> 'resolved'"},
    "code_debugging": {"recent_experiments": "true", "known_failures": "of_experiment"},
    "experiment_analysis": {"recent_experiments": "true", "known_failures": "of_experiment", "active_decisions": "true"},
    "decision_review": {"recent_experiments": "true", "active_decisions": "true", "claims": "true"},
    "paper_writing": {"recent_experiments": "true", "active_decisions": "true", "claims": "true", "known_failures": "true"},
}


def task_context(records: DataFrame, by: str) -> DataFrame:
    """(task, by, list, record_id): the records that each task reads. records: (by, list, record_id, status, experiment_id)."""
    runs = records.where("list = 'recent_experiments'").select(by, F.col("record_id").alias("experiment_id"), F.lit(True).alias("of_experiment")).distinct()
    known = records.join(runs, [by, "experiment_id"], "left").withColumn("of_experiment", F.coalesce("of_experiment", F.lit(False)))
    rules = F.array(*(F.struct(F.lit(task).alias("task"), F.col("list").eqNullSafe(F.lit(name)) & F.coalesce(F.expr(rule), F.lit(False))) for task, lists in TASKS.items() for name, rule in lists.items()))
    return known.select(by, "list", "record_id", F.explode(F.filter(rules, lambda r: r["col2"])).alias("r")).select("r.task", by, "list", "record_id")
