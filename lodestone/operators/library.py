"""Normal metadata, profiles, queues, dates, provenance and the last checks before a release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import text
from lodestone.functions.hashing import normal_doi, year_of
from lodestone.operators import metrics

#: What must hold before a pilot is expanded, and what to do where it doesn't; the first rule that applies counts.
RECOMMENDATIONS = (
    (("selection_size", "extraction", "source_join", "exact_span", "provider_structure"), "stop_and_fix_extraction_contract"),
    (("complete_review",), "complete_all_review_decisions"),
    (("isolated_candidate",), "build_or_fix_isolated_candidate"),
    (("retrieval_quality",), "run_or_fix_candidate_retrieval_evaluation"),
)
EXPAND = "eligible_for_manual_expansion_decision"


def normal_metadata(title: Column, date: Column, year: Column, doi: Column, tags: Column) -> list[Column]:
    """Texts with single blanks or null, the year given or that of the date, DOIs in small letters, tags sorted and distinct."""
    clean = lambda c: F.nullif(text.collapsed(c), F.lit(""))
    return [
        clean(title).alias("title"),
        clean(date).alias("date"),
        F.coalesce(clean(year), year_of(clean(date)).cast("string")).alias("year"),
        normal_doi(clean(doi)).alias("doi"),
        F.array_sort(F.array_distinct(F.filter(F.transform(tags, clean), lambda t: t.isNotNull()))).alias("tags"),
    ]


def profile_entries(entries: DataFrame, papers: DataFrame, sections: list[str], least: int = 20) -> tuple[DataFrame, DataFrame]:
    """The entries (paper, section, text) of chosen papers (paper) and families of sections, of at least so many words, and the papers that have none at all."""
    own = entries.join(papers, "paper", "left_semi")
    missing = papers.select("paper").distinct().join(entries, "paper", "left_anti")
    long = F.size(text.lexical_tokens(F.col("text"))) >= least
    if sections:
        families = [text.section_family(F.lit(s)) for s in sections]
        long &= F.array_contains(F.array(*families), text.section_family(F.col("section")))
    return own.where(long), missing


def writing_profile(entries: DataFrame, by: str) -> DataFrame:
    """(by, n, mean_words, median_words, papers, questions) of entries (paper, text)."""
    words = entries.withColumn("words", F.size(text.lexical_tokens(F.col("text"))))
    papers = words.groupBy(by).agg(F.countDistinct("paper").alias("papers"))
    return metrics.profile(words, by, "words", {"questions": F.col("text").contains("?")}).join(papers, by)


def recovered_queue(queue: DataFrame, now: Column, seconds: int, wanted: DataFrame) -> DataFrame:
    """The queue (task, status, started) after running tasks that began too long ago failed, and wanted ones (task) that aren't pending or running were added again."""
    stale = (F.col("status") == "running") & (F.col("started").isNull() | (F.col("started") < now - F.make_interval(secs=F.lit(seconds))))
    after = queue.withColumn("status", F.when(stale, "failed").otherwise(F.col("status")))
    own = wanted.select("task").distinct().withColumn("_wanted", F.lit(True))
    both = after.join(own, "task", "full")
    busy = F.coalesce(F.col("status").isin("pending", "running"), F.lit(False))
    return both.select("task", F.when(F.col("_wanted") & ~busy, "pending").otherwise(F.col("status")).alias("status"))


def seconds_until(value: Column, now: Column) -> Column:
    """What a Retry-After header says: seconds, or a date of the form "Wed, 21 Oct 2015 07:28:00 GMT"; null for anything else, never below 0."""
    plain = F.when(value.rlike(r"^\s*\d+(?:\.\d+)?\s*$"), F.trim(value).cast("double"))
    date = F.try_to_timestamp(F.regexp_extract(value, r"^\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.coalesce(plain, F.when(date.isNotNull(), F.greatest(F.lit(0.0), (F.unix_micros(date) - F.unix_micros(now)) / 1e6)))


def stable_updated_at(*times: Column) -> Column:
    """The latest of the times that are known; none if none is."""
    return F.array_max(F.filter(F.array(*times), lambda t: t.isNotNull() & (t != "")))


def unknown_ids(asked: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """(key, code): ids that no document has, and those of another form."""
    found = asked.join(documents.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    code = F.when(F.col(key).isNull() | ~F.col(key).startswith("zotero:"), "invalid_document_id").when(F.col("_known").isNull(), "unknown_document")
    return found.select(key, code.alias("code")).where("code IS NOT NULL")


def source_join_findings(payloads: DataFrame, assets: DataFrame, evidence: DataFrame) -> DataFrame:
    """(asset_id, error) of retrieved payloads (asset_id, category, score) against accepted assets (asset_id, category, score, evidence_ids) and their evidence (evidence_id)."""
    known = assets.select("asset_id", F.col("category").alias("_category"), F.col("score").alias("_score"), "evidence_ids")
    both = payloads.join(known.withColumn("_known", F.lit(True)), "asset_id", "left")
    found = lambda rows, error: rows.select("asset_id", F.lit(error).alias("error"))
    listed = both.where("_known").select("asset_id", F.explode("evidence_ids").alias("evidence_id"))
    parts = found(both.where("_known IS NULL"), "unknown_accepted_asset").unionAll(found(listed.join(evidence, "evidence_id", "left_anti"), "accepted_evidence_missing"))
    for c in ("category", "score"):
        parts = parts.unionAll(found(both.where(F.col("_known") & ~F.col(c).eqNullSafe(F.col("_" + c))), f"{c}_mismatch"))
    return parts


def chunk_provenance(items: DataFrame, document: str) -> DataFrame:
    """(document, chunk, first_page, last_page, section, refs) of a chunk's items (document, chunk, place, page, headings array, ref): the span of its known pages, the path of its first item's headings, and references,
    once each, in order."""
    refs = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("place", "ref"))), lambda x: x["ref"]))
    section = F.array_join(F.min_by("headings", "place"), " > ")
    return items.groupBy(document, "chunk").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), section.alias("section"), refs.alias("refs"))


def audit_sets(flagged: DataFrame, acknowledged: DataFrame, reviewed: DataFrame) -> DataFrame:
    """(asset_id, state): flagged assets that are acknowledged, reviewed without that, or unreviewed; and acknowledgements of assets that nothing flags. All: (asset_id)."""
    mark = lambda df, name: df.select("asset_id").distinct().withColumn(name, F.lit(True))
    both = mark(flagged, "f").join(mark(acknowledged, "a"), "asset_id", "full").join(mark(reviewed, "r"), "asset_id", "left")
    state = F.when(F.col("f").isNull(), "stale_acknowledgement").when(F.col("a"), "acknowledged").when(F.col("r"), "reviewed").otherwise("unreviewed")
    return both.select("asset_id", state.alias("state"))


def recommendation(gates: DataFrame, by: str) -> DataFrame:
    """(by, recommendation) of gates in boolean columns; a missing one does not hold."""
    rule = F.lit(None).cast("string")
    for names, advice in reversed(RECOMMENDATIONS):
        holds = F.lit(True)
        for name in names:
            holds &= F.coalesce(F.col(name), F.lit(False))
        rule = F.when(~holds, advice).otherwise(rule)
    return gates.select(by, F.coalesce(rule, F.lit(EXPAND)).alias("recommendation"))


def adaptation_findings(changes: DataFrame, evidence: DataFrame, verifications: DataFrame) -> DataFrame:
    """(code, key) of an adaptation's changes (change_id, evidence_ids), evidence (evidence_id) and verifications (verification_id, change_id, status, exit_code): repeated ids, references to nothing, statuses
    that the exit code belies."""
    found = lambda rows, code, key: rows.select(F.lit(code).alias("code"), F.col(key).cast("string").alias("key"))
    again = lambda df, key: df.groupBy(key).count().where("count > 1")
    listed = changes.select("change_id", F.explode("evidence_ids").alias("evidence_id"))
    parts = found(again(changes, "change_id"), "duplicate_change", "change_id").unionAll(found(again(evidence, "evidence_id"), "duplicate_evidence", "evidence_id"))
    parts = parts.unionAll(found(listed.join(evidence, "evidence_id", "left_anti"), "unknown_evidence", "change_id"))
    parts = parts.unionAll(found(verifications.join(changes, "change_id", "left_anti"), "unknown_change", "verification_id"))
    return parts.unionAll(found(verifications.where((F.col("status") == "passed") != (F.col("exit_code") == 0)), "status_belies_exit_code", "verification_id"))


def distinct_segments(segments: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Segments whose text, but for white space, case and marks, no earlier one of their group has."""
    normal = F.regexp_replace(F.lower(F.col(value)), r"(?U)[^\w]+", " ")
    window = Window.partitionBy(by, "_normal").orderBy(order)
    return segments.withColumn("_normal", F.trim(normal)).withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_normal", "_nth")


def resolve_reference(documents: DataFrame, citations: DataFrame | None = None, most: int = 50, **asked: str) -> DataFrame:
    """The documents (document_id, title, doi, item_key, attachment_key) that one criterion names, by title and id, ``most`` at most: doi (whatever its case), item_key, attachment_key, title
    (a part, whatever its case) or citation_key (of citations (item_key, payload JSON))."""
    from lodestone.functions.features import citation_key

    given = {name: value for name, value in asked.items() if value}
    if len(given) != 1 or not given.keys() <= {"doi", "item_key", "attachment_key", "title", "citation_key"}:
        raise ValueError("exactly one criterion is needed")
    (name, value), = given.items()
    if name == "citation_key":
        found = documents.join(citations.where(citation_key(F.col("payload")) == value.lower()).select("item_key").distinct(), "item_key", "left_semi")
    elif name == "title":
        found = documents.where(F.lower("title").contains(value.lower()))
    else:
        found = documents.where(F.lower(name) == value.lower() if name == "doi" else F.col(name) == value)
    return found.orderBy("title", "document_id").limit(most)


def ready_chunks(chunks: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Active chunks (key, active, ...) of documents (key, status) that are ready."""
    return chunks.where("active").join(documents.where("status = 'ready'").select(key), key, "left_semi")


def same_records(old: DataFrame, new: DataFrame, place: str, record: str) -> DataFrame:
    """One row, changed: whether two ordered lists of records (place, record) differ anywhere, in length, order or content."""
    both = old.select(place, F.col(record).alias("_old")).join(new.select(place, F.col(record).alias("_new")), place, "full")
    return both.agg(F.coalesce(F.bool_or(~F.col("_old").eqNullSafe(F.col("_new"))), F.lit(False)).alias("changed"))
