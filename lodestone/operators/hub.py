"""The routes of a search through its three corpora: what is demoted, put first or left out, and the hits' neighbours."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import features, text
from lodestone.operators import retrieval
from lodestone.plans import evidence


def _rank(value: Column, names: Column) -> Column:
    place = F.array_position(names, value)
    return F.when(F.coalesce(place, F.lit(0)) > 0, place - 1).otherwise(99)


def _ordered(hits: DataFrame, top: int, *order: Column) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(*order, F.col("rank"))
    return hits.withColumn("new_rank", F.row_number().over(by)).where(F.col("new_rank") <= top)


def literature(hits: DataFrame, top: int) -> DataFrame:
    """Hits (query_id, query, rank, path): lists of references come last, unless the query asks for them."""
    asked = F.col("query").rlike("(?iU)" + features.BIBLIOGRAPHY_QUERY)
    return _ordered(hits, top, F.when(~asked & features.is_bibliography(F.col("path")), 1).otherwise(0))


def code(hits: DataFrame, top: int) -> DataFrame:
    """Hits (query_id, query, rank, score, role, source_type): by the evidence's role, then by where the query's intent looks first, then by score."""
    intents = F.create_map(*(x for name, kinds in features.SOURCE_PRIORITIES.items() for x in (F.lit(name), F.array(*map(F.lit, kinds)))))
    told = hits.withColumn("kinds", F.try_element_at(intents, text.code_intent(F.col("query"))))
    roles = F.array(*map(F.lit, features.EVIDENCE_ROLES))
    return _ordered(told, top, _rank(F.col("role"), roles), _rank(F.col("source_type"), F.col("kinds")), F.desc("score")).drop("kinds")


def writing(hits: DataFrame, adjustments: DataFrame, top: int, section: str | None = None, venue: str | None = None, domain: str | None = None) -> DataFrame:
    """Hits (query_id, rank, score, writing_id, section, venue, domains, title, text) that the filters leave, by score with the adjustments (target,
    adjustment) of feedback."""
    kept = F.lit(True)
    if section is not None:
        kept &= text.section_family(F.col("section")).eqNullSafe(text.section_family(F.lit(section)))
    if venue is not None:
        names = F.array(*map(F.lit, {venue.lower(), *(["nips"] if venue.lower() == "neurips" else [])}))
        kept &= F.array_contains(names, F.lower(F.coalesce("venue", F.lit("")))) | F.arrays_overlap(names, F.transform("domains", F.lower))
    if domain is not None:
        wanted = features.normal_domain(F.lit(domain))
        kept &= F.exists("domains", lambda d: features.normal_domain(d) == wanted) | F.array_contains(features.inferred_domains(F.col("title"), F.col("text")), wanted)
    scored = hits.where(kept).join(adjustments, F.col("writing_id") == F.col("target"), "left").drop("target")
    scored = scored.withColumn("score", F.round(F.col("score") + F.coalesce("adjustment", F.lit(0.0)), 9)).drop("adjustment")
    return _ordered(scored, top, F.desc("score"))


CORPORA, MODES = ("literature", "code", "writing"), ("dense", "sparse", "hybrid")


def legs(queries: DataFrame, points: DataFrame, tokens: Callable[[str], Column], mode: str, prefetch: int) -> DataFrame:
    """(query_id, point_id, score, rank) of the ``prefetch`` best points: by vectors, by words, or by both, each with as many, fused by their ranks. queries:
    (query_id, query, vec); points: (point_id, text, vec)."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    found = []
    if mode != "sparse":
        found.append(retrieval.dense(queries.select("query_id", F.col("vec").alias("query")), points.select("point_id", "vec"), prefetch))
    if mode != "dense":
        terms = queries.select("query_id", F.explode(tokens("query")).alias("term"))
        found.append(retrieval.sparse(terms, points.select("point_id", "text"), tokens("text"), prefetch))
    best = retrieval.hybrid(found, prefetch) if mode == "hybrid" else found[0]
    return best.select("query_id", "point_id", "score", "rank")


def search(queries: DataFrame, points: DataFrame, corpus: str, tokens: Callable[[str], Column], mode: str = "hybrid", top: int = 5, prefetch: int = 20, equal: dict[str, object] | None = None, adjustments: DataFrame | None = None, exact: DataFrame | None = None, **post: str | None) -> DataFrame:
    """The ``top`` hits of each query in one corpus, with the points' columns, score, rank (of the legs), new_rank and warnings.

    The corpus decides the route. Everywhere: the filters, then the legs, then the points' columns, then the corpus's order. Literature fetches more than it
    returns, unless the query asks for references, and puts lists of references last. Code puts first what its intent looks for first, and takes exact hits of a
    symbol index (``exact``: hits with the points' columns, score and query_id). Writing looks for the one asset type that a query names, if the filters name
    none, fetches more where it filters behind the search (``post``: section, venue, domain), and adds feedback.

    queries: (query_id, query, vec); points: (point_id, corpus, text, vec, ...) with what the route reads: path; source_type, role; writing_id, section,
    venue, domains, title, asset_type."""
    if corpus not in CORPORA:
        raise ValueError(f"unknown corpus {corpus}")
    if post and corpus != "writing":
        raise ValueError("only writing filters behind the search")
    own = points.where((F.col("corpus") == corpus) & retrieval.matches(equal))
    asked = queries.where(F.trim("query") != "").select("query_id", "query", "vec")
    asset = text.asset_intent(F.col("query")) if corpus == "writing" and not (equal or {}).get("asset_type") else F.lit(None).cast("string")
    asked = asked.withColumn("asset", asset)
    kinds = [r.asset for r in asked.select("asset").distinct().collect()] if corpus == "writing" else []  # those of ASSET_INTENTS, and none
    groups = [(asked.where(F.col("asset").eqNullSafe(F.lit(kind))), own.where(F.col("asset_type") == kind) if kind else own) for kind in kinds or [None]]
    most = max(top, prefetch)
    found = reduce(DataFrame.unionByName, (legs(q, p, tokens, mode, most) for q, p in groups))
    wide = F.lit(any(v is not None for v in post.values())) if corpus == "writing" else ~F.col("query").rlike("(?iU)" + features.BIBLIOGRAPHY_QUERY) if corpus == "literature" else F.lit(False)
    hits = found.join(asked.select("query_id", "query"), "query_id").where(F.col("rank") <= F.when(wide, most).otherwise(top)).join(own.drop("vec"), "point_id")
    none = F.array().cast("array<string>")
    if corpus == "literature":
        demoted = ~F.col("query").rlike("(?iU)" + features.BIBLIOGRAPHY_QUERY) & features.is_bibliography(F.col("path"))
        any_demoted = F.max(demoted).over(Window.partitionBy("query_id"))
        return literature(hits.withColumn("warnings", F.when(any_demoted, F.array(F.lit("bibliography_sections_demoted"))).otherwise(none)), top)
    hits = hits.withColumn("warnings", none)
    if corpus == "code":
        if exact is not None:
            first = exact.join(asked.select("query_id", "query"), "query_id").withColumns({"role": F.lit("exact_symbol_source"), "rank": F.lit(0), "warnings": none})
            hits = hits.unionByName(first.select(*hits.columns))
        return code(hits, top)
    if adjustments is None:
        adjustments = hits.select(F.col("writing_id").alias("target"), F.lit(0.0).alias("adjustment")).limit(0)
    return writing(hits, adjustments, top, **post)


def enveloped(hits: DataFrame, most_results: int, most_tokens: int, *fallbacks: str) -> DataFrame:
    """(query_id, rank, content, tokens, truncated): what a budget leaves of ``search``'s hits; content: their text, else the fallback columns."""
    told = hits.select("query_id", F.col("new_rank").alias("rank"), evidence.context(F.col("text"), *map(F.col, fallbacks)).alias("content"))
    return evidence.envelope(told, "query_id", most_results, most_tokens)


def with_neighbours(hits: DataFrame, chunks: DataFrame, before: int, after: int) -> DataFrame:
    """Hits (query_id, rank, document_id, chunk_index) with the indexes and texts of the chunks around them, in order. chunks: (document_id, chunk_index,
    text)."""
    near = hits.select("query_id", "rank", "document_id", F.explode(F.sequence(F.col("chunk_index") - before, F.col("chunk_index") + after)).alias("near"))
    found = near.join(chunks.withColumnRenamed("chunk_index", "near"), ["document_id", "near"])
    listed = found.groupBy("query_id", "rank").agg(F.array_sort(F.collect_list(F.struct("near", "text"))).alias("neighbours"))
    return hits.join(listed, ["query_id", "rank"], "left")


def pattern_first(hits: DataFrame, characters: int = 320) -> DataFrame:
    """Hits without their original and with a short excerpt."""
    return hits.drop("original").withColumn("source_excerpt", F.left("source_excerpt", F.lit(characters)))


def paragraph_structure(hits: DataFrame) -> DataFrame:
    """Hits without original and excerpt."""
    return hits.drop("original", "source_excerpt")


def without_issues(hits: DataFrame, allowed: bool, asked: bool = False) -> tuple[DataFrame, list[str]]:
    """Hits (source_type) and warnings: evidence from issues, pull requests and commits needs permission; to ask for it without is an error."""
    if allowed:
        return hits, []
    if asked:
        raise PermissionError("issues are not permitted as evidence")
    return hits.where(~F.col("source_type").isin("issue", "pull_request", "commit")), ["issue_evidence_filtered"]


def reranked(hits: DataFrame, score: str, limit: int) -> DataFrame:
    """The best hits by another score, ties by point."""
    by = Window.partitionBy("query_id").orderBy(F.desc(score), F.col("point_id"))
    return hits.withColumn("new_rank", F.row_number().over(by)).where(F.col("new_rank") <= limit)


def recent(runs: DataFrame, by: str, started: str, key: str, now: Column, days: int, limit: int) -> DataFrame:
    """The latest runs of each group within so many days."""
    kept = runs.where(F.col(started) >= now - F.make_interval(days=F.lit(days)))
    order = Window.partitionBy(by).orderBy(F.desc(started), F.col(key))
    return kept.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= limit).drop("nth")


def writing_hits(hits: DataFrame) -> DataFrame:
    """Hits (point_id, writing_id, domains, title, text) with an id, and with the domains that their texts suggest in ``inferred``."""
    told = features.inferred_domains(F.col("title"), F.col("text"))
    return hits.withColumn("writing_id", F.coalesce("writing_id", "point_id")).withColumn("inferred", F.array_except(told, F.col("domains")))


def refreshed(points: DataFrame, current: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Points with their document's current metadata; points of unknown documents keep theirs."""
    new = current.select(key, *(F.col(c).alias("_" + c) for c in columns), F.lit(True).alias("_known"))
    both = points.join(new, key, "left")
    return both.select(*(F.when(F.col("_known"), F.col("_" + c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in points.columns))


#: What a comparison of versions looks at.
COMPARED = ("version_diff", "migration_guide", "release_note", "api_documentation")


def version_comparison(hits: DataFrame, installed: str, target: str, top: int) -> DataFrame:
    """Hits (query_id, rank, score, source_type, version) on compatibility: of four kinds of sources, those of the target version first, then those of the installed one."""
    role = F.when(F.col("version") == target, "target_version_evidence").when(F.col("version") == installed, "current_version_evidence").otherwise("retrieved_evidence")
    return code(hits.where(F.col("source_type").isin(*COMPARED)).withColumns({"role": role, "query": F.lit("is the version compatible")}), top)
