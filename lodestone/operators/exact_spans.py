"""The gate between proposals and evidence: a proposal names sentences or quotes a text, and becomes evidence only if it is one exact span of its paragraph
that places cover whole. Every proposal comes back, with the first reason that refuses it or with its evidence.

Paragraphs are those of ``reconstruct``: (paragraph_id, document_id, parse_fingerprint, family, text, text_hash, segments), ids unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import code, hashing, text

#: The taxonomy's version in identities, and the quality that evidence needs.
TAXONOMY_VERSION, LEAST_QUALITY = "writing-taxonomy-v1", 0.65


def _sentence_id(paragraph: Column, n: Column, begin: Column, end: Column, said: Column) -> Column:
    return F.concat(F.lit("sentence:"), hashing.sha256(hashing.canonical_json(paragraph=paragraph, index=n, start=begin, end=end, text=hashing.sha256(said))))


def sentences(paragraphs: DataFrame) -> DataFrame:
    """(paragraph_id, sentence_id, n, begin, end) of paragraphs (paragraph_id, text)."""
    rows = code.sentence_spans(paragraphs, "paragraph_id", "text", said=True)
    return rows.select("paragraph_id", _sentence_id(*map(F.col, ("paragraph_id", "n", "begin", "end", "said"))).alias("sentence_id"), "n", "begin", "end")


def selected(proposals: DataFrame, known: DataFrame) -> DataFrame:
    """(proposal_id, begin, end, error) of proposals (proposal_id, paragraph_id, sentence_ids): the span from the first named sentence to the last one. known:
    ``sentences``. Sentences must be the paragraph's, in its order and without a gap."""
    asked = proposals.select("proposal_id", "paragraph_id", F.posexplode_outer("sentence_ids").alias("place", "sentence_id"))
    both = asked.join(known, ["paragraph_id", "sentence_id"], "left")
    rows = both.groupBy("proposal_id").agg(F.count("place").alias("asked"), F.count("n").alias("found"), F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("place", "n", "begin", "end")))).alias("s"))
    straight = F.forall(F.sequence(F.lit(1), F.greatest(F.size("s") - 1, F.lit(1))), lambda i: F.coalesce(F.get("s", i)["n"] == F.get("s", i - 1)["n"] + 1, F.lit(True)))
    error = F.when(F.col("asked") == 0, "no sentence").when(F.col("found") < F.col("asked"), "sentence not in paragraph").when(~straight, "sentences not contiguous")
    return rows.select("proposal_id", F.when(error.isNull(), F.get("s", F.lit(0))["begin"]).alias("begin"), F.when(error.isNull(), F.element_at("s", -1)["end"]).alias("end"), error.alias("error"))


def quoted(proposals: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(proposal_id, begin, end, error) of proposals (proposal_id, paragraph_id, original_text): where the quoted text stands in its paragraph. One that
    stands there twice, even overlapping itself, is ambiguous; of spans that overlap in a paragraph the first stays, longer ones first, ties by id."""
    rows = proposals.join(paragraphs.select("paragraph_id", "text"), "paragraph_id", "left")
    said = F.col("original_text")
    rows = rows.withColumn("at", F.when(F.coalesce(said, F.lit("")) != "", F.expr("locate(original_text, text)")))
    error = F.when(F.col("text").isNull(), "unknown paragraph").when(F.coalesce(said, F.lit("")) == "", "no text").when(F.col("at") == 0, "text not in paragraph").when(F.expr("locate(original_text, text, at + 1)") > 0, "text stands twice")
    rows = rows.select("proposal_id", "paragraph_id", error.alias("error"), F.when(error.isNull(), F.col("at") - 1).alias("begin"), F.when(error.isNull(), F.col("at") - 1 + F.length(said)).alias("end"))
    before = Window.partitionBy("paragraph_id", F.col("error").isNull()).orderBy("begin", F.desc("end"), "proposal_id").rowsBetween(Window.unboundedPreceding, -1)
    overlaps = F.col("error").isNull() & F.coalesce(F.max("end").over(before) > F.col("begin"), F.lit(False))
    rows = rows.withColumn("overlaps", overlaps)
    kept = lambda c: F.when(~F.col("overlaps"), F.col(c)).alias(c)
    return rows.select("proposal_id", kept("begin"), kept("end"), F.when(F.col("overlaps"), "overlaps an earlier span").otherwise(F.col("error")).alias("error"))


def evidence(proposals: DataFrame, spans: DataFrame, paragraphs: DataFrame, known: DataFrame) -> DataFrame:
    """Every proposal (proposal_id, paragraph_id, category, claim_strength, risk_flags, confidence) with ``error`` or with its evidence: evidence_id, char_start,
    char_end, original_text, page_start, page_end, source_spans, sentence_ids, language, risk_flags, risk_flag_sources, quality_score, validation_status.
    spans: ``selected`` or ``quoted``; known: ``sentences``, or ``code.sentence_spans`` of the paragraphs, so that only sentences of evidence get their ids."""
    rows = proposals.withColumnRenamed("risk_flags", "told_flags").join(spans, "proposal_id", "left").join(paragraphs, "paragraph_id", "left")
    begin, end = F.col("begin"), F.col("end")
    inside = F.filter("segments", lambda s: (s["begin"] < end) & (s["end"] > begin))

    def part(s: Column) -> Column:
        low, high = F.greatest(s["begin"], begin), F.least(s["end"], end)
        return F.struct(s["self_ref"].alias("self_ref"), low.alias("source_start"), high.alias("source_end"), low.alias("paragraph_start"), high.alias("paragraph_end"), s["page_no"].alias("page_no"), s["bbox"].alias("bbox"))

    rows = rows.withColumn("source_spans", F.transform(inside, part))
    covered = F.aggregate("source_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["paragraph_end"] - s["paragraph_start"])
    error = (
        F.when(F.col("text").isNull(), "unknown paragraph")
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(begin.isNull() | (begin < 0) | (end <= begin) | (end > F.length("text")), "span outside paragraph")
        .when(hashing.sha256(F.col("text")) != F.col("text_hash"), "paragraph changed")
        .when(F.size("source_spans") == 0, "no place")
        .when(covered != end - begin, "not covered by places")
    )
    rows = rows.withColumn("error", error).withColumn("original_text", F.when(F.col("error").isNull(), F.expr("substring(text, begin + 1, end - begin)")))
    # a paragraph's sentences meet its proposals as one array, where its text lies
    listed = known.groupBy("paragraph_id").agg(F.array_sort(F.collect_list(F.struct("n", *(c for c in known.columns if c not in ("paragraph_id", "n"))))).alias("ss"))
    met = F.filter("ss", lambda s: (s["begin"] < end) & (s["end"] > begin))
    rows = rows.join(listed, "paragraph_id", "left").withColumn("ss", F.when(F.col("error").isNull(), met))
    rows = rows.withColumn("error", F.when(F.col("error").isNull() & F.coalesce(F.size("ss") <= 0, F.lit(True)), "no sentence").otherwise(F.col("error")))
    told = F.coalesce("told_flags", F.array().cast("array<string>"))
    rows = rows.withColumn("risk_flags", F.array_sort(F.array_distinct(F.concat(told, text.risk_flags(F.col("original_text"), F.col("category"))))))
    sources = F.map_from_arrays("risk_flags", F.transform("risk_flags", lambda f: F.when(F.array_contains(told, f), "model_assessment").otherwise("deterministic_heuristic")))
    quality = text.material_quality(F.col("original_text"), F.col("category"), F.col("family"), F.col("confidence"), F.col("risk_flags"))
    rows = rows.withColumn("quality_score", quality)
    identity = hashing.canonical_json(document_id=F.col("document_id"), parse_fingerprint=F.col("parse_fingerprint"), paragraph_id=F.col("paragraph_id"), start=begin, end=end, text_hash=hashing.sha256(F.col("original_text")), category=F.col("category"), taxonomy=F.lit(TAXONOMY_VERSION))

    def sentence_id(s: Column) -> Column:
        return s["sentence_id"] if "sentence_id" in known.columns else _sentence_id(F.col("paragraph_id"), s["n"], s["begin"], s["end"], F.substring(F.col("text"), s["begin"] + 1, s["end"] - s["begin"]))

    pages = F.transform("source_spans", lambda s: s["page_no"])
    good = lambda c, name: F.when(F.col("error").isNull(), c).alias(name)
    return rows.select(
        "proposal_id",
        "error",
        good(F.concat(F.lit("evidence:"), hashing.sha256(identity)), "evidence_id"),
        good(F.col("paragraph_id"), "paragraph_id"),
        good(begin, "char_start"),
        good(end, "char_end"),
        good(F.col("original_text"), "original_text"),
        good(F.array_min(pages), "page_start"),
        good(F.array_max(pages), "page_end"),
        good(F.col("source_spans"), "source_spans"),
        good(F.transform("ss", sentence_id), "sentence_ids"),
        good(text.language(F.col("original_text")), "language"),
        good(F.col("risk_flags"), "risk_flags"),
        good(sources, "risk_flag_sources"),
        good(F.col("quality_score"), "quality_score"),
        good(F.when(F.col("quality_score") >= LEAST_QUALITY, "validated").otherwise("rejected_candidate"), "validation_status"),
    )
