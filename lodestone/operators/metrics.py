"""Aggregations: retrieval metrics, gates, distributions, profiles, feedback audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ranking_metrics(samples: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """One row: recall_at_k and mrr over all samples. samples: (query_id, expected); hits: (query_id, rank, found)."""
    own = hits.where(F.col("rank") <= k).join(samples, "query_id").where(F.col("found") == F.col("expected"))
    first = own.groupBy("query_id").agg(F.min("rank").alias("first"))
    n = F.greatest(F.lit(1), F.count(F.lit(1)))
    return samples.select("query_id").join(first, "query_id", "left").agg((F.count("first") / n).alias("recall_at_k"), (F.coalesce(F.sum(1 / F.col("first")), F.lit(0.0)) / n).alias("mrr"))


def classification_metrics(rows: DataFrame, group: str, expected: str, predicted: str) -> DataFrame:
    """(group, n, accuracy) over rows with an expectation."""
    return rows.where(F.col(expected).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(predicted).eqNullSafe(F.col(expected))).cast("double")).alias("accuracy"))


def latency(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, n, mean, p95): p95 is the nearest rank."""
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY {value})").alias("p95"))


def histogram(rows: DataFrame, field: Column) -> DataFrame:
    """(value, n); missing values count as unknown."""
    return rows.groupBy(F.coalesce(field.cast("string"), F.lit("unknown")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def distribution(rows: DataFrame, field: str) -> DataFrame:
    return rows.agg(F.count(field).alias("n"), F.min(field).alias("least"), F.avg(field).alias("mean"), F.max(field).alias("most"))


def gate(thresholds: DataFrame, baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """(group, metric, passed, reasons). thresholds: (group, metric, low, high, max_drop); a missing candidate fails."""
    key = ["group", "metric"]
    both = thresholds.join(baseline.select(*key, F.col("value").alias("base")), key, "left").join(candidate.select(*key, F.col("value").alias("cand")), key, "left")
    cand = F.col("cand")
    reasons = F.array_compact(
        F.array(
            F.when(cand.isNull(), "missing_candidate"),
            F.when(cand < F.col("low"), "below_minimum"),
            F.when(cand > F.col("high"), "above_maximum"),
            F.when(F.col("base") - cand > F.col("max_drop"), "regression"),
        )
    )
    return both.select(*key, (F.size(reasons) == 0).alias("passed"), F.array_join(reasons, ",").alias("reasons"))


def profile(entries: DataFrame, by: str, words: str, flags: dict[str, Column]) -> DataFrame:
    """(by, n, mean_words, median_words, one rate for each flag)."""
    return entries.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.avg(words).alias("mean_words"), F.median(words).alias("median_words"), *(F.avg(c.cast("double")).alias(name) for name, c in flags.items()))


def top_terms(entries: DataFrame, by: str, terms: Column, k: int) -> DataFrame:
    """(by, term, n, rank): the most frequent terms, ties by term."""
    from lodestone.operators.retrieval import ranked

    counted = entries.select(by, F.explode(terms).alias("term")).groupBy(by, "term").agg(F.count(F.lit(1)).alias("n"))
    return ranked(counted, k, [by], F.desc("n"), F.col("term"))


def event_audit(events: DataFrame, known: DataFrame, target: str, label: str, allowed: list[str]) -> DataFrame:
    """(status, n): malformed labels, targets that aren't known, valid events."""
    marked = events.join(known.select(F.col(known.columns[0]).alias(target), F.lit(True).alias("known")).distinct(), target, "left")
    status = F.when(~F.coalesce(F.col(label).isin(allowed), F.lit(False)), "malformed").when(F.col("known").isNull(), "orphan").otherwise("valid")
    return marked.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def comparable(runs: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """(group, comparable): at most one distinct value of each field among completed runs."""
    return runs.groupBy(group).agg(F.every(F.lit(True)).alias("_"), *(F.countDistinct(f).alias(f"n_{f}") for f in fields)).select(group, *(F.col(f"n_{f}") for f in fields), F.forall(F.array(*(F.col(f"n_{f}") for f in fields)), lambda n: n <= 1).alias("comparable"))


def _rate(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, F.round(numerator / denominator, 6)).otherwise(0.0)


def code_metrics(samples: DataFrame, hits: DataFrame, group: str, k: int) -> DataFrame:
    """One row a group. samples: (query_id, group, source, version, symbol, seconds), where null means not expected; hits: (query_id, rank, source, version, symbol, traceable,
    inferred). Versions and symbols count where they are expected, unsupported inferences among all hits; p95 is the nearest rank."""
    top = hits.where(F.col("rank") <= k).select("query_id", "rank", *(F.col(c).alias("h_" + c) for c in ("source", "version", "symbol")), "traceable", "inferred")
    both = samples.join(top, "query_id", "left")
    same = lambda c: F.coalesce(F.col(c) == F.col("h_" + c), F.lit(False))
    first = F.min(F.when(same("source"), F.struct("rank", "traceable")))
    each = both.groupBy("query_id", group, "version", "symbol", "seconds").agg(
        first.alias("first"), F.bool_or(same("version")).alias("v"), F.bool_or(same("symbol")).alias("s"), F.count("rank").alias("hits"), F.count_if(F.col("inferred") & ~F.col("traceable")).alias("unsupported")
    )
    n = F.count(F.lit(1))
    return each.groupBy(group).agg(
        _rate(F.count("first"), n).alias("recall_at_k"),
        _rate(F.sum(1 / F.col("first.rank")), n).alias("mrr"),
        _rate(F.count_if(F.col("first.rank") == 1), n).alias("source_type_accuracy"),
        _rate(F.count_if("v"), F.count("version")).alias("version_recall"),
        _rate(F.count_if("s"), F.count("symbol")).alias("symbol_recall"),
        _rate(F.count_if("first.traceable"), n).alias("evidence_completeness"),
        _rate(F.sum("unsupported"), F.sum("hits")).alias("unsupported_rate"),
        F.round(F.avg("seconds"), 6).alias("mean_seconds"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY seconds)").alias("p95_seconds"),
    )


def writing_metrics(rows: DataFrame, group: str) -> DataFrame:
    """One row a group of judged predictions (function, expected_function, section, expected_section, traceable, domain, expected_domain, risk, expected_risk, material_id): accuracies where
    something is expected, the share of repeated materials and of domains that weren't expected, and risk as low or not low."""
    known = lambda c: F.count(f"expected_{c}")
    right = lambda c: F.count_if(F.col(c).eqNullSafe(F.col(f"expected_{c}")) & F.col(f"expected_{c}").isNotNull())
    low = F.coalesce("risk", F.lit("low")) == "low"
    return rows.groupBy(group).agg(
        _rate(right("function"), known("function")).alias("function_accuracy"),
        _rate(right("section"), known("section")).alias("section_accuracy"),
        _rate(F.count_if("traceable"), F.count(F.lit(1))).alias("traceability"),
        _rate(F.count("material_id") - F.countDistinct("material_id"), F.count("material_id")).alias("duplicate_ratio"),
        _rate(F.count_if(F.col("domain") != F.col("expected_domain")), F.count("domain")).alias("wrong_domain_rate"),
        _rate(F.count_if((F.col("expected_risk") == "low") == low), known("risk")).alias("risk_detection"),
    )


def gate_rates(events: DataFrame, group: str) -> DataFrame:
    """(group, document_failure, span_rejection, provider_failure) of events (kind, ok, code): failures among documents, rejections among candidates by an exact span, and provider calls
    whose code starts with provider_."""
    rate = lambda kind, bad: _rate(F.count_if((F.col("kind") == kind) & bad), F.count_if(F.col("kind") == kind))
    return events.groupBy(group).agg(
        rate("document", ~F.col("ok")).alias("document_failure"),
        rate("candidate", F.coalesce(F.col("code") == "exact_span", F.lit(False))).alias("span_rejection"),
        rate("call", F.coalesce(F.col("code").startswith("provider_"), F.lit(False))).alias("provider_failure"),
    )


def endpoint_stats(batches: DataFrame, endpoint: str, texts: str, seconds: str) -> DataFrame:
    """(endpoint, batches, texts, seconds, p95)."""
    return batches.groupBy(endpoint).agg(F.count(F.lit(1)).alias("batches"), F.sum(texts).alias("texts"), F.round(F.sum(seconds), 6).alias("seconds"), F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY {seconds})").alias("p95"))


def run_summary(rows: DataFrame, worker: str) -> DataFrame:
    """(worker, parsed, failed, chunks, tokens, pages, parse_p95) of documents (ok, chunks, tokens, pages, seconds)."""
    total = lambda c: F.coalesce(F.sum(F.when(F.col("ok"), F.col(c))), F.lit(0)).alias(c)
    return rows.groupBy(worker).agg(F.count_if("ok").alias("parsed"), F.count_if(~F.col("ok")).alias("failed"), total("chunks"), total("tokens"), total("pages"), F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY seconds)").alias("parse_p95"))


def review_status(rows: DataFrame, group: str, status: str, finals: list[str]) -> DataFrame:
    """(group, n, final, complete): records, those with a final status, and whether all have one."""
    final = F.coalesce(F.col(status).isin(finals), F.lit(False))
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(final).alias("final"), F.every(final).alias("complete"))


def candidate_metrics(samples: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """One row: recall and reciprocal rank of the expected materials, the share of hits whose source is known, and of hits that repeat a material. samples: (query_id, expected); hits:
    (query_id, rank, material, joined)."""
    top = hits.where(F.col("rank") <= k)
    found = ranking_metrics(samples, top.withColumnRenamed("material", "found"), k)
    distinct = top.select("query_id", "material").distinct().agg(F.count(F.lit(1)).alias("m"))
    told = top.agg(F.count(F.lit(1)).alias("n"), F.count_if("joined").alias("j"))
    n = F.greatest(F.lit(1), F.col("n"))
    return found.join(told, F.lit(True)).join(distinct, F.lit(True)).select("recall_at_k", "mrr", (F.col("j") / n).alias("source_join"), ((F.col("n") - F.col("m")) / n).alias("duplicates"))  # one row each
