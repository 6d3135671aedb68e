"""Requests packed by two limits at once: paragraphs and sentences."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.rows import rowwise


def slices(sentences: list[int], most_paragraphs: int, most_sentences: int) -> Iterator[tuple[int, int, int, int]]:
    """(batch, paragraph, first sentence, sentences): each paragraph in slices of at most ``most_sentences``; a slice that would exceed a limit, or whose paragraph
    the batch already holds, begins a new batch. Paragraphs without sentences are in none."""
    batch, held, n, last = 0, 0, 0, None
    for i, size in enumerate(sentences):
        for begin in range(0, size or 0, most_sentences):
            own = min(most_sentences, size - begin)
            if held and (held >= most_paragraphs or n + own > most_sentences or last == i):
                batch, held, n = batch + 1, 0, 0
            yield batch, i, begin, own
            held, n, last = held + 1, n + own, i


def batched(paragraphs: DataFrame, by: str, order: str, sentences: str, most_paragraphs: int, most_sentences: int) -> DataFrame:
    """(by, batch, order, first_sentence, sentences): the slices of each document's paragraphs and the request that each goes to. paragraphs: (by, order,
    sentences), orders unique in a document."""
    if most_paragraphs <= 0 or most_sentences <= 0:
        raise ValueError("limits must be positive")
    listed = paragraphs.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(sentences).alias("n")))).alias("ps"))
    flat = rowwise(lambda n: [x for s in slices(n or [], most_paragraphs, most_sentences) for x in s], "array<int>")(F.transform("ps", lambda p: p["n"].cast("int")))
    rows = listed.select(by, "ps", flat.alias("f"))
    rows = rows.select(by, "ps", "f", F.explode(F.filter(F.sequence(F.lit(0), F.greatest(F.size("f") - 1, F.lit(0)), F.lit(4)), lambda i: i < F.size("f"))).alias("i"))
    at = lambda j: F.get("f", F.col("i") + j)
    return rows.select(by, at(0).alias("batch"), F.get("ps", at(1))["o"].alias(order), at(2).alias("first_sentence"), at(3).alias("sentences"))
