"""Evidence envelopes and record budgets: bounded, ordered lists folded within their query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import token_estimate

#: Fixed value: the order in which lists of records get their share, and the one in which they lose it.
GIVEN = ["recent_experiments", "known_failures", "active_decisions", "claims"]
TAKEN = ["claims", "known_failures", "active_decisions", "recent_experiments"]


def context(text: Column, *fallbacks: Column) -> Column:
    """A hit's text, else its patterns, notes and excerpt, one a line."""
    trimmed = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    own = F.nullif(trimmed(F.coalesce(text, F.lit(""))), F.lit(""))
    listed = F.filter(F.array(*fallbacks), lambda v: v.isNotNull() & (v != ""))
    return F.coalesce(own, trimmed(F.array_join(F.transform(listed, trimmed), "\n")))


def cut(text: Column, tokens: Column) -> Column:
    """The longest start of a text whose estimate stays within a number of tokens, without white space at its end."""
    pieces = F.regexp_extract_all(text, F.lit(r"(?U)\s*(?:\w+|[^\w\s])"), 0)
    head = F.when(tokens > 0, F.array_join(F.slice(pieces, F.lit(1), F.greatest(tokens, F.lit(1)).cast("int")), "")).otherwise(F.lit(""))
    return F.regexp_replace(F.left(head, (tokens * 4).cast("int")), r"(?U)\s+$", "")


def envelope(hits: DataFrame, by: str, most_results: int, most_tokens: int) -> DataFrame:
    """(by, rank, content, tokens, truncated) of the hits (by, rank, content) that a budget of results and tokens leaves. A hit that exceeds
    what is left is cut to it; the first one that nothing remains of ends the list. Hits without content count as results only."""
    listed = hits.where(F.col("rank") <= most_results).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("rank", "content"))).alias("hits"))
    kind = "array<struct<rank:int,content:string,tokens:bigint,truncated:boolean>>"
    start = F.struct(F.lit(most_tokens).cast("bigint").alias("left"), F.array().cast(kind).alias("kept"), F.lit(False).alias("over"))

    def step(state: Column, hit: Column) -> Column:
        whole = token_estimate(hit["content"])
        truncated = whole > state["left"]
        content = F.when(truncated, cut(hit["content"], state["left"])).otherwise(hit["content"])
        tokens = F.when(content == "", F.lit(0).cast("bigint")).otherwise(token_estimate(content))
        skip = state["over"] | (F.coalesce(hit["content"], F.lit("")) == "")
        ends = ~skip & (tokens <= 0)
        row = F.struct(hit["rank"].cast("int").alias("rank"), content.alias("content"), tokens.alias("tokens"), truncated.alias("truncated"))
        kept = F.when(skip | ends, state["kept"]).otherwise(F.concat(state["kept"], F.array(row)))
        left = F.when(skip | ends, state["left"]).otherwise(state["left"] - tokens)
        return F.struct(left.alias("left"), kept.alias("kept"), (state["over"] | ends | (left <= 0)).alias("over"))

    folded = listed.select(by, F.explode(F.aggregate("hits", start, step, lambda s: s["kept"])).alias("e"))
    return folded.select(by, "e.rank", "e.content", "e.tokens", "e.truncated")


def _place(names: list[str]) -> Column:
    return F.array_position(F.array(*map(F.lit, names)), F.col("list"))


def within_budget(records: DataFrame, by: str, most_records: int, most_characters: int, base: int = 0) -> DataFrame:
    """The records (by, list, place, characters) that budgets leave of each context: first a number of records, list by list, then as many
    characters, for which records go from the end of the lists."""
    given = Window.partitionBy(by).orderBy(_place(GIVEN), "place")
    few = records.withColumn("nth", F.row_number().over(given)).where(F.col("nth") <= most_records).drop("nth")
    kept = Window.partitionBy(by).orderBy(_place(TAKEN).desc(), "place").rowsBetween(Window.unboundedPreceding, 0)
    return few.withColumn("sum", F.sum("characters").over(kept)).where(F.col("sum") + base <= most_characters).drop("sum")
