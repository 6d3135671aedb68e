"""Ordered folds over a document's paragraphs or a query's hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import token_count


def paragraphs(text: Column, separator: str = r"\n\s*\n") -> Column:
    return F.filter(F.transform(F.split(text, separator), lambda p: F.trim(p)), lambda p: p != "")


def packed(parts: Column, most: int, glue: str = "\n\n") -> Column:
    """Greedy chunks of paragraphs of at most ``most`` white space tokens; a longer paragraph stays whole.

    The fold only adds up tokens and keeps a number for each paragraph that begins a chunk; texts are cut once, behind it."""
    sizes = F.transform(parts, token_count)
    state = F.struct(F.lit("").alias("cuts"), F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("at"))

    def step(s: Column, n: Column) -> Column:
        begins = (s["n"] == 0) | (s["n"] + n > most)
        cuts = F.when(begins, F.concat(s["cuts"], s["at"].cast("string"), F.lit(","))).otherwise(s["cuts"])
        return F.struct(cuts.alias("cuts"), F.when(begins, n).otherwise(s["n"] + n).alias("n"), (s["at"] + 1).alias("at"))

    # bound to variables, since what follows names them more than once
    bound = F.transform(F.array(F.struct(parts.alias("p"), F.aggregate(sizes, state, step, lambda s: s["cuts"]).alias("cuts"))), lambda x: F.struct(x["p"].alias("p"), F.filter(F.split(x["cuts"], ","), lambda c: c != "").cast("array<int>").alias("b")))

    def cut(x: Column) -> Column:
        upto = lambda i: F.coalesce(F.get(x["b"], i + 1), F.size(x["p"]))
        return F.transform(x["b"], lambda b, i: F.array_join(F.slice(x["p"], b + 1, upto(i) - b), glue))

    return F.get(F.transform(bound, cut), F.lit(0))


def chunks(docs: DataFrame, key: str, text: str, most: int, separator: str = r"\n\s*\n") -> DataFrame:
    """(key, chunk_index, text, token_count, text_sha256)."""
    exploded = docs.select(key, F.posexplode(packed(paragraphs(F.col(text), separator), most)).alias("chunk_index", "text"))
    return exploded.select(key, F.col("chunk_index").cast("bigint").alias("chunk_index"), "text", token_count(F.col("text")).alias("token_count"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def budgeted(hits: DataFrame, by: str, rank: str, cost: str, budget: int) -> DataFrame:
    """Hits with ``granted``: their cost, what is left of the budget at the boundary, and no row after it."""
    before = F.coalesce(F.sum(cost).over(Window.partitionBy(by).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return hits.withColumn("granted", F.least(F.col(cost), F.lit(budget) - before)).where("granted > 0")
