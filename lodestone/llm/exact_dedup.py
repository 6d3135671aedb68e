"""Exact deduplication by two-pass Bloom filtering.

Pass 1 hashes every normalised text (A-Z lower-cased, null as empty) and adds the hashes to a
saturating cell filter. Pass 2 asks the filter: a hash that it has not seen twice belongs to a
text of its own, whose row passes straight through; only the others shuffle, as hashes and ids,
never as texts. Groups are exact: they are made by SHA-256, the filter only sorts out.

The filter has room for all rows: beyond a fixed size, the hashes are dealt to several filters by ranges, which
are made and asked one after the other, so none ever fills up and what is broadcast stays bounded.

Groups of copies are counted with map-side aggregation. Their totals return to the rows through
two joins: groups of at least 1/HEAVY of all candidate rows (at most HEAVY of them, so their
broadcast is bounded) by broadcast, the others, none of them hot, by shuffle.

Of rows that share text and id, one stays: the one whose position in the scan is last. Null ids
rank below all others. Texts of any length are read whole, and empty ones are equal to null ones. An empty table gives
an empty result; other columns are kept by ``deduplicate`` as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import LOWER, UPPER, broadcast_if_small, checkpoint, fresh, split_repeated, stored

#: Groups of at least 1/HEAVY of the candidate rows are joined by broadcast.
HEAVY = 1000


def text_key(text_col: str):  # noqa: ANN201
    """SHA-256 (binary) of the normalised text."""
    return F.unhex(F.sha2(F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER).cast("binary"), 256))


def _first_pass(docs: DataFrame, id_col: str, text_col: str, row: Column | None = None) -> list[tuple[DataFrame, Callable]]:
    """The checkpointed (row, id, key, h) of docs, in ranges of h, and each range's test."""
    hashed = docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(id_col).alias("id"), text_key(text_col).alias("key"))
    rows = checkpoint(hashed.withColumn("h", F.xxhash64("key")))
    return split_repeated(rows, "h", rows.count())


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _totals(found: DataFrame) -> tuple[DataFrame, int]:
    """(key, keep_row, keep_id, group_size) of the candidate rows, and the size that makes a group heavy."""
    totals = found.groupBy("key").agg(F.max(F.struct("id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size"))
    totals = checkpoint(totals.select("key", F.col("last.row").alias("keep_row"), F.col("last.id").alias("keep_id"), "group_size"))
    return totals, max(2, (totals.agg(F.sum("group_size")).first()[0] or 0) // HEAVY)


def _joined(found: DataFrame, key: str, totals: DataFrame, heavy: int) -> DataFrame:
    """found with its groups' totals; ``key`` is found's column, totals' is ``key``."""
    many, few = F.broadcast(totals.where(F.col("group_size") >= heavy)), totals.where(F.col("group_size") < heavy)
    on = found[key] == totals["key"]
    return found.join(many, on).drop(totals["key"]).unionByName(found.join(few, on).drop(totals["key"]))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, key binary, keep_row, keep_id, group_size) for each row of docs, ``row`` being its position in the scan."""
    parts = _first_pass(docs, id_col, text_col)
    alone = _all([rows.where(~maybe("h")) for rows, maybe in parts]).select("row", "id", "key", F.col("row").alias("keep_row"), F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"))
    found = _all([rows.where(maybe("h")) for rows, maybe in parts]).select("row", "id", F.col("key").alias("own_key"))
    totals, heavy = _totals(found.withColumnRenamed("own_key", "key"))
    return alone.unionByName(_joined(found, "own_key", totals, heavy).withColumnRenamed("own_key", "key"))


def assignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for each row, the dropped ones too."""
    return groups(docs, id_col, text_col).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("key")).alias("text_sha256")
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with docs' columns."""
    position, lost = fresh(docs, "row_position", "lost_position")
    numbered = stored(docs.withColumn(position, F.monotonically_increasing_id()))  # positions may differ from scan to scan
    parts = _first_pass(numbered, id_col, text_col, F.col(position))
    found = _all([rows.where(maybe("h")) for rows, maybe in parts]).select("row", F.col("id"), F.col("key").alias("own_key"))
    totals, heavy = _totals(found.withColumnRenamed("own_key", "key"))
    dropped = checkpoint(_joined(found, "own_key", totals, heavy).where("row <> keep_row").select(F.col("row").alias(lost)))
    return numbered.join(broadcast_if_small(dropped), F.col(position) == F.col(lost), "left_anti").select(*docs.columns)
