"""Mixing sources to target weights by hash-threshold histograms.

Sizes are word counts. The sources' targets share all words by weight; none exceeds LIMIT times
its source, and what is cut off is shared again by weight. A source takes every document
floor(target / size of the source) times, and once more those whose hash lies below a threshold.
The threshold is found without sorting: words are summed by source and hash bucket, the bucket
that the rest of the budget ends in is found, and only that bucket is split again by the next
bits of the hash, until few rows are left in it. Within it, a row is taken if the budget reaches
its middle. Thresholds are nested: a larger budget takes all that a smaller one takes. No row is taken more than LIMIT times,
those without words neither.

The hash is MD5 of id and text, so reruns and other layouts agree. Rows that share both tie; the
hash of their position in the scan decides between them. Null and empty texts have size 0, texts of any length are counted
whole, null sources are one source, ranked last. An empty table gives an empty result. Other columns, whatever their
names, are kept by ``mix`` and not read otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.shared import broadcast_if_small, checkpoint, fresh, stored

WEIGHTS = (5.0, 2.0, 1.0)
LIMIT = 3
#: Hex digits of the hash for each histogram, so that it has 4096 buckets a source.
DIGITS = 3
#: A boundary bucket of at most this many rows is settled by summing its rows in order.
SMALL_BUCKET = 20_000
_KEY_DIGITS = 64


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def targets(base: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, size): one row a source."""
    ranked = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((order - 1) % len(weights) + 1).cast("int"))
    ranked = checkpoint(ranked.withColumn("weight", weight).withColumn("full", F.lit(False)))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    while True:
        shared = ranked.agg(F.sum(F.when(F.col("full"), limit * F.col("source_size")).otherwise(0)).alias("given"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight"), F.count_if("full").alias("n")).first()
        share = F.lit(float(total - (shared.given or 0))) * F.col("weight") / F.lit(shared.weight or 1.0)
        level = F.when(F.col("full"), (limit * F.col("source_size")).cast("double")).otherwise(share)
        out = ranked.withColumn("target", level)
        over = F.col("full") | (F.col("target") > limit * F.col("source_size"))
        if out.where(over).count() == shared.n:
            return out.select("source", "source_size", "target")
        ranked = checkpoint(out.withColumn("full", over).drop("target"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, limit: int = LIMIT, row: Column | None = None) -> DataFrame:
    """(row, id, size, source_size, target, times): how often the mix takes each row; ``row`` is its position in the scan, or the column given."""
    place = F.monotonically_increasing_id() if row is None else row
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        place.alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        count_words(text).alias("size"),
        F.concat(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), text).cast("binary")), F.md5(place.cast("string").cast("binary"))).alias("key"),
    )
    rows = checkpoint(rows)
    goal = targets(rows, weights, limit).withColumn("full", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(limit))).otherwise(0).cast("bigint"))
    goal = goal.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("full") * F.col("source_size")))
    edges = checkpoint(goal.withColumns({"prefix": F.lit(""), "before": F.lit(0).cast("bigint")}))
    width = 0
    while True:
        # the boundary buckets' rows; in the first round, every row
        inside = _of_source(rows, edges).where(F.substring("key", 1, width) == F.col("prefix")) if width else rows
        if width and (width >= _KEY_DIGITS or inside.count() <= SMALL_BUCKET):
            break
        width += DIGITS
        sums = inside.groupBy("source", F.substring("key", 1, width).alias("bucket")).agg(F.sum("size").alias("words"))
        running = Window.partitionBy("source").orderBy("bucket")
        sums = _of_source(sums, edges).withColumn("start", F.col("before") + F.sum("words").over(running) - F.col("words"))
        # the bucket that the budget ends in: the last one that starts at or before it
        ends = sums.where(F.col("start") <= F.col("rest")).groupBy("source").agg(F.max(F.struct("bucket", "start")).alias("end"))
        ends = ends.select(F.col("source").alias("of"), F.col("end.bucket").alias("bucket"), F.col("end.start").alias("start"))
        joined = edges.join(ends, F.col("source").eqNullSafe(F.col("of")), "left")
        edges = checkpoint(joined.select("source", "source_size", "target", "full", "rest", F.coalesce("bucket", "prefix").alias("prefix"), F.coalesce("start", "before").alias("before")))
    order = Window.partitionBy("source").orderBy("key")
    middle = F.col("before") + F.sum("size").over(order) - F.col("size") / 2
    last = inside.withColumn("middle", middle).where(F.col("middle") <= F.col("rest")).groupBy("source").agg(F.max("key").alias("last"))
    last = last.withColumnRenamed("source", "of")
    edges = checkpoint(edges.join(last, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"))
    # all of a smaller bucket, and of the boundary bucket what is not behind its last row taken
    extra = (F.substring("key", 1, width) < F.col("prefix")) | ((F.substring("key", 1, width) == F.col("prefix")) & F.coalesce(F.col("key") <= F.col("last"), F.lit(False)))
    return _of_source(rows, edges).select("row", "id", "size", "source_size", "target", F.least(F.lit(limit), F.col("full") + extra.cast("bigint")).alias("times"))


def _of_source(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows with the columns of their source's row in edges."""
    of = edges.withColumnRenamed("source", "of")
    return rows.join(broadcast_if_small(of), F.col("source").eqNullSafe(F.col("of"))).drop("of")


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken): the words that the mix takes of each row."""
    return repeats(docs, id_col, text_col, source_col).select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs' rows as the mix takes them, a row for each time."""
    position, row, times, copy = fresh(docs, "row_position", "taken_row", "taken_times", "taken_copy")
    numbered = stored(docs.withColumn(position, F.monotonically_increasing_id()))  # positions may differ from scan to scan
    found = repeats(numbered, id_col, text_col, source_col, row=F.col(position)).where("times > 0").select(F.col("row").alias(row), F.col("times").alias(times))
    joined = numbered.join(found, F.col(position) == F.col(row))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)
