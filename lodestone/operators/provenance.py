"""Spans: mapping ranges to segments, coverage, references between records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import vector


def clipped(ranges: DataFrame, segments: DataFrame, key: str) -> DataFrame:
    """The parts of ranges (key, range_id, begin, end) that lie in segments (key, segment_id, s_begin, s_end, source_begin)."""
    joined = ranges.join(segments, key).where((F.col("begin") < F.col("s_end")) & (F.col("s_begin") < F.col("end")))
    low, high = F.greatest("begin", "s_begin"), F.least("end", "s_end")
    return joined.select(key, "range_id", "segment_id", low.alias("begin"), high.alias("end"), (F.col("source_begin") + low - F.col("s_begin")).alias("source_begin"))


def covered(ranges: DataFrame, segments: DataFrame, key: str) -> DataFrame:
    """(key, range_id, length, covered, complete) for segments that don't overlap."""
    parts = clipped(ranges, segments, key).groupBy(key, "range_id").agg(F.sum(F.col("end") - F.col("begin")).alias("covered"))
    out = ranges.join(parts, [key, "range_id"], "left").withColumn("length", F.col("end") - F.col("begin")).withColumn("covered", F.coalesce("covered", F.lit(0)).cast("bigint"))
    return out.select(key, "range_id", "length", "covered", (F.col("covered") == F.col("length")).alias("complete"))


def coverage(rows: DataFrame, group: str) -> DataFrame:
    """(group, ratio) of covered characters; 0 where there are none."""
    return rows.groupBy(group).agg(F.when(F.sum("length") > 0, F.sum("covered") / F.sum("length")).otherwise(0.0).alias("ratio"))


def overlapping(segments: DataFrame, key: str, begin: str, end: str) -> DataFrame:
    """Segments that begin before an earlier one ends."""
    by = Window.partitionBy(key).orderBy(begin, end).rowsBetween(Window.unboundedPreceding, -1)
    return segments.withColumn("before", F.max(end).over(by)).where(F.col("before") > F.col(begin)).drop("before")


def eligible(records: DataFrame, key: str, refs: str, accepted: DataFrame) -> DataFrame:
    """Records with references all of which are accepted; accepted: one column of ids."""
    ids = accepted.select(F.col(accepted.columns[0]).alias("ref"), F.lit(True).alias("ok")).distinct()
    listed = records.select(key, F.explode(refs).alias("ref")).join(ids, "ref", "left")
    return listed.groupBy(key).agg(F.every(F.coalesce("ok", F.lit(False))).alias("eligible")).where("eligible").select(key)


def orphans(children: DataFrame, parents: DataFrame, child: str, parent: str) -> DataFrame:
    return children.join(parents.select(F.col(parent).alias(child)), child, "left_anti")


def _grams(value: Column, q: int) -> Column:
    """The distinct runs of q characters of a text."""
    chars = F.array(F.split(value, ""))
    pieces = F.transform(chars, lambda c: F.array_compact(F.transform(c, lambda x, i: F.concat(x, *(F.get(c, i + j) for j in range(1, q))))))
    return F.array_distinct(F.get(pieces, F.lit(0)))


def holders(items: DataFrame, docs: DataFrame, inner: int = 3) -> DataFrame:
    """(item_id, doc_id) candidates among documents that may hold an item's text: all that do are among them. items: (item_id, own, t), docs: (doc_id, body, t); own
    and body are lower-cased, t their words.

    An item's words but the first and the last stand whole in a text that holds it, so items of ``inner`` words or more meet documents by their longest such
    word. Those of fewer words stand in words of such a text: their longest word finds the words that hold it among all different words, and those find the
    documents. Items without words meet documents by their first three characters, or all of them if they are fewer."""
    longest = lambda c: F.array_max(F.transform(c, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    seen = docs.select("doc_id", F.explode(F.array_distinct("t")).alias("w"))
    asked = items.where(F.size("t") >= inner).select("item_id", longest(F.slice("t", F.lit(2), F.size("t") - 2)).alias("w"))
    few = items.where((F.size("t") > 0) & (F.size("t") < inner)).select("item_id", longest("t").alias("part"))
    if few.limit(1).count():
        words = seen.select("w").distinct()
        for q in sorted(r.q for r in few.select(F.least(F.length("part"), F.lit(3)).alias("q")).distinct().collect()):  # at most three lengths
            own = few.where(F.least(F.length("part"), F.lit(3)) == q).withColumn("g", F.substring("part", 1, q))
            pieces = words.select("w", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("w") - q + 1, F.lit(1))), lambda i: F.substring("w", i, F.lit(q))))).alias("g"))
            asked = asked.unionByName(own.join(pieces, "g").where(F.contains("w", "part")).select("item_id", "w"))
    found = asked.join(seen, "w").select("item_id", "doc_id")
    bare = items.where((F.size("t") == 0) & (F.col("own") != "")).select("item_id", F.substring("own", 1, 3).alias("w"))
    for q in sorted(r.q for r in bare.select(F.length("w").alias("q")).distinct().collect()):  # at most three lengths
        grams = docs.select("doc_id", F.explode(_grams(F.col("body"), q)).alias("w"))
        found = found.unionByName(bare.where(F.length("w") == q).join(grams, "w").select("item_id", "doc_id"))
    return found.distinct()


def similarity(items: DataFrame, docs: DataFrame, tokens: Callable[[str], Column], n: int = 5) -> DataFrame:
    """(item_id, doc_id, shared, overlap, run, exact, risk) of the pairs that share n words in a row or whose document holds the item exactly. Both: (id,
    text). run is the longest common run of words. Items without text are in no pair.

    A common run lies on one diagonal of the common n-grams' positions. A document that holds an item of n + 2 words or more has all its words but the first and
    the last in a row, so only pairs with such a run are compared as texts; shorter items find their documents by ``holders``. Documents are cut into words once,
    and meet the pairs a second time by id as they are."""
    words = items.select("item_id", F.lower(F.regexp_replace("text", r"(?U)^\s+|\s+$", "")).alias("own"), tokens("text").alias("t"))
    own = words.select("item_id", vector.runs(F.col("t"), n).alias("r"))
    # outer explodes, since a filter inferred from inner ones would repeat the whole expressions below
    own = own.select("item_id", F.size(F.array_distinct("r")).alias("n"), "r", F.posexplode_outer("r").alias("i", "s")).where("s IS NOT NULL")
    own = own.select("item_id", "n", "i", "s", F.array_position("r", F.col("s")).alias("gram"))
    # the runs one by one, not as an array made by a lambda, which Spark interprets for each word
    seen = docs.select("doc_id", tokens("text").alias("t")).select("doc_id", "t", F.posexplode_outer("t").alias("j", "w")).where(F.col("j") <= F.size("t") - n)
    seen = seen.select("doc_id", "j", F.concat_ws(" ", "w", *(F.get("t", F.col("j") + x) for x in range(1, n))).alias("s"))
    common = seen.join(own, "s").select("item_id", "doc_id", "n", "gram", "i", (F.col("j") - F.col("i")).alias("d"))
    place = F.row_number().over(Window.partitionBy("item_id", "doc_id").orderBy("d", "i"))
    islands = common.withColumn("island", F.col("i") - place).groupBy("item_id", "doc_id", "d", "island")
    islands = islands.agg(F.count("i").alias("length"), F.collect_set("gram").alias("grams"), F.max("n").alias("n"))
    grams = F.size(F.array_distinct(F.flatten(F.collect_list("grams")))).cast("bigint")
    pairs = islands.groupBy("item_id", "doc_id").agg((F.max("length") + n - 1).alias("common_run"), grams.alias("common"), F.max("n").alias("n"))
    few = words.where((F.size("t") < n + 2) & (F.col("own") != ""))
    found = holders(few, docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("body"), tokens("text").alias("t")))
    both = pairs.join(found.withColumn("found", F.lit(True)), ["item_id", "doc_id"], "full_outer").join(words.withColumnRenamed("t", "it"), "item_id", "left")
    both = both.join(docs.select("doc_id", "text"), "doc_id", "left")
    # when() keeps the others' texts from being read
    asked = F.col("found") | ((F.size("it") >= n + 2) & (F.col("common_run") >= F.size("it") - 2))
    both = both.withColumn("exact", F.coalesce(F.when(asked, F.contains(F.lower(F.coalesce("text", F.lit(""))), "own")), F.lit(False)))
    both = both.where(F.col("common").isNotNull() | F.col("exact"))
    # runs below n words, of the short items only
    both = both.withColumn("t", F.when(F.col("exact") & (F.size("it") < n + 2), tokens("text")))
    short = F.coalesce(*(F.when(F.arrays_overlap(vector.runs(F.col("it"), m), vector.runs(F.col("t"), m)), m) for m in range(n - 1, 0, -1)), F.lit(0))
    run, ratio, exact = F.coalesce("common_run", short.cast("bigint")), F.coalesce(F.col("common") / F.col("n"), F.lit(0.0)), F.col("exact")
    both = both.select("item_id", "doc_id", F.coalesce("common", F.lit(0)).cast("bigint").alias("shared"), ratio.alias("overlap"), run.alias("run"), "exact")
    return both.select("*", vector.risk_level(exact, F.col("run"), F.col("overlap"), F.lit(0.0)).alias("risk"))
