"""Quality rules and a length-normalised log-likelihood ratio of hashed n-grams, in DataFrame operations only.

Words are runs of characters other than ASCII white space. The rules count characters, symbols, repeated lines and words in
repeated windows of each whole text, and fail texts that are short or mostly repetition.

The method compares two multinomials over BUCKETS hashed unigrams and bigrams: the trusted target's, of documents labelled
good, and the raw corpus's, of all documents. A document's score is the mean over its n-grams of ln(p_target / p_raw), in
whole micronats: bucket weights are rounded to integers first, so sums don't depend on their order. A document is kept if its
score reaches a threshold, which is deterministic: the REJECTED quantile of the scores of trusted documents that took no part in
the target's counts. The same rows give the same verdict in every run.

Trusted documents are all that labels call good; halves of them, by a bit of a hash of the id, serve for counts and for the threshold. Raw and target
counts are summed with map-side aggregation to BUCKETS rows, and each text is scored in its own row. Which texts are the target's is settled by a broadcast
of their ids if these are few; else by a filter of at most FILTER cells, and a shuffle of the texts it lets through: the target's, and few others. The threshold
is found among all scores of its half, by two histograms.

Defined cases: a null text is empty: no words, failed. A text without n-grams scores 0. Ids labelled both good and bad aren't trusted; rows
that share a trusted id are all trusted; null ids never are. Without trusted documents every weight is 0 and the rules decide alone;
so they do where the threshold's half is empty. Repeated rows are scored each. Texts of any length are read whole: windows are
compared by 64-bit hashes, sorted. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import BROADCAST_ROWS, stored

SPACE, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 3, 50, 50
BUCKETS = 1 << 15
REJECTED = 0.01
#: Cells of the filter of the target's ids, at most, and cells for an id.
FILTER, SPARSENESS = 1 << 26, 16
#: Scores of one cell of the first histogram.
CELL = 4096
#: Different repeated windows of a text that are looked up one by one.
LOOKED_UP = 8
#: Added to each bucket's count, as a share of a mean bucket.
SMOOTHING = 0.05
MICRO = 1_000_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def covered(windows: Column, ordered: Column) -> Column:
    """Words that stand in windows found twice or more. ``windows``: a hash for each window; ``ordered``: the same in order, null if all differ."""
    none = F.lit(0).cast("bigint")
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    # where windows that are found again start: few different ones are looked up; else windows are sorted with their places
    twice = F.array_distinct(F.filter(ordered, lambda x, i: F.coalesce(x == F.get(ordered, i - 1), F.lit(False))))
    few = lambda t: F.filter(F.transform(windows, lambda x, i: F.when(F.array_contains(t, x), i)), lambda i: i.isNotNull())
    again = lambda s: F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
    many = F.sort_array(F.transform(let(F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), again), lambda x: x["i"]))
    starts = let(twice, lambda t: F.when(F.size(t) <= LOOKED_UP, few(t)).otherwise(many))
    gaps = lambda p: F.transform(p, lambda x, i: F.least(F.lit(WINDOW), x - F.coalesce(F.get(p, i - 1), F.lit(-WINDOW))))
    return F.when(ordered.isNull(), none).otherwise(let(starts, lambda p: F.aggregate(gaps(p), none, lambda a, x: a + x)))


def rules(docs: DataFrame) -> DataFrame:
    """docs (id, text without nulls) with the counts of each text, and its words. One step for each kind of expression, so that those
    without lambdas are compiled."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    words = docs.withColumn("words", split_words(F.col("text")))
    last = F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))
    zipped = F.slice(F.arrays_zip("words", *(F.slice("words", F.lit(i), F.size("words")) for i in range(2, WINDOW + 1))), F.lit(1), last)
    counted = words.select(
        "id",
        "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        F.transform(zipped, lambda z: F.xxhash64(z["words"], *(z[str(i)] for i in range(1, WINDOW)))).alias("windows"),
    )
    ordered = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array("windows"))
    return counted.withColumn("ordered", ordered).withColumn("n_repeat_words", covered(F.col("windows"), F.col("ordered"))).drop("windows", "ordered")


def grams(words: Column) -> Column:
    """A row for each word, with the word before it: null for the first, both null for a text without words."""
    return F.explode_outer(F.arrays_zip(words.alias("word"), F.slice(F.array_prepend(words, F.lit(None)), F.lit(1), F.size(words)).alias("before")))


def buckets(gram: Column) -> tuple[Column, Column]:
    """Of the word, and of the pair, null where there is none."""
    word, before = gram["word"], gram["before"]
    of = lambda *x: F.xxhash64(*x).bitwiseAND(BUCKETS - 1).cast("int")
    return F.when(word.isNotNull(), of(word)), F.when(before.isNotNull(), of(before, word))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(trusted_id, fits): the ids labelled good; half of them fit the target, the others the threshold."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("trusted_id")).agg(F.min(label_col).alias("label")).where("label = 1")
    key = F.xxhash64("trusted_id")
    return good.select("trusted_id", (F.pmod(F.shiftright(key, 17), F.lit(2)) == 0).alias("fits"))


def passed(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows of docs (id, ...) whose id may be among n ids (one column): all that are and, as long as FILTER allows SPARSENESS cells for each, about a
    sixteenth of the others. The cells go to the rows by a broadcast of a bounded number of words."""
    cells = 1 << min(FILTER, max(64, SPARSENESS * n) - 1).bit_length()
    place = lambda c: F.pmod(F.xxhash64(F.lit("filter"), c), F.lit(cells))
    bit = F.expr("shiftleft(1L, CAST(p % 64 AS INT))")
    words = ids.select(place(F.col(ids.columns[0])).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    rows = docs.withColumn("p", place(F.col("id"))).withColumn("word", F.shiftright("p", 6)).join(F.broadcast(words), "word")
    return rows.where(F.col("bits").bitwiseAND(bit) != 0).select(*docs.columns)


def counted(docs: DataFrame) -> DataFrame:
    """(bucket, n) of docs (words)."""
    each = docs.select(grams(F.col("words")).alias("gram"))
    return each.select(F.explode(F.array(*buckets(F.col("gram")))).alias("bucket")).where("bucket IS NOT NULL").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def targets(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of docs (id, text) with an id that fits."""
    own = trusted.where("fits").select(F.col("trusted_id").alias("id"))
    n = own.count()
    if n <= BROADCAST_ROWS:
        return docs.join(F.broadcast(own), "id", "left_semi")
    return passed(docs.where(F.col("id").isNotNull()), own, n).join(own.hint("merge"), "id", "left_semi")


def weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row: the buckets' weights in micronats, in order of buckets."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    split = lambda rows: rows.select(split_words(F.col("text")).alias("words"))
    raw, target = counted(split(texts)).withColumnRenamed("n", "raw"), counted(split(targets(texts, trusted))).withColumnRenamed("n", "target")
    each = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(raw, "bucket", "left").join(target, "bucket", "left")
    every = each.select(F.col("bucket").alias("b"), F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    listed = every.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"), F.array_sort(F.collect_list(F.struct("b", F.col("raw").alias("r"), F.col("target").alias("t")))).alias("counts"))

    def share(n: Column, total: Column) -> Column:
        added = SMOOTHING * total / BUCKETS
        return (n + added) / (total + BUCKETS * added)

    weight = lambda c: F.round(MICRO * F.ln(share(c["t"], F.col("target")) / share(c["r"], F.col("raw")))).cast("int")
    return listed.select(F.when(F.col("target") > 0, F.transform("counts", weight)).otherwise(F.array_repeat(F.lit(0), BUCKETS)).alias("weights"))


def quantile(scores: DataFrame, share: float) -> int | None:
    """The least score (bigint, one column) that a share of the rows doesn't exceed, as percentile_disc finds it, by two histograms."""
    score = F.col(scores.columns[0])
    cells = sorted(tuple(r) for r in scores.groupBy(F.floor(score / CELL).alias("cell")).count().collect())  # micronats of a bounded weight: some thousand rows
    left = max(1, math.ceil(share * sum(n for _, n in cells)))
    for cell, n in cells:
        if n >= left:
            for value, m in sorted(tuple(r) for r in scores.where(score.between(cell * CELL, (cell + 1) * CELL - 1)).groupBy(score).count().collect()):
                left -= m
                if left <= 0:
                    return value
        left -= n
    return None


def verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score, threshold) of each row."""
    trusted = stored(trusted_ids(labels, id_col))
    # BUCKETS numbers, whatever the input; the optimizer folds them to one literal array
    table = F.split(F.lit(",".join(map(str, weights(docs, trusted, id_col, text_col).first().weights))), ",").cast("array<int>")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counted = rules(texts).withColumn("row", F.monotonically_increasing_id())
    counts = [c for c in counted.columns if c not in ("words", "row")]
    single, double = (F.coalesce(F.get(table, b), F.lit(0)) for b in buckets(F.col("gram")))
    # a text's words lie together, so its sum is made before the shuffle, which moves a row for each text
    each = counted.select("row", *counts, grams(F.col("words")).alias("gram")).select("row", *counts, (single + double).cast("bigint").alias("weight"))
    scored = each.groupBy("row").agg(*(F.max(c).alias(c) for c in counts), F.sum("weight").alias("total"))
    score = F.floor(F.col("total") / F.greatest(2 * F.col("n_words") - 1, F.lit(1))).cast("bigint")
    out = stored(scored.select(F.col("id").alias(id_col), *(c for c in counts if c != "id"), score.alias("score")))
    judges = trusted.where("NOT fits").select(F.col("trusted_id").alias(id_col))
    limit = quantile(out.select(id_col, "score").join(judges, id_col, "left_semi").select("score"), REJECTED)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("threshold", F.lit(limit).cast("bigint"))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= F.col("threshold"), F.lit(True)))
