"""Search: filters, dense, sparse and hybrid top-k, fusion, re-ranking, neighbours, facets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K1, B, RRF = 1.2, 0.75, 60
#: Queries of a dense search that are sent together, and points that they are compared with at a time.
BLOCK, CHUNK = 2048, 1024
#: Queries of a sparse search that are sent together, about, points that they are compared with at a time, and matches of their terms that are listed at once.
ASKED, POINTS, MATCHES = 1024, 1024, 1 << 21
#: Queries of a token overlap that are broadcast together, and rows that any other broadcast has at most.
OVERLAP, SMALL = 512, 100_000


def matches(equal: dict[str, object] | None = None, any_of: dict[str, object] | None = None, within: dict[str, list] | None = None, ranges: dict[str, tuple] | None = None) -> Column:
    """The conjunction of the filters that are set: equality, membership in a list column, in a list of values, ranges."""
    conds = [F.col(c) == v for c, v in (equal or {}).items() if v]
    conds += [F.array_contains(c, v) for c, v in (any_of or {}).items() if v]
    conds += [F.col(c).isin(v) for c, v in (within or {}).items() if v]
    for c, (low, high) in (ranges or {}).items():
        conds += [F.col(c) >= low] if low is not None else []
        conds += [F.col(c) <= high] if high is not None else []
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def ranked(df: DataFrame, k: int, by: list[str], *order: Column) -> DataFrame:
    """The first k rows of each query, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def dense(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(query_id, point_id, score, rank) by cosine; scores are compared at nine decimals. queries: (query_id, query), of any
    number; points: (point_id, vec). Null vectors count as zeros."""
    asked = queries.count()
    if not asked:
        return queries.select("query_id").join(points.select("point_id"), F.lit(False)).select("query_id", "point_id", F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
    blocks = -(-asked // BLOCK)
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    found = [_nearest(numbered.where(F.col("block") == i), points, k) for i in range(blocks)]
    return ranked(reduce(DataFrame.unionAll, found), k, ["query_id"], F.col("place").desc(), F.col("point_id")).drop("place")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows."""
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims))
    if set(pc.list_value_length(column.drop_null()).to_pylist()) - {dims}:
        raise ValueError(f"a vector does not have {dims} components")
    out[valid] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return out


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length != 0)


def _nearest(queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(query_id, point_id, score, place): for one block of queries, the k best of every CHUNK points of a partition."""
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((queries, "query_id"), (points, "point_id"))]
    rows = queries.select("query_id", "query").toArrow().combine_chunks()
    names = rows.column(0).combine_chunks()
    vectors = rows.column(1).combine_chunks()
    dims = max(pc.list_value_length(vectors).drop_null().to_pylist(), default=0)
    shared = queries.sparkSession.sparkContext.broadcast((names, _unit(_matrix(vectors, dims))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows if len(names) else 0, CHUNK):
                part = batch.slice(at, CHUNK)
                part = part.take(pc.array_sort_indices(part.column(0), null_placement="at_start"))
                scores = np.fmax(-1.0, np.fmin(1.0, wanted @ _unit(_matrix(part.column(1), dims)).T))
                place = np.rint(scores * 1e9).astype(np.int64)
                least = np.partition(place, max(0, len(part) - k), axis=1)[:, max(0, len(part) - k)][:, None]
                keep, ties = place > least, place == least
                keep |= ties & (ties.cumsum(axis=1) <= k - keep.sum(axis=1, keepdims=True))
                query, point = np.nonzero(keep)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(query)), part.column(0).take(pa.array(point)), pa.array(scores[keep]), pa.array(place[keep])], names=["query_id", "point_id", "score", "place"])

    return points.select("point_id", "vec").mapInArrow(run, f"query_id {kinds[0]}, point_id {kinds[1]}, score double, place bigint")


def postings(docs: DataFrame, tokens: Column) -> DataFrame:
    """(point_id, term, tf, length) of (point_id, ...)."""
    listed = docs.select("point_id", tokens.alias("tokens")).select("point_id", F.size("tokens").alias("length"), F.explode("tokens").alias("term"))
    return listed.groupBy("point_id", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("length").alias("length"))


def _small(df: DataFrame) -> DataFrame:
    """df to be broadcast if a count shows that it has at most SMALL rows, else as it is: the join then shuffles."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def _cut(df: DataFrame) -> DataFrame:
    """df, written to the checkpoint folder where one is set, else kept by the executors."""
    return df.checkpoint(eager=True) if df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined() else df.persist()


def sparse(queries: DataFrame, docs: DataFrame, tokens: Column, k: int, k1: float = K1, b: float = B) -> DataFrame:
    """(query_id, point_id, score, rank) by BM25. queries: (query_id, term), any number of them; repeated rows count once. Null or empty texts
    count as documents without tokens.

    Of the documents' tokens only those that a query asks for leave the scan, with a row for each document for its length; terms go to them by broadcasts
    whose size is checked, else by shuffles. Queries go to the documents in blocks, each a broadcast of its own, and each partition keeps the best only."""
    asked = _cut(queries.select("query_id", "term").where("term IS NOT NULL").distinct())
    wanted = _cut(asked.select("term").distinct().withColumn("hit", F.lit(True)))
    listed = docs.select("point_id", tokens.alias("tokens")).select("point_id", F.greatest(F.size("tokens"), F.lit(0)).alias("length"), F.posexplode_outer("tokens").alias("place", "term"))
    hits = listed.join(_small(wanted), "term", "left").where("hit OR place IS NULL OR place = 0")
    rows = _cut(hits.groupBy("point_id", "length", F.when(F.col("hit"), F.col("term")).alias("term")).agg(F.count(F.lit(1)).alias("tf"), F.count_if(F.coalesce("place", F.lit(0)) == 0).alias("firsts")))
    sizes = rows.where("firsts > 0").agg(F.count(F.lit(1)).alias("docs"), F.avg("length").alias("mean")).first()
    if not sizes.docs:
        return rows.select(F.lit(None).cast(queries.schema["query_id"].dataType).alias("query_id"), "point_id", F.lit(0.0).alias("score"), F.lit(0).alias("rank")).limit(0)
    found = rows.where("term IS NOT NULL").select("point_id", "length", "term", "tf")
    frequency = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (sizes.docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.lit(sizes["mean"] or 1.0)))
    scored = found.join(_small(frequency), "term").select("point_id", "term", weight.alias("weight"))
    vectors = _cut(scored.groupBy("point_id").agg(F.collect_list(F.struct("term", "weight")).alias("v")).select("point_id", F.col("v.term").alias("terms"), F.col("v.weight").alias("weights")))
    asking = asked.agg(F.countDistinct(F.xxhash64("query_id")).alias("queries"), F.count(F.lit(1)).alias("rows")).first()
    blocks = max(1, -(-asking.queries // ASKED), -(-asking.rows // (ASKED * 512)))
    numbered = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    best = [_scored(numbered.where(F.col("block") == i), vectors, k) for i in range(blocks)]
    return ranked(reduce(DataFrame.unionAll, best), k, ["query_id"], F.col("place").desc(), F.col("point_id")).drop("place")


def _scored(asked: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query_id, point_id, score, place): for one block of queries (query_id, term), the k best of every partition of vectors (point_id, terms, weights). Pairs
    of queries and points are added up where the points lie, so none is shuffled."""
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((asked, "query_id"), (vectors, "point_id"))]
    rows = asked.select("query_id", "term").orderBy("term").toArrow().combine_chunks()
    if not rows.num_rows:
        return vectors.select(F.lit(None).cast(kinds[0]).alias("query_id"), "point_id", F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("place")).limit(0)
    names = pc.unique(rows.column(0).combine_chunks())
    queries = pc.index_in(rows.column(0).combine_chunks(), names).to_numpy()
    terms, counts = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in pc.value_counts(rows.column(1).combine_chunks()).flatten())
    shared = asked.sparkSession.sparkContext.broadcast((names, queries, terms, np.concatenate(([0], np.cumsum(counts.to_numpy())))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kept, fresh = shared.value[0], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, POINTS):
                part = batch.slice(at, POINTS)
                scores = _sums(part, *shared.value)
                place = np.rint(scores * 1e9).astype(np.int64)
                # all that tie with the k-th best stay until the best are told apart
                least = np.partition(place, max(0, len(part) - k), axis=0)[max(0, len(part) - k)]
                point, query = np.nonzero((place >= least) & (scores > 0))
                kept.append(pa.table({"query": query, "point_id": part.column(0).take(pa.array(point)), "score": scores[point, query], "place": place[point, query]}))
                fresh += len(point)
            if fresh > MATCHES:
                kept, fresh = [_best(pa.concat_tables(kept), k)], 0
        if kept:
            found = _best(pa.concat_tables(kept), k)
            found = pa.table([names.take(found.column(0)), *found.columns[1:]], names=["query_id", "point_id", "score", "place"])
            yield from found.combine_chunks().to_batches()

    return vectors.mapInArrow(run, f"query_id {kinds[0]}, point_id {kinds[1]}, score double, place bigint")


def _sums(part: pa.RecordBatch, names: pa.Array, queries: np.ndarray, terms: pa.Array, starts: np.ndarray) -> np.ndarray:
    """The scores of points (id, terms, weights; without weights each term counts 1) as rows, by queries; 0 where they share no term. terms: all of the queries'; those
    of one term are queries[starts[term]:starts[term + 1]]."""
    lists, out = part.column(1), np.zeros((len(part), len(names)))
    term = pc.index_in(lists.flatten(), terms)
    known = np.flatnonzero(term.is_valid().to_numpy(zero_copy_only=False))
    term = term.take(pa.array(known)).to_numpy().astype(np.int64)
    point = np.repeat(np.arange(len(part)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())[known]
    weight = part.column(2).flatten().to_numpy()[known] if part.num_columns > 2 else np.ones(len(known))
    times = starts[term + 1] - starts[term]
    upto = np.cumsum(times)
    at = 0
    while at < len(term):  # matches are listed a bounded number at a time
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + MATCHES, side="right")))
        n = times[at:end]
        own = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[term[at:end]], n)
        first, last = point[at], point[end - 1] + 1
        cell = np.repeat(point[at:end] - first, n) * len(names) + queries[own]
        out[first:last] += np.bincount(cell, np.repeat(weight[at:end], n), (last - first) * len(names)).reshape(last - first, -1)
        at = end
    return out


def _best(found: pa.Table, k: int) -> pa.Table:
    """The k best rows of each query."""
    found = found.take(pc.sort_indices(found, [("query", "ascending"), ("place", "descending"), ("point_id", "ascending")], null_placement="at_start"))
    query = found.column(0).to_numpy()
    first = np.flatnonzero(np.diff(query, prepend=-1))
    return found.filter(pa.array(np.arange(len(query)) - np.repeat(first, np.diff(first, append=len(query))) < k))


def fused(rankings: list[DataFrame], k: int = RRF) -> DataFrame:
    """(query_id, point_id, score): reciprocal ranks, of each ranking the first place of a point."""
    firsts = [r.groupBy("query_id", "point_id").agg(F.min("rank").alias("rank")) for r in rankings]
    every = reduce(DataFrame.unionAll, (r.select("query_id", "point_id", "rank") for r in firsts))
    return every.groupBy("query_id", "point_id").agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"))


def hybrid(rankings: list[DataFrame], limit: int) -> DataFrame:
    return ranked(fused(rankings), limit, ["query_id"], F.round("score", 12).desc(), F.col("point_id"))


def token_overlap(queries: DataFrame, docs: DataFrame, limit: int) -> DataFrame:
    """(query_id, point_id, score, rank): the share of a query's token set that a document holds; zeros are kept. Both: (id, tokens). Queries go in blocks of
    about OVERLAP, each a broadcast of its own; tokens are counted where the documents lie, and each partition keeps the best only."""
    blocks = max(1, -(-queries.count() // OVERLAP))
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    sets = docs.select("point_id", F.array_distinct("tokens").alias("tokens"))
    found = [_overlapping(numbered.where(F.col("block") == i).select("query_id", F.array_distinct("query").alias("query")), sets, limit) for i in range(blocks)]
    return ranked(reduce(DataFrame.unionAll, found), limit, ["query_id"], F.desc("score"), F.col("point_id"))


def _overlapping(queries: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(query_id, point_id, score): for one block of queries, the k best of every partition of docs. Without a set on either side there is no score; such rows come last."""
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((queries, "query_id"), (docs, "point_id"))]
    rows = queries.toArrow().combine_chunks()
    names, lists = (rows.column(i).combine_chunks() for i in (0, 1))
    sizes, unset = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64), lists.is_null().to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    codes, terms = coded.indices.to_numpy(), coded.dictionary
    starts = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=len(terms)))))
    asked = np.repeat(np.arange(len(names)), sizes)[np.argsort(codes, kind="stable")]
    shared = queries.sparkSession.sparkContext.broadcast((names, asked, terms, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kept, fresh = shared.value[0], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows if len(names) else 0, POINTS):
                part = batch.slice(at, POINTS)
                part = part.take(pc.array_sort_indices(part.column(0), null_placement="at_start"))
                place = np.rint(_sums(part, *shared.value)).astype(np.int64)
                place[part.column(1).is_null().to_numpy(zero_copy_only=False)] = -1
                place[:, unset] = -1
                least = np.partition(place, max(0, len(part) - k), axis=0)[max(0, len(part) - k)]
                keep, ties = place > least, place == least
                keep |= ties & (ties.cumsum(axis=0) <= k - keep.sum(axis=0))
                point, query = np.nonzero(keep)
                kept.append(pa.table({"query": query, "point_id": part.column(0).take(pa.array(point)), "place": place[keep]}))
                fresh += len(point)
            if fresh > MATCHES:
                kept, fresh = [_best(pa.concat_tables(kept), k)], 0
        if kept:
            found = _best(pa.concat_tables(kept), k)
            query, place = found.column("query").to_numpy(), found.column("place").to_numpy()
            score = pa.array(place / np.maximum(1, sizes)[query], mask=place < 0)
            yield from pa.table({"query_id": names.take(found.column("query")), "point_id": found.column("point_id"), "score": score}).combine_chunks().to_batches()

    return docs.mapInArrow(run, f"query_id {kinds[0]}, point_id {kinds[1]}, score double")


def reordered(hits: DataFrame, *order: Column) -> DataFrame:
    """Hits in a new stable order: ties keep their rank."""
    by = Window.partitionBy("query_id").orderBy(*order, F.col("rank"))
    return hits.withColumn("new_rank", F.row_number().over(by))


def feedback_scores(events: DataFrame, weights: dict[str, float], low: float = -0.5, high: float = 0.3) -> DataFrame:
    """(target, adjustment): the labels' weights, summed and clamped. events: (target, label)."""
    weight = F.coalesce(*(F.when(F.col("label") == k, F.lit(float(v))) for k, v in weights.items()), F.lit(0.0))
    return events.groupBy("target").agg(F.greatest(F.lit(low), F.least(F.lit(high), F.sum(weight))).alias("adjustment"))


def neighbours(chunks: DataFrame, hits: DataFrame, before: int, after: int) -> DataFrame:
    """The chunks of the hits' documents from ``before`` ahead to ``after`` behind. Both: (document_id, chunk_index)."""
    own = hits.select(F.col("document_id"), F.explode(F.sequence(F.col("chunk_index") - before, F.col("chunk_index") + after)).alias("chunk_index"), F.col("chunk_index").alias("hit_index"))
    return chunks.join(own, ["document_id", "chunk_index"])


def facets(docs: DataFrame, value: Column, offset: int, limit: int) -> DataFrame:
    """(value, n): counts of non-empty values, most frequent first, one page of them."""
    counted = docs.select(value.alias("value")).where("value IS NOT NULL AND value <> ''").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "value").offset(offset).limit(limit)


def facet_page(rows: DataFrame, value: Column, offset: int, limit: int) -> DataFrame:
    """A page of ``facets`` with the cursor of the next one (null at the end); several values of a row come as rows."""
    counted = rows.select(value.alias("value")).where("value IS NOT NULL AND value <> ''").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.count(F.lit(1)).alias("total"))  # one row
    page = counted.orderBy(F.desc("n"), "value").offset(offset).limit(limit).join(total, F.lit(True))
    return page.select("value", "n", F.when(F.col("total") > offset + limit, F.lit(offset + limit)).alias("next_cursor"))


def resolution(matches: DataFrame) -> DataFrame:
    """(status): not_found, unique or ambiguous, by the number of matches."""
    return matches.agg(F.count(F.lit(1)).alias("n")).select("n", F.when(F.col("n") == 0, "not_found").when(F.col("n") == 1, "unique").otherwise("ambiguous").alias("status"))
