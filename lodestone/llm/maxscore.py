"""Exact top-k search by inner product with MaxScore over sharded, dimension-wise postings.

Vectors are quantised to integers (floor(scale * x)), so every score is an integer and ties are
exact. A shard holds up to SHARD vectors, dimension by dimension: a dimension is a term, its
postings are the shard's values of it, and its bounds are the least and greatest contribution
that it can make to a query's score. For each query, the terms are sorted by the spread of their
bounds; those at the end whose spreads together cannot lift a vector to the current k-th score
are non-essential. The essential postings are traversed for the whole shard, then the
non-essential ones are probed, a few at a time, only for vectors that are still competitive.
A task merges its shards' k best by query as it goes, so that each
shard starts from the threshold of those before it, and the tasks' k best are merged by query.

Shards are stored and stay in place. Queries come to them in blocks of at most BLOCK, one block after the other, each by a
broadcast that BLOCK bounds; only the k best of each query and task are shuffled. Vectors that are null or
hold null or non-finite components take no part; shorter vectors count as padded with zeros. Rows
that share an id are rows of their own: a query excludes only its own row. Equal scores rank the
smaller id first, null ids last. Null ids are no queries. Components beyond 64 bits and scores that may reach
2^53 raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.shared import checkpoint, stored

SCALE = 256
SHARD = 16_384
BLOCK = 4096
#: Blocks whose results are written at once.
BLOCKS = 16
#: Vectors that are scored first, to get a threshold, and terms that are probed between two tests.
SEEDS, STEP = 128, 8
_PACKED = "dims int, n int, rows binary, ids binary, named binary, cells binary"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(row, id, vec array<bigint>) of the vectors that take part."""
    values = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.col(vector_col).isNotNull() & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(values, lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint"))
    return vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.when(good, whole).alias("vec")).where("vec IS NOT NULL")


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors as rows, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _pack(batch: pa.RecordBatch) -> dict:
    """One row that holds a batch of (row, id, vec)."""
    matrix, ids = _matrix(batch.column(batch.schema.get_field_index("vec"))), batch.column(batch.schema.get_field_index("id"))
    top = int(np.abs(matrix).max(initial=0))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max)
    return {
        "dims": matrix.shape[1] * 10 + np.dtype(kind).itemsize,
        "n": len(matrix),
        "rows": batch.column(batch.schema.get_field_index("row")).to_numpy().astype(np.int64).tobytes(),
        "ids": ids.fill_null(0).to_numpy().astype(np.int64).tobytes(),
        "named": ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
        "cells": matrix.astype(kind).T.tobytes(),
    }


def _unpack(packed: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    dims, width = divmod(packed["dims"], 10)
    cells = np.frombuffer(packed["cells"], f"i{width}").reshape(dims, packed["n"]).astype(np.int64)
    return np.frombuffer(packed["rows"], np.int64), np.frombuffer(packed["ids"], np.int64), np.frombuffer(packed["named"], bool), cells


def _batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of ``most`` rows, the last one smaller."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - n)
            held.append(part)
            n, batch = n + part.num_rows, batch.slice(part.num_rows)  # noqa: PLW2901
            if n == most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _pack_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _batches(batches, SHARD):
        yield pa.RecordBatch.from_pylist([_pack(batch)], schema=_ARROW)


_ARROW = pa.schema([("dims", pa.int32()), ("n", pa.int32()), ("rows", pa.binary()), ("ids", pa.binary()), ("named", pa.binary()), ("cells", pa.binary())])


def search_shard(query: np.ndarray, own: int, rows: np.ndarray, ids: np.ndarray, named: np.ndarray, terms: np.ndarray, least: np.ndarray, most: np.ndarray, k: int, known: float = -np.inf) -> list[tuple[int, int | None]]:
    """The k best (score, id) of a shard for one query, of those that score at least ``known``. terms: dimension by vector; least, most:
    the values' bounds."""
    a, b = query * least, query * most
    low, spread = np.minimum(a, b), np.abs(a - b)
    order = np.argsort(-spread, kind="stable")
    rest = np.concatenate([np.cumsum(spread[order][::-1])[::-1], [0]])  # what terms from the i-th on can add to their least
    floor = float(low.sum())
    mine = rows == own
    n = terms.shape[1]
    if n - int(mine.sum()) <= 0:
        return []
    # a threshold: the k-th of the vectors that a few strong terms favour
    head = order[:STEP]
    partial = query[head].astype(terms.dtype) @ terms[head]
    partial[mine] = -np.inf
    seeds = np.argpartition(-partial, SEEDS)[:SEEDS] if n > SEEDS else np.arange(n)
    exact = query.astype(terms.dtype) @ terms[:, seeds]
    exact = np.sort(exact[~mine[seeds]])
    limit = max(known, float(exact[-k]) if len(exact) >= k else -np.inf)
    # essential: the fewest terms without which no vector reaches the threshold
    essential = int(np.searchsorted(-(floor + rest), -limit, side="left"))
    essential = min(len(order), max(STEP, essential))
    if essential > STEP:
        partial += query[order[STEP:essential]].astype(terms.dtype) @ terms[order[STEP:essential]]
    done = max(essential, min(STEP, len(order)))
    bound = float(low[order[done:]].sum()) + float(rest[done])
    alive = np.flatnonzero(partial + bound >= limit)
    partial = partial[alive]
    while done < len(order) and len(alive):
        probed = order[done : done + STEP]
        partial = partial + query[probed].astype(terms.dtype) @ terms[np.ix_(probed, alive)]
        done += len(probed)
        bound = float(low[order[done:]].sum()) + float(rest[done])
        keep = partial + bound >= limit
        alive, partial = alive[keep], partial[keep]
    keep = ~mine[alive]
    alive, partial = alive[keep], partial[keep]
    best = np.lexsort((ids[alive], ~named[alive], -partial))[:k]
    return [(int(partial[i]), int(ids[alive[i]]) if named[alive[i]] else None) for i in best]


def _search(block: dict, k: int):  # noqa: ANN202
    """The k best (q_row, query_id, score, vec_id) of each query of the block among a task's packed shards."""
    schema = pa.schema([("q_row", pa.int64()), ("query_id", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_rows, q_ids, _, asked = _unpack(block.value)
        best: list[list[tuple[int, int | None]]] = [[] for _ in q_rows]
        for batch in batches:
            for i in range(batch.num_rows):  # one shard at a time
                rows, ids, named, cells = _unpack(batch.slice(i, 1).to_pylist()[0])
                dims = max(len(cells), len(asked))
                cells, queries = (np.pad(x, ((0, dims - len(x)), (0, 0))) for x in (cells, asked))
                reach = int(np.abs(cells).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, dims)
                if reach >= 1 << 53:
                    raise OverflowError("inner products exceed 2^53")
                terms = np.ascontiguousarray(cells.astype(np.float32 if reach < 1 << 24 else np.float64))
                least, most = cells.min(axis=1, initial=0), cells.max(axis=1, initial=0)
                for q in range(queries.shape[1]):
                    known = best[q][-1][0] if len(best[q]) == k else -np.inf
                    hits = search_shard(queries[:, q], int(q_rows[q]), rows, ids, named, terms, least, most, k, known)
                    best[q] = sorted(best[q] + hits, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        found = [(int(q_rows[q]), int(q_ids[q]), *hit) for q, hits in enumerate(best) for hit in hits]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    return run


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row that is_query holds for (a column of ``id``)."""
    context = vectors.sparkSession.sparkContext
    rows = stored(quantised(vectors, id_col, vector_col, scale))  # positions may differ from scan to scan
    shards = stored(rows.mapInArrow(_pack_shards, _PACKED), "none")
    wanted = rows.where(is_query & F.col("id").isNotNull())
    blocks = max(1, -(-wanted.count() // (BLOCK // 2)))  # dealt by hash, so a block holds about half of what it may
    named = wanted.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), "row", "id", "vec")
    queries = stored(named.repartition(min(blocks, 4096), "block").sortWithinPartitions("block"))
    found, waiting = None, []
    for i in range(blocks):
        own = queries.where(F.col("block") == i).select("row", "id", "vec").toArrow()
        for at in range(0, own.num_rows, BLOCK):
            part = own.slice(at, BLOCK).combine_chunks().to_batches()[0]
            waiting.append(shards.mapInArrow(_search(context.broadcast(_pack(part)), k), "q_row bigint, query_id bigint, score bigint, vec_id bigint"))
        if len(waiting) >= BLOCKS or i == blocks - 1 and waiting:
            some = checkpoint(reduce(DataFrame.unionByName, waiting))
            found, waiting = some if found is None else found.unionByName(some), []
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "q_row bigint, query_id bigint, score bigint, vec_id bigint")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
