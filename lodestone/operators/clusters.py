"""Near-duplicate clusters of records by the exact Jaccard similarity of their token shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import hashing
from lodestone.operators.graph import components
from lodestone.operators.retrieval import _cut

SHINGLE, THRESHOLD = 3, 0.85
#: Cells of the filters that pick the sets and records of pairs, a power of two.
CELLS = 1 << 20
#: Sets of classes with fewer items meet by their first items, others by parts.
SMALL = 24
#: Bits of a set's sketch.
BITS = 256
#: Records that a task takes out of a batch at a time.
SLICE = 128
#: Fixed value: what a token is.
TOKEN = r"[a-z0-9]+|[㐀-䶿一-鿿]"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache
def _classes(most: int, threshold: float, small: int) -> list[tuple[int, int, int]]:
    """(least, hi, parts) of the classes of sizes up to ``most``. A class holds pairs by their larger set, of hi items at most; the smaller one has ``least`` at least.
    parts: how many its sets' items are dealt to (0: none), more than two such sets can differ in, and enough for sets of any size to have as many of two items or more."""
    per, out, lo = (1 - threshold) / (1 + threshold), [], 1
    while lo * threshold <= most:
        hi, least = max(lo, ceil(lo * max(1.5, 1 / threshold)) - 1), ceil(threshold * lo - 1e-9)
        differ, best, parts = floor(2 * per * hi + 1e-9), -1e9, 0
        for m in range(differ + 1, 2 * differ + 8) if hi >= small else ():
            margins = []
            for n in (least, lo, hi):
                thin = (1 - 1 / m) ** n + n / m * (1 - 1 / m) ** (n - 1)
                asked = floor(per * (n + min(hi, n / threshold)) + 1e-9) + 1
                margins.append((m * (1 - thin) - asked) / sqrt(m * thin * (1 - thin) + 1e-9))
            if min(margins) > best:
                best, parts = min(margins), m
            if best >= 3:
                break
        out.append((least, hi, parts))
        lo = hi + 1
    return out


def _keys(sizes: np.ndarray, items: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(set, key): 64-bit keys, of which any two sets at the threshold share one. items: hashes of the sets' items one set after another, ascending in each.

    Hashes deal a set's items to parts. Two such sets differ in at most (1 - threshold) / (1 + threshold) of both sizes, and each item that they differ in
    lies in one part. So of the first parts of a set that hold two items or more, one more than that, one is the same in the other set. Sets that are only alike in frequent
    items hardly ever have such a part in common. Where both have too few, as very small sets do, they share one of their first n - ceil(threshold * n) + 1 items."""
    per = (1 - threshold) / (1 + threshold)
    at = np.repeat(np.arange(len(sizes)), sizes)
    head = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes) <= (sizes - np.ceil(sizes * threshold - 1e-9))[at]
    sets, keys = [at[:0]], [items[:0]]
    for number, (least, hi, parts) in enumerate(_classes(1 << int(sizes.max(initial=0)).bit_length(), threshold, SMALL)):
        few = (sizes >= least) & (sizes <= hi)
        if not few.any():
            continue
        if parts:
            where = np.flatnonzero(few[at])
            part = (_mixed(items[where] + np.uint64(number)) % np.uint64(parts)).astype(np.int64)
            cell = at[where] * parts + part
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
            full = np.diff(starts, append=len(order)) > 1
            own, told = np.divmod(cell[order[starts[full]]], parts)
            held = np.bincount(own, minlength=len(sizes))
            asked = np.floor(per * (sizes + np.minimum(hi, sizes / threshold)) + 1e-9).astype(np.int64) + 1
            kept = np.arange(len(own)) - np.repeat(np.cumsum(held) - held, held) < asked[own]
            sums = np.add.reduceat(_mixed(items[where[order]]), starts)[full][kept]
            sets.append(own[kept])
            keys.append(_mixed(sums + _mixed(told[kept].astype(np.uint64) * np.uint64(64) + np.uint64(number))))
            few &= held < asked
        shown = np.flatnonzero(head & few[at])
        sets.append(at[shown])
        keys.append(_mixed(items[shown] + _mixed(np.full(1, number, np.uint64))))
    return np.concatenate(sets), np.concatenate(keys).view(np.int64)


def _distinct(at: np.ndarray, values: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, values) of the distinct values of each of ``many`` rows, ascending."""
    order = np.lexsort((values, at))
    at, values = at[order], values[order]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (values[1:] != values[:-1])
    return np.bincount(at[new], minlength=many), values[new]


def _sketches(sizes: np.ndarray, items: np.ndarray) -> list[pa.Array]:
    """BITS bits of each set, as columns of 64: whether an even or odd number of its items falls on each. Two sets differ in no fewer items than bits."""
    at = np.repeat(np.arange(len(sizes)), sizes)
    odd = np.bincount(at * BITS + (_mixed(items) % np.uint64(BITS)).astype(np.int64), minlength=len(sizes) * BITS) & 1
    words = np.packbits(odd.astype(np.uint8).reshape(-1, BITS), axis=1).view(np.int64)
    return [pa.array(np.ascontiguousarray(words[:, i])) for i in range(words.shape[1])]


def _lists(sizes: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values.astype(np.int64)))


def _shingled(salts: np.ndarray, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, hashes): the distinct runs of SHINGLE tokens of each record, or its only run, as hashes with the record's salt."""
    sizes = np.diff(tokens.offsets.to_numpy()).astype(np.int64)
    values = tokens.flatten().to_numpy().view(np.uint64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    length = np.minimum(sizes, SHINGLE)[at]
    begins = np.flatnonzero(place <= sizes[at] - length)
    run = _mixed(salts[at[begins]] + length[begins].astype(np.uint64))
    for k in range(SHINGLE):
        there = length[begins] > k
        run[there] = _mixed(run[there] * np.uint64(0x9E3779B97F4A7C15) + values[begins[there] + k])
    return _distinct(at[begins], run, len(sizes))


def near_pairs(sets: DataFrame, groups: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, similarity), a < b, of the sets (node, groups..., items) of one group at the threshold or above. Empty sets, and groups with a null, are left out.

    Each set finds keys by itself, of which similar sets share one (_keys). Nodes alone are shuffled by them, and the pairs that they find are compared in full."""
    whole = sets.where(F.size("items") > 0).dropna(subset=groups) if groups else sets.where(F.size("items") > 0)
    rows = whole.select("node", F.transform("items", lambda x: F.xxhash64(*groups, x)).alias("hashes"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, len(batch), SLICE)):
                lists = part.column(1)
                sizes = lists.value_lengths().to_numpy().astype(np.int64)
                own, keys = _keys(*_distinct(np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy().view(np.uint64), len(sizes)), threshold)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(own)), pa.array(sizes[own]), pa.array(keys)], names=["node", "n", "key"])

    met = _met(rows.mapInArrow(keyed, f"node {sets.schema['node'].dataType.simpleString()}, n bigint, key bigint"), "node")
    pairs = _cut(_crossed(met, "node", threshold, []))
    cells = _cells(pairs.select(F.explode(F.array("a", "b")).alias("node")).select(F.xxhash64("node")))
    return _compared(pairs, _cut(_in_cells(whole, F.xxhash64("node"), cells)), groups, threshold)


def _met(keyed: DataFrame, by: str) -> DataFrame:
    """The rows (key, node, ...) of keys that rows of different ``by`` have."""
    of = Window.partitionBy("key")
    found = keyed.withColumns({"_low": F.min(by).over(of), "_high": F.max(by).over(of)}).where("_low <> _high")
    return _cut(found.drop("_high"))


def _crossed(met: DataFrame, by: str, threshold: float, sketches: list[str]) -> DataFrame:
    """(a, b), a < b: the nodes of one key that differ in ``by`` and aren't too different in size n and sketch."""
    rows = met.select("key", "node", F.col(by).alias("of"), "n", *sketches).distinct()
    other = rows.select("key", F.col("node").alias("b"), F.col("of").alias("of_b"), F.col("n").alias("n_b"), *(F.col(c).alias(c + "_b") for c in sketches))
    pairs = rows.withColumnRenamed("node", "a").join(other, "key").where("a < b AND of <> of_b").where(_alike(threshold, sketches))
    return pairs.select("a", "b").distinct()


def _alike(threshold: float, sketches: list[str]) -> Column:
    """Whether the sizes n and n_b and the sketches of two sets let them be similar."""
    fits = F.least("n", "n_b") >= F.greatest("n", "n_b") * (threshold - 1e-9)
    if not sketches:
        return fits
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(c + "_b"))) for c in sketches[1:]), F.bit_count(F.col(sketches[0]).bitwiseXOR(F.col(sketches[0] + "_b"))))
    return fits & (differ <= (F.col("n") + F.col("n_b")) * ((1 - threshold) / (1 + threshold)) + 1e-6)


def _cells(hashes: DataFrame) -> DataFrame:
    """The cells of 64-bit hashes, at most CELLS of them."""
    return hashes.select(F.col(hashes.columns[0]).bitwiseAND(CELLS - 1).alias("cell")).distinct()


def _in_cells(rows: DataFrame, hashed: Column, cells: DataFrame) -> DataFrame:
    """The rows whose hash lies in the cells, where they lie."""
    return rows.withColumn("cell", hashed.bitwiseAND(CELLS - 1)).join(F.broadcast(cells), "cell", "left_semi").drop("cell")


def _compared(pairs: DataFrame, sets: DataFrame, groups: list[str], threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) of sets (node, groups..., items) of one group at the threshold or above."""
    left, right = (sets.select(F.col("node").alias(x), F.col("items").alias("of_" + x), F.struct(F.lit(0), *groups).alias("in_" + x)) for x in "ab")
    found = pairs.join(left, "a").join(right, "b").where(F.col("in_a") == F.col("in_b"))
    found = found.where(F.least(F.size("of_a"), F.size("of_b")) >= F.greatest(F.size("of_a"), F.size("of_b")) * (threshold - 1e-9))
    shared_items = F.size(F.array_intersect("of_a", "of_b"))
    return found.select("a", "b", (shared_items / (F.size("of_a") + F.size("of_b") - shared_items)).alias("similarity")).where(F.col("similarity") >= threshold)


def clusters(records: DataFrame, key: str, text: Column, groups: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """(key, cluster, size): records that are similar within a group, directly or through others. A cluster's name is the hash of its sorted
    keys. Records with the same shingles are one node, so copies are never compared; records without tokens are one node of their group. Shingles are 64-bit
    hashes, since they themselves are three times the texts.

    Texts are cut into shingles where they lie, once to find each record's node and keys, and once for one record of each node that a key pairs with others. Each key's
    least node meets the others first; of all other pairs those alone are compared whose nodes aren't linked by then, so many near copies don't become all pairs."""
    told = F.to_json(F.struct(*groups)) if groups else F.lit("")
    base = records.select(F.col(key).cast("string").alias("id"), *groups, F.xxhash64(told).alias("salt"), text.alias("_text"))
    tokens = F.coalesce(F.transform(F.regexp_extract_all(F.lower("_text"), F.lit(TOKEN), 0), lambda t: F.xxhash64(t)), F.array().cast("array<bigint>"))

    def sets(batches: Iterator[pa.RecordBatch], keyed: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, len(batch), SLICE)):
                salts = part.column("salt").to_numpy().view(np.uint64)
                sizes, items = _shingled(salts, part.column("tokens"))
                node = _mixed(salts + sizes.astype(np.uint64))
                held = np.flatnonzero(sizes)
                if len(held):
                    starts = (np.cumsum(sizes) - sizes)[held]
                    node[held] = _mixed(node[held] + np.add.reduceat(_mixed(items), starts) * np.uint64(3) + np.bitwise_xor.reduceat(_mixed(~items), starts))
                made = [part.column(c) for c in part.schema.names[:-2]] + [pa.array(node.view(np.int64))]
                if keyed:
                    made += [pa.array(sizes), *_sketches(sizes, items)]
                    own, keys = _keys(sizes, items, threshold)
                    order = np.argsort(own, kind="stable")
                    sizes, items = np.bincount(own, minlength=len(sizes)), keys[order]
                yield pa.RecordBatch.from_arrays([*made, _lists(sizes, items)], names=[*part.schema.names[:-2], "node", *(["n", *sketches] if keyed else []), "items"])

    kinds, sketches = "".join(f"`{c}` {base.schema[c].dataType.simpleString()}, " for c in groups), [f"_{i}" for i in range(BITS // 64)]
    made = _cut(base.select("id", "salt", tokens.alias("tokens")).mapInArrow(lambda batches: sets(batches, True), f"id string, node bigint, n bigint, {''.join(f'{c} bigint, ' for c in sketches)}items array<bigint>"))
    member, nodes = made.select("id", "node"), made.select("node", "n", *sketches).dropDuplicates(["node"])
    met = _met(made.select("node", F.explode("items").alias("key")), "node")
    firsts = met.where("node <> _low").select(F.col("_low").alias("a"), F.col("node").alias("b")).distinct()
    told = nodes.select(F.col("node").alias("b"), *(F.col(c).alias(c + "_b") for c in ("n", *sketches)))
    near = _cut(firsts.join(nodes.withColumnRenamed("node", "a"), "a").join(told, "b").where(_alike(threshold, sketches)).select("a", "b"))

    def compared(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        some = member.join(both, "node").groupBy("node").agg(F.min(F.xxhash64("id")).alias("h"))
        rows = _in_cells(base, F.xxhash64("id"), _cells(some.select("h")))
        rows = rows.dropna(subset=groups) if groups else rows
        found = rows.select(*groups, "salt", tokens.alias("tokens")).mapInArrow(lambda batches: sets(batches, False), f"{kinds}node bigint, items array<bigint>")
        return _compared(pairs, _cut(found.join(both, "node").dropDuplicates(["node"])), groups, threshold).select("a", "b")

    links = _cut(compared(near))
    names = components(links)
    named = _met(met.select("key", "node").join(names, "node", "left").select("key", "node", F.coalesce("name", "node").alias("name")), "name")
    rest = _cut(_crossed(named.join(nodes, "node"), "name", threshold, sketches).join(near, ["a", "b"], "left_anti"))
    names = components(links.unionByName(compared(rest)))
    found = member.join(names, "node", "left").select("id", F.coalesce("name", "node").alias("name"))
    # a cluster's keys are streamed through one hash, however many they are
    whole = hashing.streamed_digest(found, "name", "id", "id", head='["', glue='","', tail='"]').withColumnRenamed("n", "size")
    return found.join(whole, "name").select(F.col("id").alias(key), F.concat(F.lit("cluster:"), "fingerprint").alias("cluster"), "size")
