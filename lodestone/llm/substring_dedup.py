"""Substring deduplication by super-k-mer partitioning.

Words are runs of bytes other than ASCII white space; a window is WINDOW consecutive words of a
document. Every word that a window covers whose words also start earlier (at a smaller document
id, or earlier in the same document) is removed; windows are judged on the input.

A window's minimiser is the least hash of its runs of MINIMISER words. Consecutive windows that
share a minimiser make a super-k-mer, which travels as one packed string, 64 bits of hash for each
window, to its minimiser's bucket, so equal windows always meet. In the bucket its windows are sorted; of
equal ones (by 128 bits: the minimiser's and their own), the least position is the first
occurrence, and all others count as repeats.

* Only super-k-mers whose minimiser occurs twice or more in the corpus can hold a repeated window.
  A first pass counts minimisers exactly: each task sends the distinct ones of a chunk, eight bytes
  each, with a mark on those that it saw twice, so no minimiser is hot. Of those that repeat, a filter is made, if it
  stays below a fixed size; without it, all super-k-mers go on. Nothing that repeats is lost.
* Equal super-k-mers are merged before they reach a bucket, with map-side aggregation: each
  distinct packed string enters once, at its first position. Its other occurrences repeat as a
  whole. So a passage that thousands share costs one string in a bucket.
* Minimisers of more than HOT distinct strings, a fixed number, would make hot buckets. Their super-k-mers are cut into single
  windows, which the same aggregation counts, dealt by the whole window.

Repeats come back as word intervals by document and are applied to the texts in one join.

Null texts have no words; texts of any length are read whole. Null ids are smaller than all others. Rows that share an id are judged
by (id, start) alone, so a repeated row repeats nothing by itself; rows of one id with different
texts are told apart by the hash of their text. Only the two named columns are read, and clashing names of others do no harm.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import CellFilter, asked, broadcast_if_small, checkpoint, fresh, join_totals, released, stored
from lodestone.llm.words import blocks, mixed, runs_of

WINDOW = 20
MINIMISER = 5
#: Windows of a super-k-mer at most, so that packed strings stay short; longer runs are cut.
RUN = 64
#: Distinct strings of a bucket at most.
HOT = 4096
#: Minimisers, and strings, that a task holds at once.
CHUNK = 1 << 20
STRINGS = 1 << 16
_SEED = 0xD6E8FEB86659FD93


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def minimisers(values: np.ndarray, width: int = WINDOW - MINIMISER + 1) -> np.ndarray:
    """The least hash of each window of ``width`` hashes."""
    have = 1
    while have < width:  # minima over 1, 2, 4, ... and at last width values
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def super_kmers(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimisers, first words, numbers of windows, whether one may repeat within) of the super-k-mers of a block's texts."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    keys = mixed(runs_of(hashes, MINIMISER))
    values = minimisers(keys)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = text[: len(values)] == text[WINDOW - 1 :]  # windows that don't cross texts
    edge = np.ones(len(values) + 1, bool)
    edge[1:-1] = (values[1:] != values[:-1]) | (text[1 : len(values)] != text[: len(values) - 1]) | (whole[1:] != whole[:-1])
    edges = np.flatnonzero(edge)
    starts, lengths = edges[:-1], np.diff(edges)
    starts, lengths = starts[whole[starts]], lengths[whole[starts]]
    if len(lengths) and int(lengths.max()) > RUN:
        parts = -(-lengths // RUN)
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, lengths = np.repeat(starts, parts) + nth * RUN, np.minimum(RUN, np.repeat(lengths, parts) - nth * RUN)
    own = values[starts]
    # where its minimiser stands first; equal windows of one run have it at different places
    at = starts.copy()
    for k in range(WINDOW - MINIMISER, -1, -1):
        at = np.where(keys[starts + k] == own, starts + k, at)
    return own, starts, lengths, starts + lengths - 1 > at


def _minimiser_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(m, twice): the minimisers of a chunk, and whether it holds them twice."""
    held, size = [], 0

    def rows() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts > 1)], names=["m", "twice"])

    for batch in batches:
        for _, _, hashes, bounds in blocks(batch.column(0)):
            own, _, _, inner = super_kmers(hashes, bounds)
            held += [own, own[inner]]  # a run that may repeat within itself counts twice
            size += len(own)
            if size >= CHUNK:
                yield rows()
                held, size = [], 0
    if size:
        yield rows()


def _packed(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary values of the given numbers of 64-bit words."""
    ends = np.concatenate([[0], np.cumsum(lengths * 8)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])


def _gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return values[np.arange(int(ends[-1])) + np.repeat(starts - ends + lengths, lengths)]


def _super_kmers(docs: DataFrame, seen: CellFilter | None) -> DataFrame:
    """(m, windows, id, h, start): the super-k-mers that may repeat."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            for first, _, hashes, bounds in blocks(batch.column(2)):
                own, starts, lengths, _ = super_kmers(hashes, bounds)
                if cells is not None and len(own):
                    keep = cells.maybe_repeated(own)
                    own, starts, lengths = own[keep], starts[keep], lengths[keep]
                if len(own):
                    windows = mixed(runs_of(hashes, WINDOW, _SEED))
                    owner = np.searchsorted(bounds, starts, "right") - 1
                    rows = pa.array(owner + first)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.view(np.int64)), _packed(_gathered(windows, starts, lengths), lengths), batch.column(0).take(rows), batch.column(1).take(rows), pa.array((starts - bounds[owner]).astype(np.int64))],
                        names=["m", "windows", "id", "h", "start"],
                    )

    return docs.mapInArrow(run, "m bigint, windows binary, id bigint, h bigint, start bigint")


def _cut(rows: DataFrame) -> DataFrame:
    """Super-k-mers (m, windows, id, h, start), cut into single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                own = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column(1)]
                lengths = np.array([len(x) for x in own])
                owner = np.repeat(np.arange(len(own)), lengths)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                flat, take = np.concatenate(own), pa.array(owner)
                begins = part.column(4).to_numpy()[owner] + nth
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), _packed(flat, np.ones(len(flat), np.int64)), part.column(2).take(take), part.column(3).take(take), pa.array(begins)], names=["m", "windows", "id", "h", "start"])

    return rows.select("m", "windows", "id", "h", "start").mapInArrow(run, "m bigint, windows binary, id bigint, h bigint, start bigint")


_FIRST = pa.schema([("key", pa.binary()), ("first_id", pa.int64()), ("first_start", pa.int64()), ("times", pa.int64()), ("marks", pa.binary())])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of strings (m, key, windows, first_id, first_start, times) in order of m, those that repeat (key, first_id, first_start, times, marks):
    as a whole, or by windows that are marked with a byte each. Whole buckets are sorted together, some STRINGS strings at a time."""

    def settle(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        m, ids = part.column("m").to_numpy(), part.column("first_id").combine_chunks()
        known, name = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        start, times = part.column("first_start").to_numpy(), part.column("times").to_numpy()
        own = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("windows")]
        lengths = np.array([len(x) for x in own])
        owner, windows = np.repeat(np.arange(len(own)), lengths), np.concatenate(own)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = start[owner] + nth
        order = np.lexsort((at, name[owner], known[owner], windows, m[owner]))
        o, w = owner[order], windows[order]
        fresh_ = np.ones(len(order), bool)
        fresh_[1:] = (w[1:] != w[:-1]) | (m[o[1:]] != m[o[:-1]])
        lead = np.flatnonzero(fresh_)[np.cumsum(fresh_) - 1]  # its group's first
        l, a = o[lead], at[order]
        marks = np.zeros(len(order), np.uint8)
        marks[order] = (known[o] != known[l]) | (name[o] != name[l]) | (a != a[lead])
        some = np.bincount(owner, marks, len(own)) > 0
        rows = np.flatnonzero(some | (times > 1))
        begins = np.cumsum(lengths) - lengths
        listed = [marks[begins[i] : begins[i] + lengths[i]].tobytes() if some[i] else None for i in rows.tolist()]
        kept = part.take(pa.array(rows))
        return pa.RecordBatch.from_arrays([kept.column(c).combine_chunks() for c in ("key", "first_id", "first_start", "times")] + [pa.array(listed, pa.binary())], schema=_FIRST)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= STRINGS:
            every = pa.Table.from_batches(held).combine_chunks()
            m = every.column("m").to_numpy()
            last = int(np.searchsorted(m, m[-1]))  # the last bucket may go on
            if last:
                yield settle(every.slice(0, last))
                held = every.slice(last).to_batches()
                size = every.num_rows - last
    if held:
        yield settle(pa.Table.from_batches(held).combine_chunks())


def _key():  # noqa: ANN202
    """What stands for a packed string where its windows aren't needed: 128 bits of hash."""
    return F.unhex(F.md5(F.concat(F.col("m").cast("string").cast("binary"), F.col("windows"))))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, begin, end): word intervals to remove, h being the text's hash."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    counted = rows.select("text").mapInArrow(_minimiser_rows, "m bigint, twice boolean").groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.bool_or("twice").alias("twice"))
    again = stored(counted.where("n > 1 OR twice").select("m"), "none")
    found = stored(_super_kmers(rows, CellFilter.members(again, again.count())).withColumn("key", _key()))
    released(again)
    # each distinct string once, with its first position
    first = F.min(F.struct("id", "start")).alias("first")
    merged = found.groupBy("key").agg(first, F.count(F.lit(1)).alias("times"), F.first("m").alias("m"), F.first("windows").alias("windows"))
    strings = stored(merged.select("m", "key", "windows", F.col("first.id").alias("first_id"), F.col("first.start").alias("first_start"), "times"), "none")
    hot = checkpoint(strings.groupBy("m").agg(F.count(F.lit(1)).alias("strings")).where(F.col("strings") > HOT).select("m"))
    any_hot, hot = bool(hot.limit(1).count()), broadcast_if_small(hot)
    mild = strings.join(hot, "m", "left_anti") if any_hot else strings
    firsts = mild.repartition("m").sortWithinPartitions("m").mapInArrow(_settle, "key binary, first_id bigint, first_start bigint, times bigint, marks binary")
    n = (F.length("windows") / 8).cast("int").alias("n")
    kept = (found.join(hot, "m", "left_anti") if any_hot else found).select("key", "id", "h", "start", n)
    if any_hot:
        cut = stored(_cut(found.join(hot, "m", "left_semi")).withColumn("key", _key()).drop("windows", "m"))
        windows = cut.groupBy("key").agg(first, F.count(F.lit(1)).alias("times")).where("times > 1")
        firsts = firsts.unionByName(windows.select("key", F.col("first.id").alias("first_id"), F.col("first.start").alias("first_start"), "times", F.lit(None).cast("binary").alias("marks")))
        kept = kept.unionByName(cut.select("key", "id", "h", "start", F.lit(1).alias("n")))
    firsts = checkpoint(firsts)
    released(strings)
    joined = join_totals(kept, "key", firsts, "times")
    is_first = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("start") == F.col("first_start"))
    # the first occurrence loses its marked windows, every other one all
    whole = F.when(~is_first, F.array(F.struct(F.col("start").alias("begin"), (F.col("start") + F.col("n") + WINDOW - 1).alias("end"))))
    own = joined.select("id", "h", "start", F.when(is_first, F.col("marks")).alias("marks"), whole.alias("whole")).where("marks IS NOT NULL OR whole IS NOT NULL")
    return own.mapInArrow(_spans, "id bigint, h bigint, begin bigint, end bigint")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, begins, ends = [], [], []
        for i, (start, marks, whole) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
            found = [(s["begin"], s["end"]) for s in whole or ()]
            if marks is not None:
                edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(marks, np.uint8), [0]])))
                found += [(start + a, start + b + WINDOW - 1) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
            owner += [i] * len(found)
            begins += [x[0] for x in found]
            ends += [x[1] for x in found]
        at = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], names=["id", "h", "begin", "end"])


def _gone(n: int, spans: list) -> np.ndarray:
    """Which of n words the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    for s in spans or ():
        steps[min(s["begin"], n)] += 1
        steps[min(s["end"], n)] -= 1
    return np.cumsum(steps[:n]) > 0


def _with_spans(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """docs with the intervals to remove in a column of the returned name, null where there are none.
    Only rows that a filter can't tell from documents with intervals are shuffled."""
    key_id, key_h, spans, own, name = fresh(docs, "span_id", "span_h", "spans", "text_hash", "span_name")
    found = repeats(docs, id_col, text_col).groupBy(F.col("id").alias(key_id), F.col("h").alias(key_h)).agg(F.collect_set(F.struct("begin", "end")).alias(spans))
    found = stored(found)
    seen = CellFilter.members(found.select(F.xxhash64(key_id, key_h).alias("name")), found.count())
    hashed = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).withColumn(name, F.xxhash64(F.col(id_col).cast("bigint"), F.col(own)))
    on = F.col(id_col).cast("bigint").eqNullSafe(F.col(key_id)) & (F.col(own) == F.col(key_h))
    if seen is None:  # too many for a filter
        return hashed.join(found, on, "left").drop(key_id, key_h, own, name), spans
    maybe = asked(docs.sparkSession, seen)
    joined = hashed.where(maybe(name)).join(found, on, "left").drop(key_id, key_h)
    rest = hashed.where(~maybe(name)).withColumn(spans, F.lit(None).cast(found.schema[spans].dataType))
    return joined.unionByName(rest).drop(own, name), spans


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each row."""
    joined, spans = _with_spans(docs.select(id_col, text_col), id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, hashes = [], [], []
            for text, own in zip(batch.column(1), batch.column(2), strict=True):
                words, gone = split(text.as_py()), own.as_py()
                counts.append(len(words))
                if gone:
                    out = _gone(len(words), gone)
                    words = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                removed.append(counts[-1] - len(words))
                hashes.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes)], names=["id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.select(F.col(id_col), F.col(text_col).cast("string"), spans).mapInArrow(run, f"id {kind}, n_words bigint, n_removed bigint, kept_sha256 string").withColumnRenamed("id", id_col)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the kept words, joined by one space, as texts; texts that lose nothing stay as they are."""
    joined, spans = _with_spans(docs, id_col, text_col)

    @F.arrow_udf("string")
    def kept(text: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for t, g in zip(text, gone, strict=True):
            words = split(t.as_py())
            out.append(b" ".join(w for w, x in zip(words, _gone(len(words), g.as_py()).tolist(), strict=True) if not x).decode())
        return pa.array(out, pa.string())

    changed = F.when(F.col(spans).isNotNull(), kept(F.col(text_col), F.col(spans))).otherwise(F.col(text_col))
    return joined.withColumn(text_col, changed).select(*docs.columns)
