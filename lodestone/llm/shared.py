"""Helpers that several training-data operators use: table access, shared-folder
materialisation, size-checked broadcasts and the saturating cell filter."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a DataFrame may have at most to be broadcast; beyond it, operators shuffle.
BROADCAST_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER_TABLE = {ord(a): b for a, b in zip(UPPER, LOWER, strict=True)}
_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: str) -> str:
    """Lower-cases A-Z only."""
    return text.lower() if text.isascii() else text.translate(_LOWER_TABLE)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with the given ones that clash with none of df's (case-insensitively)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir. Where that is unset, a local session gets a folder of its own; on a
    cluster it is an error, since no machine's folder is shared."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    where = context.getConf().get("spark.checkpoint.dir") or (known.get() if known.isDefined() else "")
    if not where:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = "/tmp/lodestone-checkpoint"
        context.setCheckpointDir(where)
    return where


def checkpoint(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and cut from its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, codec: str = "zstd", by: str | None = None) -> DataFrame:
    """df as a compressed Parquet table in the shared folder, in folders ``by`` a column's values if named. It is deleted
    by ``released``, at the latest when the driver's Python ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodestone-{uuid.uuid4().hex}"
    writer = df.write.option("compression", codec)
    (writer.partitionBy(by) if by else writer).parquet(path)
    if not _written:
        atexit.register(_delete_written)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._lodestone_path = path
    return out


def released(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing will read again."""
    for df in tables:
        path = getattr(df, "_lodestone_path", None)
        if path and (df.sparkSession, path) in _written:
            _written.remove((df.sparkSession, path))
            _delete(df.sparkSession, path)


class Leftovers:
    """What a step stored on its way to a result, which is deleted once the result is written elsewhere."""

    def __init__(self) -> None:
        self.tables: list[tuple[SparkSession, str]] = []

    def delete(self) -> None:
        for spark, path in self.tables:
            if (spark, path) in _written:
                _written.remove((spark, path))
                _delete(spark, path)
        self.tables = []

    def of(self, step: Callable[[], DataFrame]) -> DataFrame:
        """The step's result; what it stores is kept for ``delete``."""
        before = set(_written)
        out = step()
        self.tables += [x for x in _written if x not in before]
        return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _delete_written() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the JVM may be gone already  # noqa: BLE001, S112
            continue


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a count shows that it has at most ``rows`` rows, else df: the join then shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_totals(rows: DataFrame, key: str, totals: DataFrame, size: str, share: int = 1000) -> DataFrame:
    """rows joined with the totals of their groups by ``key``. Groups of at least 1/share of the rows, of
    which there are at most ``share``, are joined by broadcast; the others, none of them hot, by shuffle."""
    heavy = max(2, (totals.agg(F.sum(size)).first()[0] or 0) // share)
    many, few = F.broadcast(totals.where(F.col(size) >= heavy)), totals.where(F.col(size) < heavy)
    return rows.join(many, key).unionByName(rows.join(few, key))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def partition_rows(df: DataFrame) -> int:
    """Rows of df; only a Parquet scan's footers are read where df is a plain scan."""
    return df.select(F.lit(1)).count()


class CellFilter:
    """Cells of two saturating bits over 64-bit hashes, of which only "hit at least twice" is kept.

    A hash sets PROBES cells; ``maybe_repeated`` is true for every hash that was added twice or
    more, and for a few others (the cells are shared, so there are false positives but no false
    negatives). A filter has 16 cells for each of its items, and at most MAX_CELLS / 16 items, so what
    is broadcast never exceeds MAX_CELLS / 8 bytes (32 MiB). More items are dealt to several filters by
    ranges of their hash (``split_repeated``), one after the other, so that none ever fills up.

    ``members`` makes a filter of what was added at all, or none if it would exceed MAX_MEMBERS cells.
    """

    PROBES = 2
    MAX_CELLS = 1 << 28
    MAX_MEMBERS = 1 << 30
    SEGMENT = 1 << 20

    def __init__(self, cells: int, segments: dict[int, bytes]) -> None:
        self.cells = cells
        bits = np.zeros(cells // 8, np.uint8)
        for k, data in segments.items():
            bits[k * self.SEGMENT // 8 : (k + 1) * self.SEGMENT // 8] = np.frombuffer(data, np.uint8)
        self.bits = bits

    @staticmethod
    def cells_for(items: int, each: int = 16) -> int:
        return max(CellFilter.SEGMENT, 1 << (each * max(1, items) - 1).bit_length())

    @classmethod
    def ranges_for(cls, items: int) -> int:
        """How many filters so many items are dealt to."""
        return max(1, -(-cls.cells_for(items) // cls.MAX_CELLS))

    @staticmethod
    def positions(hashes: np.ndarray, cells: int) -> list[np.ndarray]:
        """The cells of each hash, one array for each probe."""
        h = hashes.view(np.uint64) if hashes.dtype != np.uint64 else hashes
        return [((h * np.uint64(m)) >> np.uint64(64 - cells.bit_length() + 1)).astype(np.int64) for m in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]

    def maybe_repeated(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self.positions(hashes, self.cells):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out

    @classmethod
    def members(cls, hashes: DataFrame, items: int) -> CellFilter | None:
        """A filter whose ``maybe_repeated`` is true for all of the hashes and for at most some 5 % of others."""
        cells = cls.cells_for(items, 8)
        return None if cells > cls.MAX_MEMBERS else cls.build(hashes, items, 1, cells)

    @classmethod
    def build(cls, hashes: DataFrame, items: int, times: int = 2, cells: int | None = None) -> CellFilter:
        """First pass over the single bigint column of ``hashes``: each task sends the cells that its
        hashes hit, by segment of the cells; a segment's cells are merged in one task each."""
        cells = cells or cls.cells_for(items)
        size, segment = cells, cls.SEGMENT

        def flush(chunks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if not chunks:
                return
            values, counts = np.unique(np.concatenate(chunks), return_counts=True)
            at = np.concatenate(cls.positions(values, size))
            many = np.concatenate([counts > 1] * cls.PROBES)
            cell, inverse = np.unique(at, return_inverse=True)
            twice = np.bincount(inverse, np.where(many, 2, 1), len(cell)) > 1
            part = cell // segment
            cuts = np.flatnonzero(np.diff(part)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(cell)]])
            local = (cell % segment).astype(np.uint32) << 1 | twice
            yield pa.RecordBatch.from_pydict(
                {"segment": pa.array(part[starts].astype(np.int64)), "hits": pa.array([local[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())}
            )

        def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for batch in batches:
                got = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
                held.append(got.astype(np.int64).view(np.uint64))
                n += len(got)
                if n >= 500_000:
                    yield from flush(held)
                    held, n = [], 0
            yield from flush(held)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            once: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    got = np.frombuffer(data.as_buffer(), np.uint32)
                    state = once.setdefault(k, np.zeros(segment, np.uint8))
                    at = got >> 1
                    state[at] = np.minimum(2, state[at] + 1 + (got & 1).astype(np.uint8))
            for k, state in once.items():
                yield pa.RecordBatch.from_pydict({"segment": pa.array([k], pa.int64()), "bits": pa.array([np.packbits(state >= times, bitorder="little").tobytes()], pa.binary())})

        hits = map_arrow(hashes, hit, "segment bigint, hits binary")
        merged = map_arrow(hits.repartition(max(1, min(64, cells // segment)), "segment"), merge, "segment bigint, bits binary")
        return cls(cells, {row.segment: bytes(row.bits) for row in merged.collect()})


def split_repeated(rows: DataFrame, hash_col: str, items: int) -> list[tuple[DataFrame, Callable]]:
    """Stored ``rows`` in ranges of their hash, each with the test of its own filter: (rows, function from a column of
    hashes to "maybe twice"). Each range is written once and read on its own, so the cost stays linear."""
    ranges = CellFilter.ranges_for(items)
    if ranges == 1:
        return [(rows, asked(rows.sparkSession, CellFilter.build(rows.select(hash_col), items)))]
    part = fresh(rows, "hash_range")[0]
    dealt = stored(rows.withColumn(part, F.pmod(F.xxhash64(hash_col), F.lit(ranges)).cast("int")), by=part)
    out = []
    for i in range(ranges):
        own = dealt.where(F.col(part) == i).drop(part)
        out.append((own, asked(rows.sparkSession, CellFilter.build(own.select(hash_col), -(-items // ranges), cells=CellFilter.MAX_CELLS))))
    return out


def asked(spark: SparkSession, seen: CellFilter):  # noqa: ANN201
    """A function from a column of hashes to the filter's answers."""
    shared = spark.sparkContext.broadcast(seen)

    @F.arrow_udf("boolean")
    def maybe(h: pa.Array) -> pa.Array:
        return pa.array(shared.value.maybe_repeated(h.to_numpy(zero_copy_only=False).astype(np.int64)))

    return maybe
