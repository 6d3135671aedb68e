"""A pair of tables rewritten to common buckets of a key, one sorted Parquet file for each table and bucket.

Rows become memcomparable keys (``rowkeys``) and are sorted by a distributed MSD radix sort. The root of each file's tree skips
the bits that all its keys share and deals its rows to cells by the next bits, its digit, of as many bits as its rows need cells.
Cells that stay large become nodes of their own: they skip what their keys share and are dealt by their next digit, until none is
large or all keys of one are equal (then its rows are dealt round, as their order doesn't matter). Nodes are at most the files and, for
each level, SHARE: their table never grows with the input, and only it is broadcast. Cells are sorted by tasks of their own, each in pieces of at most
PIECE rows; a piece's columns are packed as one row, so that the one task that writes a file sorts pieces by their first key and streams rows.

Starting files are named by Spark's writer, part-NNNNN, NNNNN being their number. They are read again for the rewriting. A starting file whose
rows are just those of one final file stays; the others are deleted once the final ones are written. All files lie in a new folder of the shared
folder, which is left there; tables stored on the way lie beside it and go.

Which bucket a right row is in depends on whether its key is one of the left table. Keys are compared as distinct values with their counts
only. Those of right rows alone go into a filter of fixed size; rows that it doesn't know pass straight through, the
others join with the keys, as Spark splits skewed joins. What reaches the driver is at most a row for each pair of a starting and a final file.

Defined cases: null keys are in bucket ``buckets + 1`` of either table, right rows without a partner in bucket ``buckets``; null spread values in starting
file 0. Repeated rows are rows of their own. Empty tables write no file. Texts of any length, extra columns and any column names are kept; nested
columns raise an error, since they have no row key.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lodestone.llm.rowkeys import RowKeys
from lodestone.llm.shared import CellFilter, asked, checkpoint, map_arrow, released, shared_dir, stored

BUCKETS, SALT = 150, "pair"
#: Rows that a cell should have, and rows that a piece has at most.
CELL = PIECE = 1 << 14
#: Cells of more than 4 * CELL rows, and more than 1 / SHARE of all, are dealt again.
SHARE = 1000
#: Bits of a digit at most.
DIGIT = 16
#: Cells of the filter of right keys without a partner.
FILTER = 1 << 23


def bucket(key: Column, buckets: int = BUCKETS, salt: str = SALT) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.concat(F.lit(salt), key.cast("string")).cast("binary")), F.lit(buckets)), F.lit(buckets + 1)).cast("int")


def _encoded(rows: DataFrame, table: StructType, key: str) -> DataFrame:
    """rows (start int, number int, row struct) as (start, number, key binary)."""
    schema = to_arrow_schema(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = RowKeys(schema, (key,))
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict({"start": batch.column(0), "number": batch.column(1), "key": codec.encode(batch.column(2))})

    return map_arrow(rows, run, "start int, number int, key binary")


def _shared_bits(low: bytes, high: bytes) -> int | None:
    """How many leading bits two keys share; None if they are equal."""
    for i, (a, b) in enumerate(zip(low, high, strict=False)):
        if a != b:
            return 8 * i + 8 - (a ^ b).bit_length()
    return None


def _digit(key: Column, node: str) -> Column:
    """The node's digit of a key; for nodes of equal keys, a row's place."""
    window = F.conv(F.rpad(F.hex(F.substring(key, (F.shiftright(f"{node}.skip", 3) + 1).cast("int"), F.lit(4))), 8, "0"), 16, 10).cast("bigint")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(f"{node}.width")) - 1
    right = F.call_function("shiftright", window, (32 - F.col(f"{node}.skip").bitwiseAND(7) - F.col(f"{node}.width")).cast("int"))
    return F.when(F.col(f"{node}.equal"), F.monotonically_increasing_id()).otherwise(right).bitwiseAND(mask)


def _node(i: int, n: int, low: bytes, high: bytes) -> tuple[int, int, int, bool]:
    skip, width = _shared_bits(bytes(low), bytes(high)), min(DIGIT, max(0, (n - 1) // CELL).bit_length())
    return i, skip or 0, width, skip is None


def celled(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Stored rows (number, key) with ``cell``: cells of a file hold rows that lie together in its order. With it, what was stored on the way: the rows
    of large cells, which alone go to the next level."""
    spark, facts = rows.sparkSession, [F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")]
    level, leaves, kept, used, large = rows.select("number", F.col("number").cast("bigint").alias("at"), "key"), [], [], 0, 0
    while True:
        found = level.groupBy("at").agg(*facts).collect()  # a row for each file, or at most SHARE
        if not leaves:
            large, used = max(4 * CELL, sum(r.n for r in found) // SHARE), max((r["at"] for r in found), default=0) + 1
        nodes = [_node(r["at"], r.n, r.low, r.high) for r in found]
        table = F.broadcast(spark.createDataFrame(nodes, "id bigint, skip int, width int, equal boolean").select(F.struct("*").alias("node")))
        child = F.call_function("shiftleft", F.col("at"), F.lit(DIGIT)).bitwiseOR(_digit(F.col("key"), "node"))
        dealt = level.join(table, F.col("at") == F.col("node.id")).select("number", child.alias("cell"), F.col("node.equal").alias("equal"), "key")
        heavy = sorted(r.cell for r in dealt.where("NOT equal").groupBy("cell").count().where(F.col("count") > large).collect())  # at most SHARE
        if not heavy:
            leaves.append(dealt.select("number", "cell", "key"))
            return reduce(DataFrame.unionByName, leaves), kept
        names = F.broadcast(spark.createDataFrame([(c, used + i) for i, c in enumerate(heavy)], "of bigint, next bigint"))
        used += len(heavy)
        marked = dealt.join(names, F.col("cell") == F.col("of"), "left")
        leaves.append(marked.where("next IS NULL").select("number", "cell", "key"))
        level = stored(marked.where("next IS NOT NULL").select("number", F.col("next").alias("at"), "key"))
        kept.append(level)


def _pieces(table: StructType, key: str):  # noqa: ANN202
    """Rows (cell, number, key) in order of cell and key as (number, first key, packed rows)."""
    schema, most = to_arrow_schema(table), PIECE

    def packed(codec: RowKeys, number: int, keys: list[pa.Array]) -> pa.RecordBatch:
        whole, sink = pa.concat_arrays(keys), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(codec.decode(whole))
        return pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int32()), "first": whole[:1], "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, held, n, at = RowKeys(schema, (key,)), [], 0, None
        for batch in batches:
            cells, numbers, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                while begin < end:
                    now = int(cells[begin]), int(numbers[begin])
                    if held and (now != at or n == most):
                        yield packed(codec, at[1], held)
                        held, n = [], 0
                    to = min(end, begin + most - n)
                    held.append(keys.slice(begin, to - begin))
                    n, at, begin = n + to - begin, now, to
        if held:
            yield packed(codec, at[1], held)

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in batch.column(2):
            yield from pa.ipc.open_stream(pa.py_buffer(piece.as_buffer()))


def write_sorted(rows: DataFrame, table: StructType, key: str, files: int, path: str) -> None:
    """Stored rows (start, number, key) as one sorted file part-NNNNN for each number, below ``files``."""
    cells, kept = celled(rows.select("number", "key"))
    sorted_rows = cells.repartition("cell").sortWithinPartitions("cell", "key").select("cell", "number", "key")
    pieces = map_arrow(sorted_rows, _pieces(table, key), "number int, first binary, rows binary")
    placed = pieces.repartitionById(files, F.col("number")).sortWithinPartitions("number", "first")
    map_arrow(placed, _rows, table).write.option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(path)
    released(*kept)


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _files(spark: SparkSession, path: str) -> dict[int, str]:
    """The data files of a folder by their numbers."""
    fs, target = _fs(spark, path)
    names = [s.getPath().toString() for s in fs.listStatus(target)] if fs.exists(target) else []
    return {int(m[1]): n for n in names if (m := re.search(r"/part-(\d+)[^/]*\.parquet$", n))}


def _digests(spark: SparkSession, files: list[str], table: StructType, key: str) -> dict[str, tuple[int, str]]:
    """(rows, SHA-256 of the keys in their order) of each file, by its last two path parts."""
    if not files:
        return {}

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, places = batch.column(0), batch.column(1).to_numpy()
            names = np.array(paths.to_pylist())
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]) | (np.diff(places) != 1)) + 1).tolist(), len(names)]
            keys = batch.column(2).cast(pa.string()).fill_null("").to_pylist()
            spans = [(b, e) for b, e in zip(cuts, cuts[1:], strict=False) if e > b]
            yield pa.RecordBatch.from_pydict({"path": pa.array([names[b] for b, _ in spans], pa.string()), "place": pa.array([int(places[b]) for b, _ in spans], pa.int64()), "n": pa.array([e - b for b, e in spans], pa.int64()), "keys": pa.array([",".join(keys[b:e]) for b, e in spans], pa.string())})

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, state = None, 0, None
        for batch in batches:
            for path, size, keys in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if path != at:
                    if at is not None:
                        yield pa.RecordBatch.from_pydict({"path": [at], "n": [n], "sha": [state.hexdigest()]})
                    at, n, state = path, 0, hashlib.sha256()
                state.update(((("," if n else "") + keys)).encode())
                n += size
        if at is not None:
            yield pa.RecordBatch.from_pydict({"path": [at], "n": [n], "sha": [state.hexdigest()]})

    rows = spark.read.schema(table).parquet(*files).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("place"), F.col(key).cast("string").alias("key"))
    spans = map_arrow(rows, texts, "path string, place bigint, n bigint, keys string").repartition("path").sortWithinPartitions("path", "place")
    return {"/".join(r.path.split("/")[-2:]): (r.n, r.sha) for r in map_arrow(spans, hashed, "path string, n bigint, sha string").collect()}


def _rewritten(rows: DataFrame, start: Column, final, key: str, buckets: int, folder: str) -> list[tuple]:  # noqa: ANN001
    """Writes a table's starting files, then its final ones; ``final``: (start, number, row struct) of what the starting files hold.
    A (path, bucket, rows, digest, lineage, rewritten) for each final file."""
    spark, table, files = rows.sparkSession, rows.schema, buckets + 2
    first = stored(_encoded(rows.select(start.alias("start"), start.alias("number"), F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row")), table, key))
    write_sorted(first, table, key, files, f"{folder}/start")
    counts = {r.number for r in first.select("number").distinct().collect()}  # at most ``files``
    released(first)
    for n, path in _files(spark, f"{folder}/start").items():
        if n not in counts:  # Spark writes an empty first file
            _delete(spark, path)
    starting = _files(spark, f"{folder}/start")
    if not starting:
        return []
    held = spark.read.schema(table).parquet(*starting.values())
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/part-(\d+)[^/]*$", 1).cast("int")
    second = stored(_encoded(final(held, number), table, key))
    cross: dict[int, dict[int, int]] = defaultdict(Counter)
    for r in second.groupBy("start", "number").count().collect():  # a row for each pair of files at most
        cross[r.number][r.start] = r["count"]
    goes = Counter(s for sources in cross.values() for s in sources)
    stay = {s: f for f, sources in cross.items() for s in sources if len(sources) == 1 and goes[s] == 1}
    if len(stay) < len(starting):
        write_sorted(second.where(~F.col("start").isin(list(stay))), table, key, files, f"{folder}/final")
    released(second)
    for n, path in _files(spark, f"{folder}/final").items():
        if n not in cross or n in stay.values():
            _delete(spark, path)
    for s, path in starting.items():
        if s not in stay:
            _delete(spark, path)
    paths = {f: starting[s] for s, f in stay.items()} | _files(spark, f"{folder}/final")
    digests = _digests(spark, list(paths.values()), table, key)
    lineage = {f: hashlib.sha256(",".join(f"{s}:{n}" for s, n in sorted(sources.items())).encode()).hexdigest() for f, sources in cross.items()}
    return [(path, f, *digests["/".join(path.split("/")[-2:])], lineage[f], f not in stay.values()) for f, path in sorted(paths.items())]


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, False)


def rewrite(left: DataFrame, right: DataFrame, key: str = "sale_id", spread: str = "item_id", names: tuple[str, str] = ("sales", "sale_lines"), buckets: int = BUCKETS, salt: str = SALT) -> DataFrame:
    """Writes both tables and returns (table_name, path, columns, ids_sha256, lineage_sha256, bucket, n_rows, n_joined, rewritten) for each final file."""
    spark, k = left.sparkSession, F.col(f"`{key}`")
    folder = f"{shared_dir(spark)}/pair-{uuid.uuid4().hex}"
    _, target = _fs(spark, folder)
    # every key with its rows on both sides; null keys join nothing
    counted = lambda df, n: df.where(k.isNotNull()).groupBy(k.alias("id")).agg(F.count(F.lit(1)).alias(n))
    keys = stored(counted(right, "n_right").join(counted(left, "n_left").withColumnRenamed("id", "other").hint("merge"), F.col("id") == F.col("other"), "left").drop("other"))
    joined = {r.b: r.n for r in keys.where("n_left IS NOT NULL").groupBy(bucket(F.col("id"), buckets, salt).alias("b")).agg(F.sum(F.col("n_left") * F.col("n_right")).alias("n")).collect()}
    alone = checkpoint(keys.where("n_left IS NULL").select("id"))
    maybe = asked(spark, CellFilter.build(alone.select(F.xxhash64("id")), 0, 1, FILTER))
    released(keys)

    def part(held: DataFrame, number: Column) -> tuple[DataFrame, Column]:
        columns = [F.col(f"`{c}`") for c in held.columns]
        return held.select(number.alias("start"), F.struct(*columns).alias("row")), F.col(f"row.`{key}`")

    def of_left(held: DataFrame, number: Column) -> DataFrame:
        rows, own = part(held, number)
        return rows.select("start", bucket(own, buckets, salt).alias("number"), "row")

    def of_right(held: DataFrame, number: Column) -> DataFrame:
        rows, own = part(held, number)
        rows = rows.withColumn("asked", F.coalesce(maybe(F.xxhash64(own)), F.lit(False)) & own.isNotNull())
        clear = rows.where(~F.col("asked")).select("start", bucket(own, buckets, salt).alias("number"), "row")
        found = rows.where("asked").join(alone.hint("merge"), own == F.col("id"), "left")
        return clear.unionByName(found.select("start", F.when(F.col("id").isNotNull(), F.lit(buckets)).otherwise(bucket(own, buckets, salt)).alias("number"), "row"))

    b = bucket(k, buckets, salt)
    starts = (F.when(b % 5 == 1, b - 1).otherwise(b).cast("int"), F.coalesce(F.pmod(F.crc32(F.col(f"`{spread}`").cast("string").cast("binary")), F.lit(buckets)), F.lit(0)).cast("int"))
    out = []
    for name, rows, start, final in zip(names, (left, right), starts, (of_left, of_right), strict=True):
        for path, f, n, ids, lineage, new in _rewritten(rows, start, final, key, buckets, f"{target}/{name}"):
            out.append((name, path, ",".join(rows.columns), ids, lineage, f, n, joined.get(f, 0) if f < buckets else 0, new))
    return spark.createDataFrame(out, "table_name string, path string, columns string, ids_sha256 string, lineage_sha256 string, bucket bigint, n_rows bigint, n_joined bigint, rewritten boolean")
