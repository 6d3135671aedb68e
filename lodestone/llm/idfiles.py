"""Token-id files: texts encoded with the tokenizers library and written as coded blocks.

A file is one task's range of documents in order of id. It holds records, each a block of whole
documents (about BLOCK ids, more only where one document has more) with its index: the number of
the file, the position of the block's first id in it, the documents' ids and ends, and the coded
block (idcoder: reset for each block, with a checksum). Records lie in Parquet tables, so any
store that Spark reaches can hold them and files split between blocks.

Documents are ordered by id, nulls first, then by the hash of their text; repeated rows stand
side by side. Null texts are empty and hold the end id only. An empty table makes an empty file.
Only the two named columns are read.

Texts are encoded by pieces: one ends before each white space character that follows another
character, where no match of the byte-level pre-tokenizer crosses. A worker remembers the pieces that it saw last, at most
2 * CACHE of them. New ones are encoded some JOINED characters at a time, as one string, whose ids are told apart by the
lengths of their bytes; only pieces that white space doesn't part from their neighbours are encoded one by one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import idcoder
from lodestone.llm.shared import stored

BLOCK = 1 << 19
CACHE = 400_000
JOINED = 1 << 16
#: Characters of text that are encoded together.
BATCH = 1 << 20
#: The pre-tokenizer's white space (fixed: the property White_Space).
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_JOINS = re.compile(f"[{_WHITE}].*[^{_WHITE}]", re.DOTALL)
_FILE = "file int, first bigint, n bigint, doc_ids array<bigint>, ends array<bigint>, block binary"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """The tokenizer of a file, behind a cache of pieces."""

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab()
        self.length = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():  # a byte-level token has a character for each byte
            self.length[i] = added.get(i, len(token))

    @staticmethod
    def pieces(text: str) -> list[str]:
        # most texts hold single blanks and line breaks only
        if "\0" not in text:
            parts = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
            if " " not in parts and "\n" not in parts and "\r" not in text and "\t" not in text:
                return parts
        return _CUT.split(text)

    def _remember(self, new: list[str]) -> None:
        """Encodes the pieces."""
        single = [piece for piece in new if not _JOINS.fullmatch(piece)]
        rest = [piece for piece in new if _JOINS.fullmatch(piece)] if len(single) < len(new) else []
        for at in range(0, len(single), 4096):
            some = single[at : at + 4096]
            for piece, coded in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.known[piece] = np.array(coded.ids, "<u4").tobytes()
        begin, size = 0, 0
        for i, piece in enumerate(rest):
            size += len(piece)
            if size >= JOINED or i == len(rest) - 1:
                some = rest[begin : i + 1]
                coded = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
                ids = np.array(coded.ids, "<u4")
                ends = np.cumsum(self.length[ids])
                wanted = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in some])
                at = np.searchsorted(ends, wanted)
                if int(ends[-1]) != int(wanted[-1]) or (ends[at] != wanted).any():
                    raise ValueError("ids cross a cut")
                raw, last = ids.tobytes(), 0
                for p, to in zip(some, ((at + 1) * 4).tolist(), strict=True):
                    self.known[p] = raw[last:to]
                    last = to
                begin, size = i + 1, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.pieces(text) for text in texts]
        if len(self.known) > CACHE:
            self.before, self.known = self.known, {}
        known, before, new = self.known, self.before, []
        for piece in {piece for parts in split for piece in parts}:
            if piece not in known:
                if (held := before.get(piece)) is not None:
                    known[piece] = held
                else:
                    new.append(piece)
        self._remember(new)
        return [b"".join(map(known.__getitem__, parts)) for parts in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 0) -> DataFrame:
    """The stored records of all documents."""
    path = path or tokenizer_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, file, end = encoder(path), TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        first, names, held, size = 0, [], [], 0

        def record() -> pa.RecordBatch:
            ends = np.cumsum([len(x) // 4 for x in held])
            block = idcoder.encode(np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([first], pa.int64()), pa.array([int(ends[-1])], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([block], pa.binary())],
                names=["file", "first", "n", "doc_ids", "ends", "block"],
            )

        for name, ids in _encoded(batches, coder):
            names.append(name)
            held.append(ids + end)
            size += len(held[-1]) // 4
            if size >= BLOCK:
                yield record()
                first, names, held, size = first + size, [], [], 0
        if held:
            yield record()

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first(), "h").sortWithinPartitions(F.col("id").asc_nulls_first(), "h")
    return stored(ordered.mapInArrow(run, _FILE), "none")


def _encoded(batches: Iterator[pa.RecordBatch], coder: Encoder) -> Iterator[tuple[int | None, bytes]]:
    names, texts, size = [], [], 0
    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            names.append(name)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= BATCH:
                yield from zip(names, coder.encode(texts), strict=True)
                names, texts, size = [], [], 0
    yield from zip(names, coder.encode(texts), strict=True)


def read(records: DataFrame, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document in the records; start counts over all files. Without ``ids`` that column stays behind: they
    are decoded and summed up all the same."""
    with_ids = ids
    # one row for each file, of which there are as many as tasks that wrote
    sizes = sorted((r.file, r.n) for r in records.groupBy("file").agg(F.sum("n").alias("n")).collect())
    starts, total = {}, 0
    for file, n in sizes:
        starts[file], total = total, total + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one block at a time
                r = batch.slice(i, 1).to_pylist()[0]
                ids = idcoder.decode(r["block"]).astype("<u4")
                if len(ids) != r["n"]:
                    raise ValueError("a block does not hold what its index says")
                ends = np.array(r["ends"], np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                for lo in range(0, len(ends), 1024):
                    a, b = begins[lo : lo + 1024], ends[lo : lo + 1024]
                    parts = [ids[x:y].tobytes() for x, y in zip(a, b, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(r["doc_ids"][lo : lo + 1024], pa.int64()),
                            pa.array(a + starts[r["file"]] + r["first"], pa.int64()),
                            pa.array(b - a, pa.int64()),
                            pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                            *([pa.array(parts, pa.binary())] if with_ids else []),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])],
                    )

    return records.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else ""))
