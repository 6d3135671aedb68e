"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Null texts count as empty; empty texts have no ids. Rows are independent, so ties, repeated
rows and empty tables need no care, and columns other than the two named are not read, whatever their names.

Long texts are cut into pieces where no match of the pattern crosses. A run of white space beyond RUN characters,
which the library's regular expressions can't take, is a match by itself, but for its last character if
something follows; its bytes go to the merges directly. So do not runs of other characters, which the library
takes at any length.
Invalid ids in ``decode`` (negative, beyond the ranks, null) decode to no bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts beyond this many characters are encoded in pieces of about that length.
PIECE = 16_384
#: White space runs beyond this many characters are encoded on their own.
RUN = 8192
#: The pattern's white space (fixed: the property White_Space).
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A match of the pre-tokenising pattern that starts before a white space character which follows
#: another character cannot reach over it, so a text may be cut there. Between a letter and a
#: digit of ASCII it may be cut too: no match holds both.
_CUT = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_LONG = re.compile(f"[{_WHITE}]{{{RUN},}}")


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str):  # noqa: ANN201
    """The encoding, loaded once in each Python worker."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, length: int = PIECE) -> Iterator[str]:
    """text, cut at safe boundaries only, so that the pieces' ids concatenate to the text's."""
    begin = 0
    while len(text) - begin > length:
        cut = _CUT.search(text, begin + length)
        if cut is None or cut.start() >= len(text):
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def encode_text(coder, text: str) -> list[int]:  # noqa: ANN001
    if len(text) <= min(PIECE, RUN):
        return coder.encode_ordinary(text)
    ids, at = [], 0
    for run in _LONG.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += [i for piece in pieces(text[at : run.start()]) for i in coder.encode_ordinary(piece)]
        ids += coder._encode_single_piece(text[run.start() : end])  # noqa: SLF001
        at = end
    return ids + [i for piece in pieces(text[at:]) for i in coder.encode_ordinary(piece)]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, ids array<int>) of each document."""
    path, pattern = path or rank_file(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encode_text(coder, text or "") for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, raw binary): the bytes of the ids, which need not be valid UTF-8 where ids were cut."""
    path, pattern = path or rank_file(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path, pattern)
        for batch in batches:
            raw = [coder.decode_bytes([i for i in ids or () if i is not None and 0 <= i < coder.n_vocab]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "raw"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col), F.col(ids_col).cast("array<int>")).mapInArrow(run, f"id {kind}, raw binary").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the round trip of each text in one pass.

    Ids never leave the worker: digests of them and of the bytes they decode to do.
    """
    path, pattern = path or rank_file(), pattern or default_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path, pattern)
        decimal = [str(i) for i in range(coder.n_vocab)]
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for text in batch.column(1):
                ids = encode_text(coder, text.as_py() or "")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(coder.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
