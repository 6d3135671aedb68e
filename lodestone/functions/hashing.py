"""Identities: digests, stable partitions, names and UUIDs as Column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def canonical_json(**fields: Column) -> Column:
    """Sorted keys, no spaces, nulls kept. For strings, integers, booleans and arrays of them."""
    return F.to_json(F.struct(*(c.alias(name) for name, c in sorted(fields.items()))), {"ignoreNullFields": "false"})


def stable_partition(key: Column, n: int) -> Column:
    """The first 8 bytes of the key's SHA-256, unsigned, modulo n."""
    return F.pmod(F.conv(F.substring(sha256(key), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(n).cast("decimal(20,0)")).cast("bigint")


def artifact_name(key: Column) -> Column:
    return F.substring(sha256(key), 1, 32)


def document_id(kind: Column, library: Column, parent: Column, attachment: Column, index: Column) -> Column:
    return F.concat_ws(":", F.lit("zotero"), kind, library, parent, attachment, index.cast("string"))


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """UUID version 5 of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary")))
    variant = F.lower(F.conv((F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)).cast("string"), 10, 16))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def normal_doi(value: Column) -> Column:
    return F.nullif(F.lower(F.regexp_replace(value, r"\s+", "")), F.lit(""))


def year_of(value: Column) -> Column:
    """The first four digits that stand by themselves."""
    return F.nullif(F.regexp_extract(value, r"(?<!\d)(\d{4})(?!\d)", 1), F.lit("")).cast("int")


def streamed_digest(rows, by: str, order: str, value: str, head: str = "", glue: str = ",", tail: str = ""):  # noqa: ANN001, ANN201
    """(by, fingerprint, n): SHA-256 of each group's values in order, with ``glue`` between, ``head`` before and ``tail`` behind them. Rows are streamed through the
    hash in order, so no group is ever held as a whole; one group's hash is sequential, and so the work of one task."""
    import hashlib
    from collections.abc import Iterator

    import pyarrow as pa

    kind = rows.schema[by].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, n, out = None, None, 0, []

        def end() -> None:
            state.update(tail.encode())
            out.append((current, state.hexdigest(), n))

        for batch in batches:
            for group, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is None or group != current:
                    if state is not None:
                        end()
                    current, state, n = group, hashlib.sha256(head.encode()), 0
                state.update(((glue if n else "") + (text or "")).encode())
                n += 1
            if len(out) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[by, "fingerprint", "n"])
                out = []
        if state is not None:
            end()
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[by, "fingerprint", "n"])

    return rows.repartition(by).sortWithinPartitions(by, order).select(by, value).mapInArrow(run, f"{by} {kind}, fingerprint string, n bigint")


def corpus_fingerprint(rows, by: str, order: str, digest: str):  # noqa: ANN001, ANN201
    """(by, fingerprint, n): SHA-256 of the digests of each group, in order and joined by commas."""
    return streamed_digest(rows, by, order, digest)
