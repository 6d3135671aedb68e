"""Memcomparable row keys: whole rows as bytes whose unsigned order is the order of the rows, and back.

A column is a marker, 0 for null and 1 for a value, so that nulls come first, then the value: integers, dates, timestamps
and decimals as big-endian bytes with the sign bit flipped, floating-point numbers as their bits with the sign bit flipped or, below
zero, all bits; strings and binaries as they are with 0 written as 0 255, and 0 0 behind them. A descending column's value bytes
are inverted, its marker isn't. -0.0 sorts as 0.0 and NaN above all numbers; a last byte for each floating-point column
keeps whether it was -0.0, so that keys hold rows whole. Keys of one schema are never prefixes of each other.
Other types (lists, structs, maps) raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def _bits(column: pa.Array, width: int) -> np.ndarray:
    """The values as unsigned integers of ``width`` bytes; those of nulls are any."""
    raw = np.frombuffer(column.buffers()[1], f"<u{width}") if column.buffers()[1] is not None else np.zeros(0, f"<u{width}")
    return raw[column.offset : column.offset + len(column)]


class RowKeys:
    """The keys of rows of a schema. ``descending``: names of columns in descending order; they must be of fixed width."""

    def __init__(self, schema: pa.Schema, descending: tuple[str, ...] = ()) -> None:
        self.schema, self.kinds, self.turned = schema, [self._kind(f) for f in schema], [f.name in descending for f in schema]
        if any(t and k[0] == "bytes" for t, k in zip(self.turned, self.kinds, strict=True)):
            raise TypeError("only columns of fixed width can be in descending order")
        self.floats = [i for i, k in enumerate(self.kinds) if k[0] == "float"]

    @staticmethod
    def _kind(field: pa.Field) -> tuple[str, int]:
        t = field.type
        if pa.types.is_boolean(t):
            return "bool", 1
        if pa.types.is_floating(t):
            return "float", t.bit_width // 8
        if pa.types.is_decimal128(t):
            return "decimal", 16
        if pa.types.is_signed_integer(t) or pa.types.is_date32(t) or pa.types.is_timestamp(t) or pa.types.is_duration(t):
            return "int", t.bit_width // 8
        if pa.types.is_string(t) or pa.types.is_binary(t):
            return "bytes", 0
        raise TypeError(f"column {field.name}: no row keys for {t}")

    def _fixed(self, column: pa.Array, kind: str, width: int, turned: bool) -> np.ndarray:
        """A row of bytes for each value."""
        if kind == "bool":
            out = column.fill_null(False).to_numpy(zero_copy_only=False).astype(np.uint8)[:, None]  # noqa: FBT003
        elif kind == "decimal":
            raw = np.frombuffer(column.buffers()[1], np.uint8) if len(column) else np.zeros(0, np.uint8)
            out = raw.reshape(-1, 16)[column.offset : column.offset + len(column), ::-1].copy()
            out[:, 0] ^= 0x80
        else:
            bits, top = _bits(column, width), np.array(1, f"<u{width}") << np.array(8 * width - 1, f"<u{width}")
            if kind == "float":
                value = bits.view(f"<f{width}")
                bits = np.where(value == 0, 0, np.where(np.isnan(value), np.array(np.nan, f"<f{width}").view(f"<u{width}"), bits)).astype(f"<u{width}")
                bits = np.where(bits & top, ~bits, bits ^ top)
            else:
                bits = bits ^ top
            out = bits.astype(f">u{width}").view(np.uint8).reshape(len(column), width)
        return ~out if turned else out

    def encode(self, rows: pa.StructArray) -> pa.Array:
        """The keys (binary) of rows of the schema."""
        n = len(rows)
        columns = [c.cast(f.type) for c, f in zip(rows.flatten(), self.schema, strict=True)]
        valid = [c.is_valid().to_numpy(zero_copy_only=False) for c in columns]
        texts: dict[int, tuple[list[bytes], np.ndarray]] = {}
        size = np.full(n, len(columns) + len(self.floats), np.int64)
        for i, (column, ok) in enumerate(zip(columns, valid, strict=True)):
            kind, width = self.kinds[i]
            if kind == "bytes":
                coded = column.cast(pa.binary()).dictionary_encode()
                values = [v.replace(b"\0", b"\0\xff") + b"\0\0" for v in coded.dictionary.to_pylist()] or [b""]
                texts[i] = values, coded.indices.fill_null(0).to_numpy(zero_copy_only=False)
                size += np.where(ok, np.array([len(v) for v in values])[texts[i][1]], 0)
            else:
                size += width * ok
        ends = np.cumsum(size)
        out, at = np.zeros(int(ends[-1]) if n else 0, np.uint8), ends - size
        for i, (column, ok) in enumerate(zip(columns, valid, strict=True)):
            kind, width = self.kinds[i]
            out[at] = ok
            at = at + 1
            if kind == "bytes":
                values, index = texts[i]
                lengths = np.array([len(v) for v in values])
                flat, begin = np.frombuffer(b"".join(values), np.uint8), np.cumsum(lengths) - lengths
                own = np.where(ok, lengths[index], 0)
                step = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
                out[np.repeat(at, own) + step] = flat[np.repeat(begin[index], own) + step]
                at = at + own
            else:
                fixed = self._fixed(column, kind, width, self.turned[i])
                where = at if ok.all() else at[ok]
                out[where[:, None] + np.arange(width)] = fixed if ok.all() else fixed[ok]
                at = at + width * ok
        for i in self.floats:
            out[at] = valid[i] & (_bits(columns[i], self.kinds[i][1]) == 1 << 8 * self.kinds[i][1] - 1)
            at = at + 1
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(out)])

    def decode(self, keys: pa.Array) -> pa.RecordBatch:
        """The rows of keys."""
        n = len(keys)
        offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + n + 1].astype(np.int64)
        data = np.frombuffer(keys.buffers()[2], np.uint8) if n else np.zeros(0, np.uint8)
        at, columns, signs = offsets[:-1].copy(), [], data[offsets[1:, None] - len(self.floats) + np.arange(len(self.floats))] if n else np.zeros((0, len(self.floats)), np.uint8)
        zeros = np.flatnonzero(data == 0) if any(k == "bytes" for k, _ in self.kinds) else None
        for i, field in enumerate(self.schema):
            kind, width = self.kinds[i]
            ok = data[at] == 1
            at = at + 1
            if kind == "bytes":
                column, at = self._texts(data, at, ok, zeros, field.type)
                columns.append(column)
                continue
            raw = np.zeros((n, width), np.uint8)
            raw[ok] = data[at[ok][:, None] + np.arange(width)]
            at = at + width * ok
            if self.turned[i]:
                raw = ~raw
            mask = None if ok.all() else pa.py_buffer(np.packbits(ok, bitorder="little"))
            if kind == "bool":
                columns.append(pa.array(raw[:, 0] == 1, mask=~ok))
                continue
            if kind == "decimal":
                raw[:, 0] ^= 0x80
                buffer = np.ascontiguousarray(raw[:, ::-1])
            else:
                bits, top = np.ascontiguousarray(raw).view(f">u{width}").ravel().astype(f"<u{width}"), np.array(1, f"<u{width}") << np.array(8 * width - 1, f"<u{width}")
                if kind == "float":
                    bits = np.where(bits & top, bits ^ top, ~bits)
                    bits = np.where(ok & (signs[:, self.floats.index(i)] == 1), top, bits).astype(f"<u{width}")
                else:
                    bits = bits ^ top
                buffer = bits
            columns.append(pa.Array.from_buffers(field.type, n, [mask, pa.py_buffer(buffer)]))
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)

    @staticmethod
    def _texts(data: np.ndarray, at: np.ndarray, ok: np.ndarray, zeros: np.ndarray, kind: pa.DataType) -> tuple[pa.Array, np.ndarray]:
        """A column of strings or binaries that begin at ``at``, and where the next column begins."""
        begin = at[ok]
        nth = np.searchsorted(zeros, begin)
        while (escaped := data[zeros[nth] + 1] == 0xFF).any():
            nth = nth + escaped
        end = zeros[nth]
        lengths = np.zeros(len(at), np.int64)
        lengths[ok] = end - begin
        step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        flat = data[np.repeat(at, lengths) + step]
        stops = np.cumsum(lengths)
        if (flat == 0).any():  # written zeros: they and the byte behind them are one
            parts = [flat[b:e].tobytes().replace(b"\0\xff", b"\0") if o else None for b, e, o in zip((stops - lengths).tolist(), stops.tolist(), ok.tolist(), strict=True)]
            column = pa.array(parts, pa.binary()).cast(kind)
        else:
            offsets = np.concatenate([[0], stops]).astype(np.int32)
            column = pa.Array.from_buffers(kind, len(at), [pa.py_buffer(np.packbits(ok, bitorder="little")), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])
        return column, at + np.where(ok, lengths + 2, 0)
