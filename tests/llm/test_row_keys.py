"""Row keys: their order is the rows' order, and they hold the rows whole."""

import datetime
import decimal
import functools
import math
import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm.rowkeys import RowKeys

SCHEMA = pa.schema([("id", pa.int64()), ("s", pa.string()), ("x", pa.float64()), ("b", pa.bool_()), ("t", pa.timestamp("us")), ("d", pa.date32()), ("n", pa.decimal128(20, 3)), ("f", pa.float32()), ("raw", pa.binary()), ("i", pa.int32())])
ROW = st.tuples(
    st.integers(-(2**63), 2**63 - 1) | st.integers(-2, 2),
    st.text(st.sampled_from("a\0b\xffሴ\U0001f600"), max_size=4),
    st.floats() | st.sampled_from([0.0, -0.0]),
    st.booleans(),
    st.datetimes(datetime.datetime(1900, 1, 1), datetime.datetime(2100, 1, 1)),
    st.dates(datetime.date(1900, 1, 1), datetime.date(2100, 1, 1)),
    st.integers(-(10**19), 10**19).map(lambda v: decimal.Decimal(v).scaleb(-3)),
    st.floats(width=32) | st.sampled_from([0.0, -0.0]),
    st.binary(max_size=3),
    st.integers(-3, 3),
)
ROWS = st.lists(st.tuples(*(st.none() | s for s in [ROW.map(lambda r, i=i: r[i]) for i in range(10)])), max_size=12)


def bits(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else struct.pack(">d", v) if isinstance(v, float) else v for v in row)


def compared(a, b):
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if x is None or y is None:
            if (x is None) != (y is None):
                return -1 if x is None else 1
            continue
        if isinstance(x, float) and (math.isnan(x) or math.isnan(y)):
            if math.isnan(x) != math.isnan(y):
                return 1 if math.isnan(x) else -1
            continue
        x, y = (x.encode(), y.encode()) if isinstance(x, str) else (x, y)
        if x != y:
            return (-1 if x < y else 1) * (-1 if i == 0 else 1)
    return 0


@settings(max_examples=200, deadline=None)
@given(ROWS)
def test_keys_order_and_hold_rows(rows):
    codec = RowKeys(SCHEMA, ("id",))
    table = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SCHEMA)], schema=SCHEMA)
    padded = pa.concat_arrays([table.slice(0, 1).to_struct_array(), table.to_struct_array()]).slice(min(1, len(rows)))
    keys = codec.encode(padded)
    assert [bits(r.values()) for r in codec.decode(keys).to_pylist()] == [bits(r.values()) for r in table.to_pylist()]
    rows = [tuple(r.values()) for r in table.to_pylist()]
    by_key = [rows[i] for i in sorted(range(len(rows)), key=lambda i: keys[i].as_py())]
    by_row = sorted(rows, key=functools.cmp_to_key(compared))
    assert all(compared(a, b) == 0 for a, b in zip(by_key, by_row, strict=True))
    if len(keys):
        assert codec.decode(keys.slice(len(keys) // 2)).to_pylist().__repr__() == table.slice(len(keys) // 2).to_pylist().__repr__()


def test_other_types_raise():
    with pytest.raises(TypeError, match="no row keys"):
        RowKeys(pa.schema([("a", pa.list_(pa.int64()))]))
    with pytest.raises(TypeError, match="descending"):
        RowKeys(pa.schema([("a", pa.string())]), ("a",))
