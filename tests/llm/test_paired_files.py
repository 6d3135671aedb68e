"""The co-bucketed pair against plain Python, on small cells so that hot keys are dealt level by level."""

import datetime
import functools
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from lodestone.llm import paired_files as pair

SALES = "sale_id bigint, client_id bigint, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int"
LINES = "sale_id bigint, line_no int, item_id bigint, vendor_id bigint, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, number string, `key` string, cell double"


def crc(text):
    return zlib.crc32(text.encode())


def order(a, b):
    """sale_id descending, the rest ascending, nulls first."""
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if x is None or y is None:
            if (x is None) != (y is None):
                return -1 if x is None else 1
            continue
        x, y = (x.encode(), y.encode()) if isinstance(x, str) else (x, y)
        if x != y:
            return (-1 if x < y else 1) * (-1 if i == 0 else 1)
    return 0


def brute(sales, lines, buckets):
    """{(table, bucket): (rows in order, lineage, joined, rewritten)}"""
    b = lambda k: buckets + 1 if k is None else crc(f"pair{k}") % buckets
    known, per = {r[0] for r in sales if r[0] is not None}, Counter(r[0] for r in sales if r[0] is not None)
    joined = Counter()
    for r in lines:
        if r[0] in known:
            joined[b(r[0])] += per[r[0]]
    out = {}
    for name, rows in (("sales", sales), ("sale_lines", lines)):
        files, goes = defaultdict(lambda: defaultdict(list)), defaultdict(set)
        for r in rows:
            f = b(r[0])
            s = (f - 1 if f % 5 == 1 else f) if name == "sales" else 0 if r[2] is None else crc(str(r[2])) % buckets
            f = buckets if name == "sale_lines" and r[0] is not None and r[0] not in known else f
            files[f][s].append(r)
            goes[s].add(f)
        for f, sources in files.items():
            stays = len(sources) == 1 and len(goes[next(iter(sources))]) == 1
            own = sorted((r for x in sources.values() for r in x), key=functools.cmp_to_key(order))
            out[name, f] = own, ",".join(f"{s}:{len(x)}" for s, x in sorted(sources.items())), joined[f] if f < buckets else 0, not stays
    return out


def tables(n, hot=True, seed=5):
    rng = random.Random(seed)
    when = lambda: rng.choice([None, datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=rng.randrange(10**12))])
    sales = [(i, rng.choice([None, 1, rng.randrange(50)]), rng.choice([None, "", "done", "é", "a\0b"]), rng.choice([None, 0.0, 1.5, -3.25]), when(), when(), rng.choice([None, 1, 5])) for i in range(n // 4)]
    sales += [(None, 1, "x", 1.0, None, None, 1), (None, None, None, None, None, None, None), sales[0], sales[0], (-5, 1, "y", None, None, None, 2)] if n else []
    lines = []
    for i in range(n):
        sale = 7 if hot and i % 3 == 0 else rng.choice([None, rng.randrange(n // 4), 10**6 + i % 5])
        lines.append((sale, rng.randrange(3) if i % 2 else 1, 3 if i % 3 == 1 else rng.choice([None, rng.randrange(20)]), 1, rng.choice([None, 4]), rng.choice([0.5, -0.0, 0.0, None]), 0.1, rng.choice(["kept", "swapped", None]), when(), "n", "k" * (i % 3), None))
    same = (7, 1, 3, 1, 4, 0.5, 0.1, "kept", None, "n", "", None)
    return sales, lines + [same] * (n // 4)


def check(spark, sales, lines, buckets, parts=3):
    left, right = spark.createDataFrame(sales, SALES).repartition(parts), spark.createDataFrame(lines, LINES).repartition(parts)
    got = pair.rewrite(left, right, buckets=buckets).collect()
    want = brute(sales, lines, buckets)
    assert {(r.table_name, r.bucket) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        rows, lineage, joined, rewritten = want[r.table_name, r.bucket]
        table = pq.read_table(r.path.removeprefix("file:"))
        assert [tuple(x.values()) for x in table.to_pylist()] == rows
        assert r.columns == ",".join(table.column_names) == ",".join((left if r.table_name == "sales" else right).columns)
        assert r.ids_sha256 == hashlib.sha256(",".join("" if x[0] is None else str(x[0]) for x in rows).encode()).hexdigest()
        assert r.lineage_sha256 == hashlib.sha256(lineage.encode()).hexdigest(), lineage
        assert (r.n_rows, r.n_joined, r.rewritten) == (len(rows), joined, rewritten)
    if got:
        import glob

        folder = got[0].path.removeprefix("file:").rsplit("/", 3)[0]
        assert {p for p in glob.glob(f"{folder}/*/*/*.parquet")} == {r.path.removeprefix("file:") for r in got}
    return got


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(pair, "CELL", 8)
    monkeypatch.setattr(pair, "PIECE", 8)


def test_pair_equals_brute_force(spark, small):
    got = check(spark, *tables(600), 7)
    assert {r.rewritten for r in got} == {True, False}


def test_pair_of_few_rows_keeps_files(spark):
    sales, lines = tables(24, hot=False)
    check(spark, sales, lines, 150)


@pytest.mark.parametrize("which", ["none", "sales", "lines"])
def test_pair_of_empty_tables(spark, which):
    sales, lines = tables(40)
    check(spark, sales if which == "sales" else [], lines if which == "lines" else [], 11)


def test_radix_cells_are_bounded_and_in_order(spark, small):
    rng = random.Random(1)
    keys = [b"\x01" + (7 if i % 3 else rng.randrange(10**6)).to_bytes(8, "big") + bytes([i % 7 if i % 5 else 3]) + (rng.randrange(4) if i % 2 else 9).to_bytes(8, "big") for i in range(3000)]
    keys += [b"\x01" + (9).to_bytes(8, "big") + b"same" * 3] * 400
    rows = spark.createDataFrame([(i % 2, bytearray(k)) for i, k in enumerate(keys)], "number int, key binary").repartition(4)
    cells = defaultdict(list)
    for r in pair.celled(pair.stored(rows))[0].collect():
        cells[r.number, r.cell].append(bytes(r.key))
    assert sum(map(len, cells.values())) == len(keys)
    assert max(map(len, cells.values())) <= max(4 * pair.CELL, max(Counter(keys).values()) // 8)
    for number in (0, 1):
        spans = sorted((min(v), max(v)) for (n, _), v in cells.items() if n == number)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
