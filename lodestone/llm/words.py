"""Words of Arrow text columns as arrays of 64-bit hashes, without a Python object for each word.

Words are runs of bytes other than ASCII white space. A block is a run of whole texts of about
BLOCK bytes (more only where one text is longer). A word's hash is a polynomial of its bytes,
mixed; words beyond LONG bytes are hashed by xxh3, so that no table grows with a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK = 1 << 17
LONG = 256
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PLAIN = np.arange(256, dtype=np.uint8)
_LOWER = _PLAIN.copy()
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """x with its bits mixed, so that all of them depend on all."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's first powers and their inverses, modulo 2^64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n, 2 * BLOCK) + 1
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.full(size, np.uint64(base))
            out[0] = 1
            _powers.append(np.cumprod(out, dtype=np.uint64))
    return _powers[0], _powers[1]


def _short_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))


def _piece(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a piece's words, and where each begins. ``cuts``: where texts begin."""
    word = ~_SPACE[data]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    begin[inner] = word[inner]
    end[inner - 1] = word[inner - 1]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    long = np.flatnonzero(ends - begins > LONG)
    if not len(long):
        return _short_hashes(data, begins, ends), begins
    hashes = np.zeros(len(begins), np.uint64)
    kept = data.copy() if len(data) <= 2 * BLOCK else None
    if kept is not None:
        hashes = _short_hashes(kept, begins, ends)
    else:  # words of a piece that one giant word made long
        short = np.flatnonzero(ends - begins <= LONG)
        for at in range(0, len(short), 4096):
            own = short[at : at + 4096]
            packed = np.concatenate([data[b:e] for b, e in zip(begins[own], ends[own], strict=True)])
            sizes = np.cumsum(ends[own] - begins[own])
            hashes[own] = _short_hashes(packed, np.concatenate([[0], sizes[:-1]]), sizes)
    for i in long.tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[begins[i] : ends[i]].tobytes())
    return hashes, begins


def blocks(column: pa.Array, lower: bool = False, table: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, hashes, bounds) of each block: text i of the block has the words hashes[bounds[i] : bounds[i + 1]].

    The column holds strings without nulls. ``table`` says what each byte is read as."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    table, first = (_LOWER if lower else _PLAIN) if table is None else table, 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
        last = min(last, len(column))
        own = offsets[first : last + 1] - offsets[first]
        raw = data[offsets[first] : offsets[last]]
        hashes, begins, at = [], [], 0
        while at < len(raw):  # one piece, unless a single text is longer than a block
            to = len(raw)
            if to - at > 2 * BLOCK:
                to = at + BLOCK
                while to < len(raw) and not _SPACE[table[raw[to]]]:
                    step = np.flatnonzero(_SPACE[table[raw[to : to + BLOCK]]])
                    to = min(len(raw), to + (int(step[0]) if len(step) else BLOCK))
            found, where = _piece(table[raw[at:to]], own - at)
            hashes.append(found)
            begins.append(where + at)
            at = to
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        where = np.concatenate(begins) if begins else np.zeros(0, np.int64)
        yield first, last - first, flat, np.searchsorted(where, own)
        first = last


def runs_of(hashes: np.ndarray, size: int, seed: int = _BASE) -> np.ndarray:
    """An unmixed hash of each run of ``size`` words; size is at least 1. Runs that cross texts are made too."""
    done, have = None, 0  # of the leading ``have`` words
    power, width, n = hashes, 1, len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    while True:
        if size & width:
            if done is None:
                done, have = power, width
            else:  # the words so far, then ``width`` more
                m = min(len(done), len(power) - have)
                done = done[:m] * np.uint64(pow(seed, width, 1 << 64)) + power[have : have + m]
                have += width
        if have == size:
            return done[: n - size + 1]
        power = power[:-width] * np.uint64(pow(seed, width, 1 << 64)) + power[width:]
        width *= 2
