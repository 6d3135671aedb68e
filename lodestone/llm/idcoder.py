"""Adaptive context-mixing range coder for token ids, in independently reset blocks.

A block's ids are dealt to lanes, runs of equal length that are coded side by side, so that each
step of the coder is a few array operations over all lanes. All lanes share one model, which both
sides update after each step in the same way. It mixes three predictions of the next id: the id
last seen after the same two ids (order 2), the one last seen after the same id (order 1), and
the adaptive frequencies of all ids (order 0). The two candidates' confidences select a row of
weights, which learns how often each prediction is right; the mix of the three is the interval
that an arithmetic coder narrows, without carries, in 48 bits with 16-bit output.

Block: magic, number of ids, lanes, alphabet, checksum (CRC-32 of all that follows), the lanes'
lengths in 16-bit words, their words. A block that was cut or changed raises ValueError.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

_MAGIC = b"LCM2"
#: Ids are below this; each of them keeps a share of the order-0 interval.
ALPHABET = 1 << 18
#: Ids that a lane has about, and lanes at most.
LANE, LANES = 256, 4096
_WINDOW, _TOP, _BOTTOM, _MIX = 48, 32, 1 << 30, 24
_MASK = (1 << _WINDOW) - 1
_ORDER2 = 1 << 20
#: Order 0: what a seen id gains, the sum at which all halve, steps between two updates.
_GAIN, _SUM, _REFRESH = 16, 1 << 20, 8
#: Of the mix, at least this share is order 0's.
_LEAST = 1 << (_MIX - 4)
#: A candidate's confidence after a wrong and a right prediction, for each confidence before.
_NEXT = np.array([(max(held >> 1, 1), min(held + 1, 7)) for held in range(8)], np.int8).ravel()


class _Model:
    def __init__(self, alphabet: int, lanes: int) -> None:
        self.alphabet = alphabet
        # narrow, so that more of the tables stays in a core's cache
        self.guess2, self.sure2 = np.full(_ORDER2, -1, np.int32), np.zeros(_ORDER2, np.int8)
        self.guess1, self.sure1 = np.full(alphabet, -1, np.int32), np.zeros(alphabet, np.int8)
        self.counts = np.ones(alphabet, np.int64)
        self.weights = np.tile(np.array([4, 2, 10], np.int64), (64, 1))
        self.before, self.last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.waiting: list[np.ndarray] = []
        self._sum()

    def _sum(self) -> None:
        while int(self.counts.sum()) > _SUM and int(self.counts.max()) > 1:
            self.counts = (self.counts + 1) >> 1
        self.starts = np.zeros(self.alphabet + 1, np.int64)
        np.cumsum(self.counts, out=self.starts[1:])
        self.total = int(self.starts[-1])

    def predict(self) -> None:
        """The candidates and the parts of the mix for the next id of each lane."""
        self.at2 = ((self.before * 0x9E3779B1 + self.last * 0x85EBCA77) >> 7) & (_ORDER2 - 1)
        self.c2, self.c1 = self.guess2.take(self.at2), self.guess1.take(self.last)
        self.held2, self.held1 = self.sure2.take(self.at2), self.sure1.take(self.last)
        self.row = (self.held2 * 8 + self.held1).astype(np.int64)
        shares = (((1 << _MIX) - _LEAST) * self.weights[:, :2]) // self.weights.sum(axis=1)[:, None]
        self.f2 = shares[:, 0].take(self.row) * (self.c2 >= 0)
        self.f1 = shares[:, 1].take(self.row) * ((self.c1 >= 0) & (self.c1 != self.c2))
        self.f21 = self.f2 + self.f1
        self.f0 = (1 << _MIX) - self.f21

    def update(self, ids: np.ndarray) -> None:
        right2, right1 = ids == self.c2, ids == self.c1
        outcome = (2 - right1) * ~right2
        self.weights += np.bincount(self.row * 3 + outcome, minlength=192).reshape(64, 3)
        if int(self.weights.sum(axis=1).max()) > 1 << 16:
            self.weights = np.where(self.weights.sum(axis=1)[:, None] > 1 << 15, (self.weights + 1) >> 1, self.weights)
        for guess, sure, at, right, held in ((self.guess2, self.sure2, self.at2, right2, self.held2), (self.guess1, self.sure1, self.last, right1, self.held1)):
            change = ~right & (held <= 1)
            sure[at] = _NEXT.take(held * 2 + right)
            change = change.nonzero()[0]
            guess[at.take(change)] = ids.take(change)
        self.waiting.append(ids)
        if len(self.waiting) == _REFRESH:
            self.counts += _GAIN * np.bincount(np.concatenate(self.waiting), minlength=self.alphabet)
            self.waiting = []
            self._sum()
        self.before, self.last = self.last, ids


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // LANE))
    return lanes, -(-n // lanes)


def encode(ids: np.ndarray) -> bytes:
    """The block of the ids, which are not negative and below ALPHABET."""
    ids = np.asarray(ids, np.int64)
    if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= ALPHABET):
        raise ValueError(f"ids must be from 0 to {ALPHABET - 1}")
    n, alphabet = len(ids), int(ids.max(initial=0)) + 1
    lanes, steps = _shape(n)
    padded = np.zeros(lanes * steps, np.int64)
    padded[:n] = ids
    columns = padded.reshape(lanes, steps).T.copy()
    model, every = _Model(alphabet, lanes), np.arange(lanes)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, _MASK, np.int64)
    words, used = np.zeros((lanes, steps * 2 + 8), np.uint16), np.zeros(lanes, np.int64)
    for t in range(steps):
        now = columns[t]
        model.predict()
        begin = model.starts.take(now) * model.f0 // model.total
        size = model.starts.take(now + 1) * model.f0 // model.total - begin
        begin += model.f21
        hit1, hit2 = (now == model.c1) & (model.f1 > 0), (now == model.c2) & (model.f2 > 0)
        np.copyto(begin, model.f2, where=hit1)
        np.copyto(size, model.f1, where=hit1)
        np.copyto(begin, 0, where=hit2)
        np.copyto(size, model.f2, where=hit2)
        unit = span >> _MIX
        low += unit * begin
        span = unit * size
        at = every
        while True:
            lo, sp = low.take(at), span.take(at)
            same = ((lo ^ (lo + sp)) >> _TOP) == 0
            out = (same | (sp < _BOTTOM)).nonzero()[0]
            if not len(out):
                break
            at, lo = at.take(out), lo.take(out)
            sp = np.where(same.take(out), sp.take(out), -lo & (_BOTTOM - 1))
            words[at, used.take(at)] = lo >> _TOP
            used[at] += 1
            low[at], span[at] = (lo << 16) & _MASK, sp << 16
        model.update(now)
    for shift in (32, 16, 0):
        words[every, used] = (low >> shift) & 0xFFFF
        used += 1
    body = used.astype("<u4").tobytes() + words[np.arange(words.shape[1]) < used[:, None]].astype("<u2").tobytes()
    rest = struct.pack("<III", n, lanes, alphabet) + body
    return _MAGIC + struct.pack("<I", zlib.crc32(rest)) + rest


def decode(block: bytes) -> np.ndarray:
    """The ids of a block."""
    if len(block) < 20 or block[:4] != _MAGIC or zlib.crc32(block[8:]) != int.from_bytes(block[4:8], "little"):
        raise ValueError("the block was cut or changed")
    n, lanes, alphabet = struct.unpack_from("<III", block, 8)
    steps = _shape(n)[1]
    used = np.frombuffer(block, "<u4", lanes, 20).astype(np.int64)
    stream = np.concatenate([np.frombuffer(block, "<u2", offset=20 + 4 * lanes).astype(np.int64), np.zeros(4, np.int64)])
    place = np.cumsum(used) - used
    code = stream[place] << 32 | stream[place + 1] << 16 | stream[place + 2]
    place += 3
    end = len(stream) - 1
    model, every = _Model(alphabet, lanes), np.arange(lanes)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, _MASK, np.int64)
    columns = np.zeros((steps, lanes), np.int64)
    for t in range(steps):
        model.predict()
        unit = span >> _MIX
        value = np.minimum((code - low) // unit, (1 << _MIX) - 1)
        inner = np.maximum(value - model.f21, 0)
        now = np.searchsorted(model.starts, ((inner + 1) * model.total - 1) // model.f0, side="right") - 1
        begin = model.starts.take(now) * model.f0 // model.total
        size = model.starts.take(now + 1) * model.f0 // model.total - begin
        begin += model.f21
        hit2, hit1 = value < model.f2, (value >= model.f2) & (value < model.f21)
        for hit, ids, low_end, width in ((hit1, model.c1, model.f2, model.f1), (hit2, model.c2, 0, model.f2)):
            np.copyto(now, ids, where=hit)
            np.copyto(begin, low_end, where=hit)
            np.copyto(size, width, where=hit)
        low += unit * begin
        span = unit * size
        at = every
        while True:
            lo, sp = low.take(at), span.take(at)
            same = ((lo ^ (lo + sp)) >> _TOP) == 0
            out = (same | (sp < _BOTTOM)).nonzero()[0]
            if not len(out):
                break
            at, lo = at.take(out), lo.take(out)
            sp = np.where(same.take(out), sp.take(out), -lo & (_BOTTOM - 1))
            next_ = place.take(at)
            code[at] = (code.take(at) << 16) & _MASK | stream.take(np.minimum(next_, end))
            place[at] = next_ + 1
            low[at], span[at] = (lo << 16) & _MASK, sp << 16
        columns[t] = now
        model.update(now)
    return columns.T.reshape(-1)[:n].copy()
