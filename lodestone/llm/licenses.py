"""License scans by ordered signature rules.

A text is normalised to words (A-Z lower-cased; letters, digits and non-ASCII characters) joined
by one space. An Aho-Corasick automaton finds the rules' keywords in one pass; only rules whose
keyword stands in the text are tried. Their matches are detections: intervals of words with a
label and the rule's priority. They are resolved in order of priority, longer and earlier ones
first among equals, and a detection that lies within an accepted one is suppressed (a tree of running
maxima over the accepted ones' starts finds that out, so a text of many notices stays cheap). The base
phrases are found by the same automaton at whole words; they are never suppressed.

The score is 1 - 1 / (1 + matched words / 4), so 0 without detections. Null texts are empty, with
no words; the whole of long texts is scanned. Rows are independent, so ties and repeated rows
need no care; only the named columns are read, whatever others are called. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.license_rules import RULES

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


class Rule(NamedTuple):
    priority: int
    label: str
    pattern: re.Pattern


class Detection(NamedTuple):
    first: int  # word
    last: int  # word
    label: str
    priority: int


@lru_cache(maxsize=1)
def _machine(rules: str = RULES):  # noqa: ANN202
    """The automaton over keywords and base phrases: keyword -> (its rules, its base label)."""
    import ahocorasick

    found: dict[str, list[Rule]] = {phrase: [] for phrase in BASE}
    for priority, line in enumerate(x for x in rules.splitlines() if x.strip()):
        label, keyword, pattern = (x.strip() for x in line.split(" | ", 2))
        found.setdefault(keyword, []).append(Rule(priority, label, re.compile(f"(?<![^ ])(?:{pattern})(?![^ ])")))
    machine = ahocorasick.Automaton()
    for keyword, own in found.items():
        machine.add_word(keyword, (len(keyword), own, BASE.get(keyword)))
    machine.make_automaton()
    return machine


def normalised(text: str | None) -> tuple[str, int]:
    """The words joined by one space, and their number."""
    words = (text or "").encode().translate(_WORDS).split()
    return b" ".join(words).decode(), len(words)


def scan(text: str | None) -> tuple[int, list[tuple[int, str]], list[Detection]]:
    """The number of words, the base places (first word, label) and the detections that stay, both in order of the text."""
    norm, n = normalised(text)
    base, tried = [], {}
    for end, (length, rules, label) in _machine().iter(norm):
        begin = end - length + 1
        if label and (begin == 0 or norm[begin - 1] == " ") and (end + 1 == len(norm) or norm[end + 1] == " "):
            base.append((begin, label))
        for rule in rules:
            tried[rule.priority] = rule
    if not tried:
        return n, [], []
    spaces = np.flatnonzero(np.frombuffer(norm.encode("utf-32-le"), np.uint32) == 32)
    word = lambda at: int(np.searchsorted(spaces, at))
    hits = [(m.start(), m.end(), r) for r in tried.values() for m in r.pattern.finditer(norm) if m.end() > m.start()]
    places = {begin: i for i, begin in enumerate(sorted({begin for begin, _, _ in hits}), 1)}
    furthest = [0] * (len(places) + 1)  # the greatest end of accepted detections, by start
    kept: list[tuple[int, int, Rule]] = []
    for begin, end, rule in sorted(hits, key=lambda x: (x[2].priority, x[0] - x[1], x[0])):
        at, most = places[begin], 0
        while at:
            most, at = max(most, furthest[at]), at & (at - 1)
        if most < end:
            kept.append((begin, end, rule))
            at = places[begin]
            while at < len(furthest):
                furthest[at], at = max(furthest[at], end), at + (at & -at)
    found = sorted(Detection(word(a), word(b - 1), r.label, r.priority) for a, b, r in kept)
    return n, [(word(at), label) for at, label in sorted(base)], found


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) of each row."""
    one = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())])
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(text.as_py()) for text in batch.column(1)]
            base = [[at for at, _ in b] for _, b, _ in rows]
            base_labels = [{x for _, x in b} for _, b, _ in rows]
            covered = [sum(d.last - d.first + 1 for d in found) for _, _, found in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([len(b) for b in base], pa.int64()),
                    pa.array([min(b, default=None) for b in base], pa.int64()),
                    pa.array([max(b, default=None) for b in base], pa.int64()),
                    pa.array([",".join(sorted(x)) for x in base_labels]),
                    pa.array([",".join(sorted(x | {d.label for d in found})) for x, (_, _, found) in zip(base_labels, rows, strict=True)]),
                    pa.array([1 - 1 / (1 + c / 4) for c in covered], pa.float64()),
                    pa.array([[{"first": d.first, "last": d.last, "label": d.label} for d in found] for _, _, found in rows], pa.list_(one)),
                ],
                names=names,
            )

    schema = f"id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, detections array<struct<first:bigint,last:bigint,label:string>>"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
