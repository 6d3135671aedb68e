"""A rule is tried only where its keyword stands, so each match of its expression must hold the keyword."""

import itertools
from re import _constants as kind
from re import _parser as parser

import pytest

from lodestone.llm import licenses
from lodestone.llm.license_rules import RULES

LINES = [line.split(" | ", 2) for line in RULES.splitlines() if line.strip()]


def expansions(parsed):
    """The strings that an expression matches; "~" stands for what a wildcard matches, repeats are taken at their least and at most once more."""
    parts = []
    for op, arg in parsed:
        if op is kind.LITERAL:
            parts.append([chr(arg)])
        elif op is kind.IN:
            parts.append([chr(x[1]) if x[0] is kind.LITERAL else "~" for x in arg])
        elif op is kind.ANY:
            parts.append(["~"])
        elif op is kind.SUBPATTERN:
            parts.append(expansions(arg[-1]))
        elif op is kind.BRANCH:
            parts.append([s for branch in arg[1] for s in expansions(branch)])
        elif op in (kind.MAX_REPEAT, kind.MIN_REPEAT):
            low, high, inner = arg
            own = expansions(inner)
            parts.append([s for n in {low, min(low + 1, high)} for s in map("".join, itertools.product(own, repeat=n))])
        elif op is kind.ASSERT_NOT:
            continue
        else:
            raise AssertionError(op)
    return list(map("".join, itertools.product(*parts)))


def test_keywords_stand_in_every_match():
    assert [(label, s) for label, keyword, pattern in LINES for s in expansions(parser.parse(pattern.strip())) if keyword.strip() not in s] == []


@pytest.mark.parametrize(("text", "label"), [("End User Licence Agreement", "eula"), ("This software is licensed, not sold.", "proprietary"), ("the zlib/libpng License", "zlib")])
def test_keyword_misses(text, label):
    assert label in {d.label for d in licenses.scan(text)[2]}
