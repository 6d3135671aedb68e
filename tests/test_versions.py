"""Versions and specifiers against the packaging library."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lodestone.functions import versions

packaging = pytest.importorskip("packaging")
from packaging.requirements import InvalidRequirement, Requirement  # noqa: E402
from packaging.specifiers import InvalidSpecifier, SpecifierSet  # noqa: E402
from packaging.utils import canonicalize_name  # noqa: E402
from packaging.version import InvalidVersion, Version  # noqa: E402

VERSIONS = ["1", "1.0", "1.0.0", "v1.2", "1.2.3", "1.10", "2!1.0", "1.0a1", "1.0b2", "1.0rc1", "1.0.dev3", "1.0.post1", "1.0-2", "1.0a1.dev2", "1.0.post1.dev1", "1.1", "1.2.3.4", "0", "0.0", "3.0.0rc2", "x", "", "1.0+cpu", "2.0", "1.2rc1", "1.9.9"]
SPECIFIERS = ["", ">=1.0", ">1.0", "<1.0", "<=1.0", "==1.0", "==1.*", "!=1.*", "!=1.2.3", "~=1.2", "~=1.2.0", "~=1.0.1", ">=1.0,<2", ">=1.0a1", "==1.0rc1", "<1.0rc1", ">1.0.post0", ">=1,!=1.2.3,<1.10", "==2!1.0", "===1.0", "~=1", ">=x", ">=1.0.dev0", "==1.2.*", ">1.0a1", "<=1.0.post1"]


def expected(v, s):
    try:
        return SpecifierSet(s).contains(Version(v.split("+")[0]), prereleases=True)
    except (InvalidSpecifier, InvalidVersion):
        return None


def test_versions_sort(spark):
    known = [v for v in VERSIONS if v not in ("x", "") and "+" not in v]
    rows = spark.createDataFrame([(v,) for v in known], "v string").select("v", versions.version_key(F.col("v")).alias("k"))
    pairs = rows.join(rows.select(F.col("v").alias("w"), F.col("k").alias("l")), F.lit(True)).select("v", "w", (F.col("k") < F.col("l")).alias("less"), (F.col("k") == F.col("l")).alias("same")).collect()
    assert len(pairs) == len(known) ** 2
    assert not [(r.v, r.w) for r in pairs if r.less != (Version(r.v) < Version(r.w)) or r.same != (Version(r.v) == Version(r.w))]


def test_specifiers(spark):
    rows = spark.createDataFrame(list(itertools.product(VERSIONS, SPECIFIERS)), "v string, s string")
    got = rows.select("v", "s", versions.contains(F.col("v"), F.col("s")).alias("ok")).collect()
    wrong = [(r.v, r.s, r.ok, expected(r.v, r.s)) for r in got if r.ok != expected(r.v, r.s)]
    assert not wrong


def test_early_versions_need_a_clause_that_names_one(spark):
    rows = [("1.0rc1", ">=0.1", False), ("1.0rc1", ">=0.1a1", True), ("1.0", ">=0.1", True), ("1.0.dev1", "", False), ("1.0rc1", "!=1.0a1", False)]
    got = spark.createDataFrame(rows, "v string, s string, want boolean").select("want", versions.contains(F.col("v"), F.col("s"), early=False).alias("ok")).collect()
    assert all(r.ok == r.want for r in got)


def test_random_specifiers(spark):
    rng = random.Random(1)
    number = lambda: ".".join(str(rng.randrange(3)) for _ in range(rng.randrange(1, 4)))
    one = lambda: number() + rng.choice(["", "", "", "a1", "rc2", ".post1", ".dev2"])
    rows = [(one(), ",".join(rng.choice([">=", "<", "==", "!=", "<=", ">", "~="]) + one() for _ in range(rng.randrange(1, 4)))) for _ in range(1500)]
    got = spark.createDataFrame(rows, "v string, s string").select("v", "s", versions.contains(F.col("v"), F.col("s")).alias("ok")).collect()
    wrong = [(r.v, r.s, r.ok, expected(r.v, r.s)) for r in got if r.ok != expected(r.v, r.s)]
    assert not wrong


def test_requirements(spark):
    texts = ["numpy>=1.20, <2", "Foo_Bar[a,b] ~= 1.0", "x", "x (>=1)", "bad name >1", ">=1", "torch==2.*;python_version<'3'", "a.b-c  != 1.0", "", "x>=", "é>1"]
    got = {r.t: (r.package, r.requirement) for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", *versions.requirement(F.col("t"))).collect()}
    for t in texts:
        try:
            known = Requirement(t)
            want = known.name, ",".join(sorted(str(c) for c in known.specifier))
        except InvalidRequirement:
            want = None, None
        assert got[t] == want, t
    names = ["Foo__Bar", "a.b-c", "X"]
    assert [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(versions.canonical_name(F.col("n"))).collect()] == [canonicalize_name(n) for n in names]
