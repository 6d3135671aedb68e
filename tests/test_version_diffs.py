"""Patches that apply again, bounds, names that one version lacks, and the texts around them."""

import difflib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.operators import version_diffs as diffs

SYMBOL = "library string, name string, symbol_type string, path string, start_line int, end_line int, signature string, ast_hash string"


def applied(old, patch):
    """The text that a unified diff makes of a text."""
    out, at = [], 0
    for line in patch.splitlines()[2:]:
        if m := re.match(r"@@ -(\d+)(?:,(\d+))? ", line):
            start = int(m[1]) - (m[2] != "0")
            out += old[at:start]
            at = start
        elif line[0] == "+":
            out.append(line[1:])
        else:
            assert old[at] == line[1:]
            out += [old[at]] * (line[0] == " ")
            at += 1
    return out + old[at:]


def build(spark, old, new, files, wanted=None, limit=None):
    frame = lambda rows: spark.createDataFrame(rows, SYMBOL)
    libraries = spark.createDataFrame([("lib", "pkg", "org/lib", "1.0", "v2.0", "a" * 40, "b" * 40, "2024")], "library string, package string, repository string, from_version string, to_version string, from_commit string, to_commit string, retrieved_at string")
    releases = spark.createDataFrame([("lib", "v1.0", "u1"), ("lib", "2.0", "u2"), ("lib", "2.0", "u2"), ("lib", "9", "u9"), ("lib", "1.0", None), ("other", "1.0", "x")], "library string, tag string, url string")
    held = spark.createDataFrame(files, "library string, version string, path string, text string")
    return diffs.diff_documents(diffs.changed_symbols(frame(old), frame(new), wanted, limit), held, libraries, releases)


def test_patches_apply_again(spark):
    rng = random.Random(4)
    old, new, files, texts = [], [], [], {}
    for i in range(40):
        a = [rng.choice("abcde") * rng.randrange(4) for _ in range(rng.randrange(60))]
        b = [x if rng.random() < 0.8 else rng.choice("xyz") for x in a if rng.random() < 0.9] + ["é"] * rng.randrange(2)
        texts[f"s{i}"] = a, b
        for rows, version, lines in ((old, "1.0", a), (new, "v2.0", b)):
            rows.append(("lib", f"s{i}", "function", f"s{i}.py", 2, 1 + len(lines), f"s{i}(a)", f"{version}{lines}"))
            files.append(("lib", version, f"s{i}.py", "\n".join(["import x", *lines, "behind"])))
    got = build(spark, old, new, files).collect()
    assert len(got) == 40
    for r in got:
        a, b = ("\n".join(x).splitlines() for x in texts[r.symbol])  # empty lines at the end go, as the texts are read
        assert r.patch == "\n".join(difflib.unified_diff(a, b, f"1.0/{r.symbol}.py", f"v2.0/{r.symbol}.py", lineterm="", n=3))
        assert (applied(a, r.patch) if r.patch else a) == b
        assert r.release_urls == ["u1", "u2"]


def test_bounds_and_missing_sides(spark):
    long = "\n".join(f"line {i} " + "x" * 200 for i in range(2000))
    old = [("lib", "gone", "class", "g.py", 1, 3, "gone()", "1"), ("lib", "long", "class", "l.py", 1, 2000, "long", "1"), ("lib", "same", "class", "g.py", 1, 1, "same", "1"), ("lib", "lost", "class", "no.py", 1, 2, "lost(a: int = 1)", "1")]
    new = [("lib", "made", "method", None, 0, 2, "made()", "1"), ("lib", "long", "class", "l.py", 1, 2000, "long", "2"), ("lib", "same", "class", "g.py", 1, 1, "same", "1"), ("lib", "lost", "class", "no.py", 1, 2, "lost(a: str = 2, *b) -> int", "2")]
    files = [("lib", "1.0", "g.py", "a\r\nb\x0cc"), ("lib", "1.0", "l.py", long), ("lib", "v2.0", "l.py", long.replace("line", "row"))]
    got = {r.symbol: r for r in build(spark, old, new, files).collect()}
    assert {s: r.status for s, r in got.items()} == {"gone": "removed", "long": "modified", "made": "introduced", "lost": "signature_changed"}
    assert got["gone"].patch.splitlines()[2:] == ["@@ -1,3 +0,0 @@", "-a", "-b", "-c"]
    assert len(got["long"].patch) == diffs.BUDGET and got["made"].patch == "" and "(no textual patch available)" in got["made"].content
    changes = json.loads(got["lost"].changes)
    assert changes["added_parameters"] == ["b"] and changes["default_changes"] == [{"parameter": "a", "from": "1", "to": "2"}] and changes["type_changes"] == [{"parameter": "a", "from": "int", "to": "str"}] and changes["return_changes"] == [{"from": None, "to": "int"}]
    assert 'Confirmed details: added_parameters=["b"]; default_changes=[{' in got["lost"].content


@pytest.mark.parametrize("limit", [1, 2])
def test_wanted_and_limit(spark, limit):
    rows = [("lib", n, "class", "g.py", 1, 1, n, n) for n in ("c", "a", "b")]
    got = build(spark, rows, [], [("lib", "1.0", "g.py", "x")], limit=limit).collect()
    assert sorted(r.symbol for r in got) == ["a", "b"][:limit]
    wanted = spark.createDataFrame([("lib", "c"), ("lib", "c")], "library string, name string")
    assert [r.symbol for r in build(spark, rows, [], [], wanted).collect()] == ["c"]
    assert build(spark, [], [], []).count() == 0


def test_query_makes_lines_once(spark):
    """Each scan of the documents makes their lines once, however many expressions use them."""
    from lodestone import catalog

    plan = catalog.QUERIES["c4_v9_version_diffs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("split(coalesce(text") <= 4
