"""Scans of files: repositories by globs and bounds, and delta files against their catalogue."""

import fnmatch
import hashlib
from pathlib import PurePosixPath

import pytest

from lodestone.sources import files

TREE = {"a.py": "x = 1", "src/b.py": "y", "src/deep/c.md": "# t", "src/d.bin": "no", "README": "read", "docs/Changelog-1": "log", "tests/t.py": "t", "big.txt": "z" * 500, "e[1].rst": "e", "src/é.txt": "é", "x.MDX": "m", "release.sh": "r"}


@pytest.fixture
def tree(tmp_path):
    for path, body in TREE.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(body)
    (tmp_path / "src/bad.txt").write_bytes(b"a\xffb")
    return f"file://{tmp_path}"


def expected(include, exclude, most_bytes, most_files):
    hit = lambda p, globs: any(fnmatch.fnmatchcase(p, g) or fnmatch.fnmatchcase(PurePosixPath(p).name, g) for g in globs)
    known = lambda p: PurePosixPath(p).suffix.lower() in files.SUFFIXES or PurePosixPath(p).name.lower().startswith(files.STARTS)
    found = [p for p in [*TREE, "src/bad.txt"] if hit(p, include) and not hit(p, exclude) and known(p) and len(TREE.get(p, "abc").encode()) <= most_bytes]
    return set(sorted(found, key=lambda p: PurePosixPath(p).parts)[:most_files])


@pytest.mark.parametrize(("include", "exclude"), [(["*"], []), (["*.py", "src/*"], ["tests/*"]), (["[a-b].py", "e[[]1].rst"], []), (["?.py", "*.md?"], ["[!a]*"]), (["README*", "docs/*"], ["*.md"]), ([], [])])
def test_repository_files(spark, tree, include, exclude):
    for most_bytes, most_files in ((10_000, 100), (100, 100), (10_000, 3)):
        got = {r.path: r.text for r in files.repository_files(spark, tree, include, exclude, most_bytes, most_files).collect()}
        assert set(got) == expected(include, exclude, most_bytes, most_files)
        assert all(got[p] == TREE[p] for p in got if p in TREE)


def test_delta_files(spark, tmp_path):
    (tmp_path / "deltas").mkdir()
    bodies = {"a": "{}\n\n{}\n", "b": "{}\n", "c": "{}", "d": ""}
    for name, body in bodies.items():
        (tmp_path / f"deltas/{name}.jsonl").write_text(body)
    sha = lambda name: hashlib.sha256(bodies[name].encode()).hexdigest()
    rows = [(1, "deltas/a.jsonl", sha("a"), 2), (2, "deltas/b.jsonl", "0" * 64, 1), (3, "./deltas//c.jsonl", sha("c"), 2), (4, "deltas/d.jsonl", sha("d"), 0), (5, "../x.jsonl", sha("a"), 2), (6, "/etc/passwd", sha("a"), 2), (7, "deltas/no.jsonl", sha("a"), 2), (8, "deltas/../../y", sha("a"), 1)]
    catalog = spark.createDataFrame(rows, "sequence int, delta_path string, delta_sha256 string, row_count bigint")
    got = {r.sequence: r.fault for r in files.delta_faults(spark, catalog, f"file://{tmp_path}").collect()}
    assert got == {2: "hash", 3: "rows", 5: "outside", 6: "outside", 7: "missing", 8: "outside"}
