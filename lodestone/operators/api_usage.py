"""Which libraries a repository's Python files use: imports, calls, base classes, patched attributes and checks of versions.

A file's syntax tree is walked once, in Arrow batches, into rows of names with aliases resolved. Whether a name's first part is a library is settled by a
join: it must be imported in the same file or in one before it. Lists that the profile bounds keep their first rows, found in two steps, so that no library's
rows meet in one task.

Files that don't parse, or are null, use nothing. Order is that of paths by their parts, then of the walk, breadth first. Files in hidden folders,
environments and builds are left out; all others are read, however many a repository has.
"""

from __future__ import annotations

import ast
import json
import warnings
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.code import _rowwise

# How many rows of a kind are listed.
BOUNDS = {"call_sites": 500, "inherited_symbols": 200, "monkey_patches": 200, "detected_version_assumptions": 200}
SETS = ["imports", "symbols", "files"]
SPREAD = 64


def resolved(node: ast.AST, aliases: dict[str, str]) -> str:
    """A name or a chain of attributes with its alias resolved; other expressions as they are written."""
    parts: list[str] = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    parts.append(aliases.get(node.id, node.id) if isinstance(node, ast.Name) else ast.unparse(node))
    return ".".join(reversed(parts))


def _imported(node: ast.AST) -> list[tuple[str, str]]:
    if isinstance(node, ast.Import):
        return [(a.asname or a.name.partition(".")[0], a.name) for a in node.names]
    if isinstance(node, ast.ImportFrom) and node.module:
        return [(a.asname or a.name, f"{node.module}.{a.name}") for a in node.names if a.name != "*"]
    return []


def uses(body: str | None) -> Iterator[dict]:
    """(kind, value, line, detail) of a file: its imports first, then what may name a library."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            nodes = list(ast.walk(ast.parse(body or "")))
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return
    pairs = [pair for node in nodes for pair in _imported(node)]
    aliases = dict(pairs)
    yield from ({"kind": "imports", "value": name} for _, name in pairs)
    for node in nodes:
        told = lambda kind, value, **detail: {"kind": kind, "value": value, "line": node.lineno, "detail": json.dumps(detail, sort_keys=True)}  # noqa: E731, B023
        if isinstance(node, ast.Call):
            yield told("call_sites", resolved(node.func, aliases), parameters=[k.arg for k in node.keywords if k.arg], positional_arguments=len(node.args))
        elif isinstance(node, ast.ClassDef):
            yield from (told("inherited_symbols", resolved(base, aliases), **{"class": node.name}) for base in node.bases)
        elif isinstance(node, ast.Assign | ast.AnnAssign):
            targets = node.targets if isinstance(node, ast.Assign) else [node.target]
            yield from (told("monkey_patches", resolved(t, aliases)) for t in targets if isinstance(t, ast.Attribute))
        elif isinstance(node, ast.Compare):
            said = ast.unparse(node)
            yield from (told("detected_version_assumptions", name, expression=said) for local, name in aliases.items() if f"{local}.__version__" in said)


def _first(rows: DataFrame, by: list[str], order: list[str], most: Column) -> DataFrame:
    """The first ``most`` rows of each group, found in parts of the group first."""
    parts = rows.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(SPREAD)))
    some = parts.withColumn("nth", F.row_number().over(Window.partitionBy(*by, "part").orderBy(*order))).where(F.col("nth") <= most).drop("part")
    return some.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("nth") <= most)


def inventory(files: DataFrame) -> DataFrame:
    """(repository, library, kind, nth, path, line, value, detail): the rows of each repository's use of each library. files: (repository, path, text), paths
    unique in a repository. Values of the kinds of SETS are distinct and unordered (nth is null); the others are in order, at most BOUNDS of each."""
    hidden = F.exists(F.split("path", "/"), lambda p: p.startswith(".") | p.isin("venv", ".venv", "build"))
    own = files.where(F.col("path").endswith(".py") & ~hidden).withColumn("parts", F.split("path", "/"))
    own = own.withColumn("place", F.row_number().over(Window.partitionBy("repository").orderBy("parts")))
    own = own.select(F.to_json(F.struct("repository", "path", "place")).alias("file"), "text")
    rows = _rowwise(own, ["file", "text"], uses, {"kind": "string", "value": "string", "line": "int", "detail": "string"})
    rows = rows.withColumn("f", F.from_json("file", "repository string, path string, place int"))
    rows = rows.select("f.repository", "f.path", "f.place", "n", "kind", "value", "line", "detail", F.substring_index("value", ".", 1).alias("library"))
    known = rows.where("kind = 'imports'").groupBy("repository", "library").agg(F.min("place").alias("since"))
    rows = rows.join(known, ["repository", "library"]).where(F.col("place") >= F.col("since")).drop("since")
    none = lambda kind: F.lit(None).cast(kind)
    of = lambda kind, found, value: found.select("repository", "library", F.lit(kind).alias("kind"), none("int").alias("nth"), none("string").alias("path"), none("int").alias("line"), value.alias("value"), none("string").alias("detail")).distinct()
    imports = rows.where("kind = 'imports'")
    out = of("imports", imports, F.col("value")).unionByName(of("files", imports, F.col("path"))).unionByName(of("symbols", rows.where("kind = 'call_sites'"), F.col("value")))
    most = F.coalesce(*(F.when(F.col("kind") == kind, n) for kind, n in BOUNDS.items()))
    listed = _first(rows.where("kind <> 'imports'"), ["repository", "library", "kind"], ["place", "n"], most)
    return out.unionByName(listed.select("repository", "library", "kind", "nth", "path", "line", "value", "detail"))
