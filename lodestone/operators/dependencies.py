"""Dependencies that repositories declare in files of six kinds, and whether an environment meets them.

All kinds become one row model: (repository, kind rank, path, line, source, text of a requirement). Line-based kinds are split by Spark; nested ones (TOML,
Python) are read by the standard library's parsers, a file at a time in Arrow batches, into the same rows. Then one expression reads every requirement and the
last declaration of a package wins, by kind, path and line. Environments meet requirements by one join on the package's canonical name, and the
specifier is judged by version keys, so no Python runs for a pair.

Null or unreadable files declare nothing; what is no requirement is left out. A marker is evaluated for the few variables it may name
(``MARKERS``); one that can't be read leaves its requirement out.
"""

from __future__ import annotations

import ast
import configparser
import re
import tomllib
import warnings
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import versions
from lodestone.functions.code import _rowwise

#: Files of a repository that list requirements, beyond which further ones aren't read; in order of their paths.
LISTS = 100
#: What kinds of scope a source's name tells, first match first.
SCOPES = [("setup\\.py:_deps", "catalog"), ("build", "build"), ("optional-dependencies", "optional"), ("dependency-groups|dev|test|lint|docs", "development")]
MARKERS = {"python_version": "3.12", "python_full_version": "3.12.0", "sys_platform": "linux", "platform_system": "Linux", "os_name": "posix", "platform_machine": "x86_64", "implementation_name": "cpython", "platform_python_implementation": "CPython", "extra": ""}
_LIST, _TREE = r"^requirements[^/]*\.txt$|^requirements/(?:.*/)?[^/]*\.txt$", r"^(?:environment\.ya?ml|pyproject\.toml|setup\.cfg|setup\.py)$"


def listed(files: DataFrame) -> DataFrame:
    """(repository, path, line, source, text) of requirement lists: no comments, options and blanks."""
    own = files.where(F.col("path").rlike(_LIST))
    own = own.withColumn("nth", F.row_number().over(Window.partitionBy("repository").orderBy(F.split("path", "/")))).where(F.col("nth") <= LISTS)
    lines = own.select("repository", "path", F.posexplode(F.split("text", r"\r\n|[\r\n\x0b\f]")).alias("line", "text"))
    text = F.trim(F.regexp_replace(F.split("text", " #", 2)[0], r"(?U)^\s+|\s+$", ""))
    return lines.select("repository", "path", "line", F.col("path").alias("source"), text.alias("text")).where(~F.col("text").rlike("^$|^[#-]"))


def _toml(body: str) -> Iterator[tuple[str, str]]:
    try:
        tree = tomllib.loads(body)
    except tomllib.TOMLDecodeError:
        return
    part = lambda *keys: next((x for x in [_down(tree, keys)] if x), None)
    groups = [("project.dependencies", part("project", "dependencies"))]
    groups += [(f"project.optional-dependencies.{g}", v) for g, v in (part("project", "optional-dependencies") or {}).items()]
    groups += [(f"dependency-groups.{g}", [x for x in v or () if isinstance(x, str)]) for g, v in (part("dependency-groups") or {}).items()]
    groups.append(("build-system.requires", part("build-system", "requires")))
    for name, values in groups:
        yield from ((f"pyproject.toml:{name}", str(v)) for v in values or ())


def _down(tree: object, keys: tuple[str, ...]) -> object:
    for key in keys:
        tree = tree.get(key) if isinstance(tree, dict) else None
    return tree


def _config(body: str) -> Iterator[tuple[str, str]]:
    parser = configparser.ConfigParser()
    try:
        parser.read_string(body)
        raw = parser.get("options", "install_requires", fallback="")
    except configparser.Error:
        return
    yield from (("setup.cfg:options.install_requires", x.strip()) for x in raw.splitlines() if x.strip())


def _literal(node: ast.expr | None) -> list:
    try:
        value = ast.literal_eval(node) if node is not None else None
    except (ValueError, TypeError, SyntaxError, MemoryError, RecursionError):
        return []
    return [x for x in value if isinstance(x, str)] if isinstance(value, list) else []


def _setup(body: str) -> Iterator[tuple[str, str]]:
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(body)
    except (SyntaxError, ValueError):
        return
    for node in tree.body:
        targets = node.targets if isinstance(node, ast.Assign) else [node.target] if isinstance(node, ast.AnnAssign) else []
        if any(isinstance(t, ast.Name) and t.id == "_deps" for t in targets):
            yield from (("setup.py:_deps", x) for x in _literal(node.value))
    for node in ast.walk(tree):
        if isinstance(node, ast.Call) and (getattr(node.func, "id", None) == "setup" or getattr(node.func, "attr", None) == "setup"):
            given = next((k for k in node.keywords if k.arg == "install_requires"), None)
            yield from (("setup.py:setup.install_requires", x) for x in _literal(given.value if given else None))


_ITEM = re.compile(r"^(\s*)-\s+(.*?)\s*$")


def _environment(body: str, name: str) -> Iterator[tuple[str, str]]:
    """The items of the top-level list "dependencies", and of its "pip" list. Block lists only; a quoted item loses its quotes."""
    inside, depth, pip = False, None, None
    for line in body.splitlines():
        line = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if not line:
            continue
        if re.match(r"^\S", line) and not line.startswith("-"):
            inside, depth, pip = line == "dependencies:", None, None
            continue
        found = _ITEM.match(line)
        if not inside or not found:
            continue
        indent, item = len(found[1]), found[2].strip("'\"")
        depth = indent if depth is None else depth
        if indent > depth and pip is not None:
            yield f"{name}:pip", item
        elif indent == depth:
            pip = True if item == "pip:" else None
            if pip is None:
                # a single "=" stands for "=="
                plain = "=" in item and not re.search(r"==|>=|<=|!=|~=", item)
                yield name, item.replace("=", "==", 1) if plain else item


def nested(files: DataFrame) -> DataFrame:
    """(repository, path, line, source, text) of files that hold requirements below keys or in code."""
    own = files.where(F.col("path").rlike(_TREE)).withColumn("file", F.struct("repository", "path"))
    own = own.select(F.to_json("file").alias("file"), "path", F.coalesce("text", F.lit("")).alias("text"))

    def read(path: str, body: str) -> list[dict]:
        made = _toml(body) if path == "pyproject.toml" else _config(body) if path == "setup.cfg" else _setup(body) if path == "setup.py" else _environment(body, path)
        return [{"source": s, "text": t} for s, t in made]

    rows = _rowwise(own, ["file", "path", "text"], read, {"source": "string", "text": "string"})
    file = F.from_json("file", "repository string, path string")
    return rows.select(file["repository"].alias("repository"), file["path"].alias("path"), F.col("n").alias("line"), "source", "text")


def applies(text: Column, values: dict[str, str] | None = None) -> Column:
    """Whether a requirement's marker holds: comparisons joined by "and" and "or" without parentheses, of a variable and a quoted text. Null if it can't be
    read, true without one."""
    known = values or MARKERS
    marker = F.trim(F.regexp_extract(text, r";(.*)$", 1))
    form = r"^\s*([a-z_]+)\s*(===|==|!=|<=|>=|<|>|~=|not in|in)\s*['\"]([^'\"]*)['\"]\s*$"

    def one(c: Column) -> Column:
        name, op, value = (F.regexp_extract(c, form, i) for i in (1, 2, 3))
        own = F.create_map(*(F.lit(x) for kv in known.items() for x in kv))
        left = F.try_element_at(own, name)
        texts = F.when(op.isin("==", "==="), left == value).when(op == "!=", left != value).when(op == "in", F.contains(value, left)).when(op == "not in", ~F.contains(value, left))
        is_version = name.isin("python_version", "python_full_version") & op.isin("==", "!=", "<=", ">=", "<", ">", "~=")
        by_version = F.get(F.transform(F.array(F.struct(versions.version_key(left).alias("v"), versions.clauses(F.concat(op, value)).alias("cs"))), lambda x: F.forall(x["cs"], lambda k: versions.satisfied(x["v"], k))), F.lit(0))
        return F.when(c.rlike(form) & left.isNotNull(), F.when(is_version, by_version).otherwise(texts))

    either = F.transform(F.split(marker, r"\s+or\s+"), lambda o: F.transform(F.split(o, r"\s+and\s+"), one))
    unread = F.exists(either, lambda o: F.exists(o, lambda x: x.isNull()))
    return F.when(~F.contains(text, F.lit(";")), F.lit(True)).when(~unread, F.exists(either, lambda o: F.forall(o, lambda x: x)))


def scope(source: Column) -> Column:
    lowered = F.lower(source)
    return F.coalesce(*(F.when(lowered.rlike(p), name) for p, name in SCOPES), F.lit("declared"))


def dependencies(files: DataFrame, markers: dict[str, str] | None = None) -> DataFrame:
    """(repository, canonical, package, requirement, source, scope, relation): a row for each package that a repository declares. files: (repository, path,
    text), paths below the repository's root and unique in it."""
    kind = F.col("path")
    rank = F.when(kind.rlike(_LIST), 0).when(kind == "environment.yml", 1).when(kind == "environment.yaml", 2).when(kind == "pyproject.toml", 3).when(kind == "setup.cfg", 4).otherwise(5)
    rows = listed(files).unionByName(nested(files)).withColumn("rank", rank)
    read = rows.where(F.coalesce(applies(F.col("text"), markers), F.lit(False))).select("repository", "rank", "path", "line", "source", *versions.requirement(F.col("text"))).where("package IS NOT NULL")
    last = F.max_by(F.struct("package", "requirement", "source"), F.struct("rank", F.split("path", "/").alias("path"), "line"))
    found = read.withColumn("canonical", versions.canonical_name(F.col("package"))).groupBy("repository", "canonical").agg(last.alias("d"))
    found = found.select("repository", "canonical", "d.*").withColumn("scope", scope(F.col("source")))
    return found.withColumn("relation", F.when(F.col("scope") == "catalog", "lists_dependency").otherwise("declares_dependency"))


def to_libraries(found: DataFrame, libraries: DataFrame) -> DataFrame:
    """``dependencies`` with target_library, the library of the package, if there is one. libraries: (library, package)."""
    named = libraries.select(versions.canonical_name(F.col("package")).alias("canonical"), F.col("library").alias("target_library"))
    named = named.groupBy("canonical").agg(F.max("target_library").alias("target_library"))
    return found.join(named, "canonical", "left")


def compatibility(found: DataFrame, selected: DataFrame, packages: DataFrame) -> DataFrame:
    """(repository, environment, canonical, package, requirement, environment_version, status, basis) of every dependency in the repository's selected
    environments. selected: (repository, environment); packages: (environment, package, version); a package's own spelling goes before its canonical one."""
    rows = found.select("repository", "canonical", "package", "requirement").join(selected.select("repository", "environment").distinct(), "repository")
    named = packages.select("environment", F.col("package").alias("name"), "version")
    asked = rows.select("repository", "canonical", "environment", F.posexplode(F.array_distinct(F.array("package", "canonical"))).alias("nth", "name"))
    held = asked.join(named, ["environment", "name"]).groupBy("repository", "canonical", "environment").agg(F.min_by("version", "nth").alias("environment_version"))
    rows = rows.join(held, ["repository", "canonical", "environment"], "left")
    rows = rows.withColumn("ok", versions.contains(F.col("environment_version"), F.col("requirement")))
    missing, free, ok = F.col("environment_version").isNull(), F.col("requirement") == "", F.col("ok")
    status = F.when(missing | free, "unknown").when(ok, "likely_compatible").when(~ok, "conflict").otherwise("unknown")
    basis = F.when(missing, "package is not present in the selected environment profile").when(free, "repository does not declare a version range").when(ok.isNull(), "version value could not be normalized").otherwise("declared requirement comparison; runtime behavior is not yet verified")
    return rows.select("repository", "environment", "canonical", "package", "requirement", "environment_version", status.alias("status"), basis.alias("basis"))
