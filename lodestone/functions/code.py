"""Source code, markup and logs: chunks, symbols, signatures and tracebacks, a text at a time."""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a chunk, and import statements that stand before each chunk of a module.
MOST, IMPORTS = 8000, 30
# Headings, underlines, traceback frames, exceptions and what their messages name.
MARKDOWN_HEADING = re.compile(r"^(#{1,6})\s+(.+?)\s*$")
UNDERLINE = re.compile(r"^[=\-~^\"'`:+*#]{3,}\s*$")
FRAME = r'^\s*File "([^"]+)", line (\d+), in (.+?)\s*$'
EXCEPTION = r"^([A-Za-z_][\w.]*(?:Error|Exception)):\s*(.*)$"
NAMED = r"(?:unexpected keyword argument|has no attribute) ['\"]([^'\"]+)['\"]"
SPACES = r"(?U)[\s\x1c-\x1f]"
#: The characters of SPACES (fixed: the property White_Space, and four separators).
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SENTENCE = r"(?Usd)[\s\x1c-\x1f]*([^\s\x1c-\x1f].*?(?:[.!?]+(?=[\s\x1c-\x1f]|$)|[。！？]+|$))"
_DEFS = (ast.FunctionDef, ast.AsyncFunctionDef)


def parts(text: str, most: int = MOST) -> Iterator[tuple[str, int | None, int | None]]:
    """(text, first line, last line) of runs of lines of at most ``most`` characters, line breaks included; a text that fits has no lines, a longer line
    stays whole."""
    text = text.strip()
    if len(text) <= most:
        if text:
            yield text, None, None
        return
    lines = text.splitlines()
    begin, size = 0, 0
    for i, line in enumerate([*lines, None]):
        if line is None or (i > begin and size + len(line) + 1 > most):
            yield "\n".join(lines[begin:i]), begin + 1, i
            begin, size = i, 0
        size += 0 if line is None else len(line) + 1


def markup_chunks(text: str) -> Iterator[dict]:
    """Chunks of Markdown or reStructuredText by section. A heading's path holds as many of the titles before it as its level allows; within fences there are
    no headings, and an underlined one counts as level 2."""
    lines, path, begin, fenced = text.splitlines(), [], 0, False
    cuts: list[tuple[int, str]] = [(0, "")]
    for i, line in enumerate(lines):
        if line.strip().startswith("```"):
            fenced = not fenced
        if fenced:
            continue
        marked = MARKDOWN_HEADING.match(line)
        if marked or (i + 1 < len(lines) and UNDERLINE.match(lines[i + 1])):
            level, title = (len(marked[1]), marked[2].strip()) if marked else (2, line.strip())
            path = [*path[: level - 1], title]
            cuts.append((i, " > ".join(path)))
    for (begin, section), (end, _) in zip(cuts, [*cuts[1:], (len(lines), "")], strict=True):
        for part, first, last in parts("\n".join(lines[begin:end])):
            yield {"text": part, "section": section, "first_line": first, "last_line": last}


def python_chunks(text: str, path: str) -> Iterator[dict]:
    """One chunk for each class, up to its first method, function and method, after the module's first imports; the whole module where it defines nothing or
    does not parse."""
    module = path.removesuffix(".py").replace("/", ".")
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError):
        tree = None
    lines = text.splitlines()
    source = lambda node, end=None: "\n".join(lines[node.lineno - 1 : node.end_lineno if end is None else end])
    named = []
    for node in tree.body if tree else ():
        if isinstance(node, _DEFS):
            named.append((node, "function", node.name, None, source(node)))
        elif isinstance(node, ast.ClassDef):
            methods = [child for child in node.body if isinstance(child, _DEFS)]
            named.append((node, "class", node.name, None, source(node, methods[0].lineno - 1 if methods else None)))
            named += [(m, "method", f"{node.name}.{m.name}", node.name, f"class {node.name}:\n{source(m)}") for m in methods]
    imports = "\n".join([source(node) for node in (tree.body if tree else ()) if isinstance(node, (ast.Import, ast.ImportFrom))][:IMPORTS])
    found = [
        ({"symbol": f"{module}.{name}" if module else name, "symbol_type": kind, "parent": parent and (f"{module}.{parent}" if module else parent), "start_line": node.lineno, "end_line": node.end_lineno}, f"{imports}\n\n{body}" if imports else body)
        for node, kind, name, parent, body in named
    ]
    for extra, body in found or [({"symbol": None, "symbol_type": "module", "parent": None, "start_line": None, "end_line": None, "parsed": tree is not None}, text)]:
        for part, first, last in parts(body):
            yield {"text": part, "module": module, "first_line": first, "last_line": last} | extra


def symbols(text: str, path: str) -> list[dict]:
    """Classes, functions, methods, properties, imports and constants (upper-case names), with what they inherit, call or import."""
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError):
        return []
    module, out = path.removesuffix(".py").replace("/", "."), []

    def add(name: str, kind: str, relations: list[tuple[str, str]]) -> None:
        out.append({"name": f"{module}.{name}" if module else name, "kind": kind, "relations": sorted(set(relations))})

    def walk(nodes: list[ast.stmt], parent: str) -> None:
        for node in nodes:
            if isinstance(node, ast.ClassDef):
                add(parent + node.name, "class", [("inherits", ast.unparse(b)) for b in node.bases])
                walk(node.body, f"{parent}{node.name}.")
            elif isinstance(node, _DEFS):
                marks = {ast.unparse(d) for d in node.decorator_list}
                calls = [("calls", ast.unparse(x.func)) for x in ast.walk(node) if isinstance(x, ast.Call)]
                add(parent + node.name, "property" if "property" in marks else "method" if parent else "function", calls)
            elif isinstance(node, (ast.Import, ast.ImportFrom)) and not parent:
                base = "." * (getattr(node, "level", 0) or 0) + (getattr(node, "module", None) or "")
                for alias in node.names:
                    add(alias.asname or alias.name, "import", [("imports", f"{base}.{alias.name}" if base else alias.name)])
            elif isinstance(node, ast.Assign):
                for target in node.targets:
                    if isinstance(target, ast.Name) and target.id.isupper():
                        add(parent + target.id, "constant", [])

    walk(tree.body, "")
    return out


def _signature(value: str) -> tuple[dict[str, tuple[str | None, str | None]], str | None]:
    """(annotation, default) of each parameter of a signature "name(a, b: int = 1) -> str", and its result; nothing if it can't be read."""
    try:
        node = ast.parse(f"def {value}: ...").body[0]
    except (SyntaxError, ValueError):
        return {}, None
    told = lambda x: None if x is None else ast.unparse(x)
    args = node.args
    plain = args.posonlyargs + args.args
    defaults = [None] * (len(plain) - len(args.defaults)) + args.defaults
    pairs = [*zip(plain, defaults, strict=True), *zip(args.kwonlyargs, args.kw_defaults, strict=True), *((x, None) for x in (args.vararg, args.kwarg) if x)]
    return {a.arg: (told(a.annotation), told(d)) for a, d in pairs}, told(node.returns)


def signature_report(old: str, new: str) -> dict[str, list]:
    """Added and removed parameters, and what defaults, annotations and the result were and are."""
    (before, result), (after, now) = _signature(old), _signature(new)
    both = sorted(before.keys() & after.keys())
    moved = lambda i: [{"parameter": n, "from": before[n][i], "to": after[n][i]} for n in both if before[n][i] != after[n][i]]
    return {
        "added_parameters": sorted(after.keys() - before.keys()),
        "removed_parameters": sorted(before.keys() - after.keys()),
        "renamed_parameters": [],
        "default_changes": moved(1),
        "type_changes": moved(0),
        "return_changes": [{"from": result, "to": now}] if result != now else [],
    }


def signature_changes(old: str, new: str) -> dict:
    """``signature_report`` by names only."""
    told = signature_report(old, new)
    names = lambda c: [x["parameter"] for x in told[c]]
    return {"added": told["added_parameters"], "removed": told["removed_parameters"], "types": names("type_changes"), "defaults": names("default_changes"), "result_changed": bool(told["return_changes"])}


def _rowwise(df: DataFrame, columns: list[str], f: Callable[..., Iterator[dict]], fields: dict[str, str]) -> DataFrame:
    """(the key column, fields...): rows that f makes of each row's other columns, with their number in ``n``."""
    key = columns[0]
    schema = f"{key} {df.schema[key].dataType.simpleString()}, n int, " + ", ".join(f"{c} {kind}" for c, kind in fields.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = [(k, n, row) for k, *values in zip(*(part.column(i).to_pylist() for i in range(len(columns))), strict=True) for n, row in enumerate(f(*values))]
                if made:
                    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "array<string>": pa.list_(pa.string()), "boolean": pa.bool_()}
                    yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], part.schema.field(0).type), pa.array([m[1] for m in made], pa.int32()), *(pa.array([m[2].get(c) for m in made], kinds[kind]) for c, kind in fields.items())], names=[key, "n", *fields])

    return df.select(*columns).mapInArrow(run, schema)


def code_chunks(files: DataFrame, key: str, path: str, text: str) -> DataFrame:
    """(key, n, text, section, module, symbol, symbol_type, parent, first_line, last_line) of Python files by symbol and of all others by section."""

    def chunks(name: str | None, body: str | None) -> Iterator[dict]:
        return python_chunks(body or "", name) if (name or "").endswith(".py") else markup_chunks(body or "")

    return _rowwise(files, [key, path, text], chunks, {"text": "string", "section": "string", "module": "string", "symbol": "string", "symbol_type": "string", "parent": "string", "first_line": "int", "last_line": "int"})


def code_symbols(files: DataFrame, key: str, path: str, text: str) -> DataFrame:
    """(key, n, name, kind, relations) of Python files; a relation reads "calls name"."""

    def found(name: str | None, body: str | None) -> Iterator[dict]:
        return ({**s, "relations": [f"{a} {b}" for a, b in s["relations"]]} for s in symbols(body or "", name or ""))

    return _rowwise(files, [key, path, text], found, {"name": "string", "kind": "string", "relations": "array<string>"})


def signature_diffs(pairs: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """(key, n, added, removed, types, defaults, result_changed)."""
    return _rowwise(pairs, [key, old, new], lambda a, b: [signature_changes(a or "", b or "")], {"added": "array<string>", "removed": "array<string>", "types": "array<string>", "defaults": "array<string>", "result_changed": "boolean"})


def sentence_spans(texts: DataFrame, key: str, text: str, said: bool = False) -> DataFrame:
    """(key, n, begin, end): where sentences stand, without white space at their ends; with ``said`` also their texts in a column of that name. Keys are
    unique; null texts have none. A sentence is matched with the white space before it, so that lengths add up to places."""
    # an outer explode, since a filter inferred from an inner one would match the sentences again
    rows = texts.select(key, F.posexplode_outer(F.regexp_extract_all(text, F.lit(SENTENCE), 0)).alias("n", "s")).where("n IS NOT NULL")
    blanks = F.lit(BLANKS)
    # numbers alone are shuffled, unless the texts are asked for
    rows = rows.select(key, "n", F.length("s").alias("whole"), F.length(F.ltrim("s", blanks)).alias("core"), F.length(F.btrim("s", blanks)).alias("size"), *([F.btrim("s", blanks).alias("said")] if said else []))
    behind = F.sum("whole").over(Window.partitionBy(key).orderBy("n"))
    begin = (behind - F.col("core")).cast("int")
    return rows.select(key, "n", begin.alias("begin"), (begin + F.col("size")).alias("end"), *(["said"] if said else []))


def debug_log(log: Column, root: str) -> list[Column]:
    """(frames, project_frames, dependency_frames, last_function, exception, message, keywords) of a log with tracebacks; paths below ``root`` and relative ones are the project's."""
    lines = F.split(log, r"\r\n|\r|\n")
    frames = F.filter(lines, lambda line: line.rlike(FRAME))
    paths = F.transform(frames, lambda line: F.regexp_extract(line, FRAME, 1))
    inside = lambda p: ~p.startswith("/") | p.startswith(root.rstrip("/") + "/")
    last = F.element_at(F.concat(F.array(F.lit("")), F.filter(F.transform(lines, lambda line: F.trim(line)), lambda line: line.rlike(EXCEPTION))), -1)
    message = F.regexp_extract(last, EXCEPTION, 2)
    return [
        F.size(frames).cast("bigint").alias("frames"),
        F.size(F.filter(paths, inside)).cast("bigint").alias("project_frames"),
        F.size(F.filter(paths, lambda p: ~inside(p) & F.array_contains(F.split(p, "/"), "site-packages"))).cast("bigint").alias("dependency_frames"),
        F.regexp_extract(F.element_at(F.concat(F.array(F.lit("")), frames), -1), FRAME, 3).alias("last_function"),
        F.nullif(F.regexp_extract(last, EXCEPTION, 1), F.lit("")).alias("exception"),
        F.left(message, F.lit(2000)).alias("message"),
        F.array_sort(F.array_distinct(F.regexp_extract_all(message, F.lit(NAMED), 1))).alias("keywords"),
    ]
