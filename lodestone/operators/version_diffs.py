"""Source diffs between two versions of a library, one document for each symbol that changed.

Symbols of both versions meet in one full outer join, and the changed ones meet the files that hold them by library and path; a file's lines
are cut to a symbol's before any text leaves the join. A patch is a unified diff of at most BUDGET characters with three lines around each change, made
symbol by symbol in Arrow batches; everything else is Spark expressions.

Null paths have an empty text. Files that aren't there too. A symbol's text is at most LINES lines and BUDGET characters, as a document's patch is.
Names are unique within a library's version; symbols named twice give a document for each pair.
"""

from __future__ import annotations

import difflib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import code, hashing
from lodestone.functions.rows import rowwise
from lodestone.operators.changelog import symbol_status

# Bounds of a symbol's text and of a patch, lines around a change, and where lines break.
BUDGET, LINES, AROUND = 30_000, 500, 3
BREAK = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85  ]"
PROCESSOR = "code-version-diff-v1"


def unified(old: str, new: str, old_name: str, new_name: str, budget: int = BUDGET) -> str:
    """The lines that lead from one text to the other, cut at the budget."""
    return "\n".join(difflib.unified_diff(old.splitlines(), new.splitlines(), old_name, new_name, lineterm="", n=AROUND))[:budget]


def patch(old: str, new: str, old_name: str, new_name: str) -> Column:
    """``unified`` of columns."""
    return rowwise(unified, "string")(*map(F.col, (old, new, old_name, new_name)))


def signature_json(old: str, new: str) -> Column:
    """The changes of two signatures as JSON with sorted keys; no changes where one is missing."""
    told = lambda a, b: json.dumps({} if a is None or b is None else code.signature_report(a, b), ensure_ascii=False, sort_keys=True)
    return rowwise(told, "string")(F.col(old), F.col(new))


def lines_between(body: Column, first: Column, last: Column, most: int = LINES, budget: int = BUDGET) -> Column:
    """The lines first to last of a text, counted from 1, at most ``most`` of them and ``budget`` characters."""
    start = F.greatest(first, F.lit(1))
    count = F.greatest(F.least(last - start + 1, F.lit(most)), F.lit(0))
    return F.left(F.array_join(F.slice(F.split(body, BREAK), start.cast("int"), count.cast("int")), "\n"), F.lit(budget))


def changed_symbols(old: DataFrame, new: DataFrame, wanted: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """(library, name, status, confidence, old, new) of symbols whose status isn't "unchanged", in the order of names and no more than ``limit`` for
    each library if one is given. Both: (library, name, symbol_type, path, start_line, end_line, signature, ast_hash); wanted: (library, name)."""
    fields = ["symbol_type", "path", "start_line", "end_line", "signature", "ast_hash"]
    side = lambda df, c: df.select("library", "name", F.struct(*fields).alias(c))
    both = side(old, "old").join(side(new, "new"), ["library", "name"], "full_outer")
    both = both if wanted is None else both.join(wanted.select("library", "name").distinct(), ["library", "name"], "left_semi")
    both = both.withColumn("status", symbol_status(F.col("old"), F.col("new"))).where("status <> 'unchanged'")
    both = both.withColumn("confidence", F.when(F.col("status").isin("moved", "modified"), 0.8).otherwise(1.0))
    if limit is not None:
        from pyspark.sql import Window

        both = both.withColumn("nth", F.row_number().over(Window.partitionBy("library").orderBy("name"))).where(F.col("nth") <= limit).drop("nth")
    return both


def _summary(status: Column, changes: Column) -> Column:
    told = F.array_compact(F.array(*(F.when(F.get_json_object(changes, f"$.{c}") != "[]", F.concat(F.lit(f"{c}="), F.get_json_object(changes, f"$.{c}"))) for c in ("added_parameters", "removed_parameters", "default_changes"))))
    details = F.when(F.size(told) > 0, F.concat(F.lit(" Confirmed details: "), F.array_join(told, "; "), F.lit("."))).otherwise("")
    return F.concat(F.lit("Pinned source comparison classifies `"), F.col("name"), F.lit("` as `"), status, F.lit("` between "), F.col("from_version"), F.lit(" and "), F.col("to_version"), F.lit("."), details)


def diff_documents(changed: DataFrame, files: DataFrame, libraries: DataFrame, releases: DataFrame) -> DataFrame:
    """(document_id, library, symbol, status, confidence, title, source_url, content, content_hash, patch, changes, release_urls, ...) of ``changed_symbols``.
    files: (library, version, path, text); libraries: (library, package, repository, from_version, to_version, from_commit, to_commit, retrieved_at), a row
    for each; releases: (library, tag, url)."""
    rows = changed.join(libraries, "library")
    for side, version in (("old", "from_version"), ("new", "to_version")):
        held = files.select("library", F.col("version").alias(version), F.col("path").alias("at"), F.col("text").alias("body"))
        rows = rows.withColumn("at", F.col(f"{side}.path")).join(held, ["library", version, "at"], "left")
        text = lines_between(F.col("body"), F.col(f"{side}.start_line"), F.col(f"{side}.end_line"))
        rows = rows.withColumn(f"{side}_text", F.coalesce(text, F.lit(""))).drop("at", "body")
    plain = lambda c: F.regexp_replace(c, "^v", "")
    told = releases.where("url <> ''").select("library", plain(F.col("tag")).alias("tag"), "url")
    ends = libraries.select("library", F.explode(F.array_distinct(F.array(plain(F.col("from_version")), plain(F.col("to_version"))))).alias("tag"))
    urls = told.join(ends, ["library", "tag"]).groupBy("library").agg(F.array_sort(F.collect_set("url")).alias("release_urls"))
    rows = rows.join(urls, "library", "left").withColumn("release_urls", F.coalesce("release_urls", F.array().cast("array<string>")))
    name = lambda side, version: F.concat(version, F.lit("/"), F.coalesce(F.nullif(F.col(f"{side}.path"), F.lit("")), F.col("name")))
    rows = rows.withColumns({"old_name": name("old", F.col("from_version")), "new_name": name("new", F.col("to_version"))})
    rows = rows.withColumn("patch", patch("old_text", "new_text", "old_name", "new_name"))
    rows = rows.withColumn("changes", signature_json("old.signature", "new.signature"))
    content = F.concat(F.lit("# "), F.col("name"), F.lit("\n\n"), _summary(F.col("status"), F.col("changes")), F.lit("\n\n## Structured changes\n\n```json\n"), F.col("changes"), F.lit("\n```\n\n## Source patch\n\n```diff\n"), F.coalesce(F.nullif(F.col("patch"), F.lit("")), F.lit("(no textual patch available)")), F.lit("\n```"))
    rows = rows.withColumn("content", content)
    identity = F.left(hashing.sha256(F.array_join(F.array("repository", "from_version", "to_version", "name", "from_commit", "to_commit"), "\0")), F.lit(24))
    return rows.select(
        F.concat(F.lit("code-diff:"), F.col("repository"), F.lit("@"), F.col("from_version"), F.lit(".."), F.col("to_version"), F.lit(":"), identity).alias("document_id"),
        "library",
        F.col("name").alias("symbol"),
        F.coalesce("new.symbol_type", "old.symbol_type").alias("symbol_type"),
        "status",
        "confidence",
        F.concat(F.col("library"), F.lit(" "), F.col("from_version"), F.lit(" -> "), F.col("to_version"), F.lit(": "), F.col("name")).alias("title"),
        F.concat(F.lit("https://github.com/"), F.col("repository"), F.lit("/compare/"), F.col("from_commit"), F.lit("..."), F.col("to_commit")).alias("source_url"),
        F.coalesce(F.nullif(F.col("new.path"), F.lit("")), F.col("old.path")).alias("path"),
        "retrieved_at",
        "content",
        hashing.sha256(F.col("content")).alias("content_hash"),
        "patch",
        "changes",
        "release_urls",
        F.lit(PROCESSOR).alias("processor"),
    )


def build_summary(documents: DataFrame) -> DataFrame:
    """(library, status, documents): what a build made."""
    return documents.groupBy("library", "status").agg(F.count(F.lit(1)).alias("documents"))
