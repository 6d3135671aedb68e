"""Queries of version diffs and dependencies on files made of the tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.operators import dependencies, version_diffs
from lodestone.registry import query, table

_SUMMARY = "'Pinned source comparison classifies `' || name || '` as `' || status || '` between 1.0 and 2.0.'"


@query(f"""
    WITH l AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(x) > 0 AND NOT regexp_matches(x, '[\\x0b\\f\\r\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]')) AS ls FROM documents),
    b AS (SELECT doc_id, list_transform(ls, lambda x, i: i || ': ' || x) AS ls, len(ls) AS n, doc_id % 6 AS kind, 'lib' || doc_id % 3 AS library, 'f' || doc_id AS name FROM l),
    s AS (
        SELECT *, CASE kind WHEN 0 THEN 'introduced' WHEN 1 THEN 'removed' WHEN 2 THEN 'signature_changed' WHEN 3 THEN 'moved' ELSE 'modified' END AS status,
               least(n, 500)::BIGINT AS m, least(doc_id % 7, n - 1)::BIGINT AS k
        FROM b WHERE n > 0 AND kind <> 5),
    h AS (
        SELECT *, greatest(0, k - 3) AS lo, least(m, k + 4) AS hi, left(array_to_string(ls[1:500], chr(10)), 30000) AS whole,
               '--- 1.0/' || name || CASE WHEN kind = 0 THEN '' ELSE '.py' END || chr(10) || '+++ 2.0/' || CASE WHEN kind = 1 THEN name WHEN kind = 3 THEN 'new/' || name || '.py' ELSE name || '.py' END || chr(10) AS head FROM s
        WHERE length(array_to_string(ls[1:500], chr(10))) < 29000),
    p AS (
        SELECT *, CASE WHEN kind = 3 THEN '' ELSE left(CASE
                   WHEN kind = 0 THEN head || '@@ -0,0 +1' || CASE WHEN m = 1 THEN '' ELSE ',' || m END || ' @@' || chr(10) || '+' || replace(whole, chr(10), chr(10) || '+')
                   WHEN kind = 1 THEN head || '@@ -1' || CASE WHEN m = 1 THEN '' ELSE ',' || m END || ' +0,0 @@' || chr(10) || '-' || replace(whole, chr(10), chr(10) || '-')
                   ELSE head || '@@ -' || (lo + 1) || CASE WHEN hi - lo = 1 THEN '' ELSE ',' || (hi - lo) END || ' +' || (lo + 1) || CASE WHEN hi - lo = 1 THEN '' ELSE ',' || (hi - lo) END || ' @@' || chr(10)
                        || array_to_string(list_concat(list_transform(ls[lo + 1 : k], lambda x: ' ' || x), ['-' || ls[k + 1], '+changed'], list_transform(ls[k + 2 : hi], lambda x: ' ' || x)), chr(10)) END, 30000) END AS patch
        FROM h),
    c AS (
        SELECT *, CASE WHEN kind IN (0, 1) THEN '{{}}' WHEN kind = 2 THEN '{{"added_parameters": ["b"], "default_changes": [], "removed_parameters": [], "renamed_parameters": [], "return_changes": [{{"from": null, "to": "str"}}], "type_changes": []}}'
                       ELSE '{{"added_parameters": [], "default_changes": [], "removed_parameters": [], "renamed_parameters": [], "return_changes": [], "type_changes": []}}' END AS changes,
               {_SUMMARY} || CASE WHEN kind = 2 THEN ' Confirmed details: added_parameters=["b"].' ELSE '' END AS told FROM p)
    SELECT library, name AS symbol, status, CASE WHEN kind IN (3, 4) THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS confidence, sha256(patch) AS patch_sha256,
           sha256('# ' || name || chr(10) || chr(10) || told || chr(10) || chr(10) || '## Structured changes' || chr(10) || chr(10) || '```json' || chr(10) || changes || chr(10) || '```' || chr(10) || chr(10) || '## Source patch'
                  || chr(10) || chr(10) || '```diff' || chr(10) || CASE WHEN patch = '' THEN '(no textual patch available)' ELSE patch END || chr(10) || '```') AS content_hash,
           'code-diff:org/' || library || '@1.0..2.0:' || left(sha256('org/' || library || chr(0) || '1.0' || chr(0) || '2.0' || chr(0) || name || chr(0) || 'aaa' || chr(0) || 'bbb'), 24) AS document_id,
           CASE WHEN library = 'lib1' THEN 'https://x/1,https://x/2' ELSE '' END AS release_urls
    FROM c""")
def c4_v9_version_diffs(spark, sf_dir):  # noqa: ANN001, ANN201
    d, kind = F.col("doc_id"), F.col("doc_id") % 6
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: (F.length(x) > 0) & ~x.rlike(version_diffs.BREAK))
    lines = F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(": "), x))
    # an explode of one value, since all expressions that use the lines would else repeat their making, those below even for each line
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(F.array(lines)).alias("ls")).where(F.size("ls") > 0)
    rows = rows.where(F.length(F.array_join(F.slice("ls", 1, 500), "\n")) < 29000)  # where a patch holds the whole text, its last lines would be cut
    rows = rows.select(d, "ls", F.size("ls").alias("n"), F.concat(F.lit("lib"), (d % 3).cast("string")).alias("library"), F.concat(F.lit("f"), d.cast("string")).alias("name"))
    at = F.least(d % 7, F.col("n") - 1)
    new = F.when(kind.isin(2, 4), F.transform("ls", lambda x, i: F.when(i == at, "changed").otherwise(x))).otherwise(F.col("ls"))
    file = F.concat(F.col("name"), F.lit(".py"))
    moved = F.when(kind == 3, F.concat(F.lit("new/"), file)).otherwise(file)
    held = lambda version, path, body: F.struct(F.lit(version).alias("version"), path.alias("path"), F.concat(F.lit("import x\n"), F.array_join(body, "\n"), F.lit("\n")).alias("text"))
    files = rows.select("library", F.inline(F.array(held("1.0", file, F.col("ls")), held("2.0", moved, new))))
    symbol = lambda path, signature, digest: [F.lit("function").alias("symbol_type"), path.alias("path"), F.lit(2).alias("start_line"), (F.col("n") + 1).alias("end_line"), signature.alias("signature"), digest.alias("ast_hash")]
    plain = F.concat(F.col("name"), F.lit("(a)"))
    old = rows.where(kind != 0).select("library", "name", *symbol(file, plain, F.lit("h")))
    signature = F.when(kind == 2, F.concat(F.col("name"), F.lit("(a, b) -> str"))).otherwise(plain)
    fresh = rows.where(kind != 1).select("library", "name", *symbol(moved, signature, F.when(kind == 5, "h").otherwise("i")))
    named = table(spark, sf_dir, "documents").select(F.concat(F.lit("lib"), (d % 3).cast("string")).alias("library")).distinct()
    libraries = named.select("library", F.col("library").alias("package"), F.concat(F.lit("org/"), F.col("library")).alias("repository"), F.lit("1.0").alias("from_version"), F.lit("2.0").alias("to_version"), F.lit("aaa").alias("from_commit"), F.lit("bbb").alias("to_commit"), F.lit("2024-01-01").alias("retrieved_at"))
    releases = named.where("library = 'lib1'").select("library", F.inline(F.array(*(F.struct(F.lit(t).alias("tag"), F.lit(u).alias("url")) for t, u in (("v1.0", "https://x/1"), ("2.0", "https://x/2"), ("3.0", "https://x/3"), ("v2.0", ""))))))
    found = version_diffs.diff_documents(version_diffs.changed_symbols(old, fresh), files, libraries, releases)
    return found.select("library", "symbol", "status", "confidence", F.sha2(F.col("patch").cast("binary"), 256).alias("patch_sha256"), "content_hash", "document_id", F.array_join("release_urls", ",").alias("release_urls"))


def _repositories(spark, sf_dir):  # noqa: ANN001, ANN202
    """(files, selected, packages): what suppliers' repositories declare, in which environment, and what the two environments hold."""
    k = F.col("s_suppkey")
    n = lambda m: (k % m).cast("string")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    pins = text("# head\nnumpy>=1.", n(9), ",<2\n-r other.txt\n\nFoo_Bar[x] ~= 2.", n(3), " # note\nonlyold==1.0; python_version < '3'\nbad name\n")
    tree = text("name: x\ndependencies:\n  - python=3.", n(5), "\n  - pip:\n    - tool==", n(4), ".1\nother:\n  - no>1\n")
    toml = text('[project]\ndependencies = ["Numpy>=1.', n(4), '"]\n[project.optional-dependencies]\ntest = ["pytest"]\n')
    file = lambda path, body, cond: F.struct(F.lit(path).alias("path"), F.when(cond, body).alias("text"))
    every = F.lit(True)
    made = F.array(file("requirements-dev.txt", pins, every), file("environment.yml", tree, every), file("pyproject.toml", toml, k % 2 == 0), file("setup.py", F.lit("import x\n_deps = ['tool!=1.1', 3]\n"), k % 3 == 0), file("src/requirements.txt", F.lit("no>1"), every))
    repository = k.cast("string").alias("repository")
    rows = table(spark, sf_dir, "supplier")
    files = rows.select(repository, F.inline(made))
    held = [("e0", "numpy", "1.5"), ("e0", "foo-bar", "2.4"), ("e0", "python", "3.2"), ("e0", "tool", "1.1"), ("e1", "numpy", "1.2.post1+cpu"), ("e1", "tool", "x")]
    packages = table(spark, sf_dir, "region").where("r_regionkey = 0").select(F.inline(F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(("environment", "package", "version"), h, strict=True))) for h in held))))
    return files, rows.select(repository, F.concat(F.lit("e"), n(2)).alias("environment")), packages


_DECLARED = """
    WITH k AS (SELECT s_suppkey AS k FROM supplier),
    d AS (
        SELECT k, 'numpy' AS canonical, CASE WHEN k % 2 = 0 THEN 'Numpy' ELSE 'numpy' END AS package, CASE WHEN k % 2 = 0 THEN '>=1.' || k % 4 ELSE '<2,>=1.' || k % 9 END AS requirement,
               CASE WHEN k % 2 = 0 THEN 'pyproject.toml:project.dependencies' ELSE 'requirements-dev.txt' END AS source, CASE WHEN k % 2 = 0 THEN 'declared' ELSE 'development' END AS scope FROM k
        UNION ALL SELECT k, 'foo-bar', 'Foo_Bar', '~=2.' || k % 3, 'requirements-dev.txt', 'development' FROM k
        UNION ALL SELECT k, 'python', 'python', '==3.' || k % 5, 'environment.yml', 'declared' FROM k
        UNION ALL SELECT k, 'tool', 'tool', CASE WHEN k % 3 = 0 THEN '!=1.1' ELSE '==' || k % 4 || '.1' END, CASE WHEN k % 3 = 0 THEN 'setup.py:_deps' ELSE 'environment.yml:pip' END, CASE WHEN k % 3 = 0 THEN 'catalog' ELSE 'declared' END FROM k
        UNION ALL SELECT k, 'pytest', 'pytest', '', 'pyproject.toml:project.optional-dependencies.test', 'optional' FROM k WHERE k % 2 = 0)"""


@query(_DECLARED + """
    SELECT k::VARCHAR AS repository, canonical, package, requirement, source, scope, CASE WHEN scope = 'catalog' THEN 'lists_dependency' ELSE 'declares_dependency' END AS relation,
           CASE WHEN canonical IN ('numpy', 'foo-bar') THEN 'lib-' || canonical END AS target_library FROM d""")
def x34_j19_dependencies(spark, sf_dir):  # noqa: ANN001, ANN201
    files, _, packages = _repositories(spark, sf_dir)
    libraries = packages.where("environment = 'e0' AND package IN ('numpy', 'foo-bar')").select(F.upper(F.replace("package", F.lit("-"), F.lit("."))).alias("package"), F.concat(F.lit("lib-"), F.col("package")).alias("library"))
    return dependencies.to_libraries(dependencies.dependencies(files), libraries)


@query(_DECLARED + """,
    j AS (
        SELECT *, CASE WHEN k % 2 = 0 THEN map {'numpy': '1.5', 'foo-bar': '2.4', 'python': '3.2', 'tool': '1.1'}[canonical] ELSE map {'numpy': '1.2.post1+cpu', 'tool': 'x'}[canonical] END AS version,
               CASE canonical WHEN 'numpy' THEN k % 2 = 0 OR k % 9 <= 2 WHEN 'foo-bar' THEN true WHEN 'python' THEN k % 5 = 2 ELSE k % 3 <> 0 AND k % 4 = 1 END AS fits FROM d)
    SELECT k::VARCHAR AS repository, 'e' || k % 2 AS environment, canonical, package, requirement, version AS environment_version,
           CASE WHEN version IS NULL OR requirement = '' OR version = 'x' THEN 'unknown' WHEN fits THEN 'likely_compatible' ELSE 'conflict' END AS status,
           CASE WHEN version IS NULL THEN 'package is not present in the selected environment profile' WHEN version = 'x' THEN 'version value could not be normalized'
                ELSE 'declared requirement comparison; runtime behavior is not yet verified' END AS basis
    FROM j""")
def j20_compatibility(spark, sf_dir):  # noqa: ANN001, ANN201
    files, selected, packages = _repositories(spark, sf_dir)
    return dependencies.compatibility(dependencies.dependencies(files), selected, packages)


@query("""
    WITH f AS (SELECT 'r' || p_partkey % 50 AS repository, p_partkey // 50 AS place, p_partkey AS k FROM part),
    m AS (SELECT repository, min(place) FILTER (k % 2 = 0) AS even, min(place) FILTER (k % 3 = 0) AS third FROM f GROUP BY repository),
    u AS (
        SELECT repository, place, 'numpy' AS library, 'call_sites' AS kind, 'numpy.f' || k AS value, 3 AS line, '{"parameters": ["a"], "positional_arguments": 1}' AS detail FROM f WHERE k % 2 = 0
        UNION ALL SELECT repository, place, 'numpy', 'monkey_patches', 'numpy.g', 5, '{}' FROM f WHERE k % 2 = 0
        UNION ALL SELECT f.repository, place, 'torch', 'call_sites', 'torch.nn.h', 4, '{"parameters": [], "positional_arguments": 0}' FROM f JOIN m USING (repository) WHERE k % 3 = 0
        UNION ALL SELECT f.repository, place, 'os', 'call_sites', CASE WHEN k % 2 = 0 THEN 'os.path.p' ELSE 'os.p' END || k % 5, 6, '{"parameters": [], "positional_arguments": 0}' FROM f JOIN m USING (repository) WHERE place >= even
        UNION ALL SELECT repository, place, 'torch', 'inherited_symbols', 'torch.nn.Base', 7, '{"class": "C' || k || '"}' FROM f WHERE k % 3 = 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY repository, library, kind ORDER BY place) AS nth FROM u)
    SELECT repository, library, kind, nth::INTEGER AS nth, 'p' || lpad(place::VARCHAR, 9, '0') || '.py' AS path, line, value, detail FROM n WHERE nth <= CASE kind WHEN 'call_sites' THEN 500 ELSE 200 END
    UNION ALL SELECT DISTINCT repository, library, 'symbols', NULL::INTEGER, NULL, NULL::INTEGER, value, NULL FROM u WHERE kind = 'call_sites'
    UNION ALL SELECT DISTINCT repository, library, 'imports', NULL, NULL, NULL, name, NULL FROM f, (VALUES ('numpy', 'numpy', 2), ('os', 'os.path', 2), ('torch', 'torch.nn', 3)) AS i(library, name, n) WHERE k % n = 0
    UNION ALL SELECT DISTINCT repository, library, 'files', NULL, NULL, NULL, 'p' || lpad(place::VARCHAR, 9, '0') || '.py', NULL FROM f, (VALUES ('numpy', 2), ('os', 2), ('torch', 3)) AS i(library, n) WHERE k % n = 0""")
def a23_api_usage(spark, sf_dir):  # noqa: ANN001, ANN201
    from lodestone.operators import api_usage

    k = F.col("p_partkey")
    n = k.cast("string")
    head = F.concat(F.when(k % 2 == 0, "import numpy as np, os.path\n").otherwise("\n"), F.when(k % 3 == 0, "from torch import nn\n").otherwise("\n"))
    calls = F.concat(F.when(k % 2 == 0, F.concat(F.lit("np.f"), n, F.lit("(1, a=2)\n"))).otherwise("\n"), F.when(k % 3 == 0, "nn.h()\n").otherwise("\n"), F.when(k % 2 == 0, "np.g = 1\n").otherwise("\n"))
    tail = F.concat(F.lit("os.p"), (k % 5).cast("string"), F.lit("()\n"), F.when(k % 3 == 0, F.concat(F.lit("class C"), n, F.lit("(nn.Base): pass\n"))).otherwise("class D: pass\n"))
    path = F.concat(F.lit("p"), F.lpad(F.floor(k / 50).cast("string"), 9, "0"), F.lit(".py"))
    files = table(spark, sf_dir, "part").select(F.concat(F.lit("r"), (k % 50).cast("string")).alias("repository"), path.alias("path"), F.concat(head, calls, tail).alias("text"))
    return api_usage.inventory(files)


@query(r"""
    WITH d AS (SELECT doc_id AS k, source, lower(trim(regexp_replace(coalesce(text, ''), '[^a-zA-Z]+', ' ', 'g'), ' ')) AS body FROM documents),
    w AS (SELECT *, '# Part ' || k AS head, CASE WHEN k % 2 = 0 THEN 'release_note' ELSE 'tutorial' END AS kind FROM d),
    c AS (
        SELECT k, source, kind, 0 AS i, CASE WHEN body = '' OR length(head) + 1 + length(body) > 8000 THEN head ELSE head || chr(10) || body END AS text, CASE WHEN length(head) + 1 + length(body) > 8000 THEN 1 END AS part FROM w
        UNION ALL SELECT k, source, kind, 1, body, 2 FROM w WHERE length(head) + 1 + length(body) > 8000),
    t AS (
        SELECT *, list_sort(list_filter([
            CASE WHEN regexp_matches(lower(text), 'compatib|breaking|version') THEN 'compatibility' END, CASE WHEN regexp_matches(lower(text), 'migrat|upgrade') THEN 'migration' END, CASE WHEN lower(text) LIKE '%deprecat%' THEN 'deprecation' END,
            CASE WHEN regexp_matches(lower(text), 'error|exception|bug|fix') THEN 'debug' END, CASE WHEN lower(text) LIKE '%install%' THEN 'installation' END, CASE WHEN lower(text) LIKE '%config%' THEN 'configuration' END,
            CASE WHEN regexp_matches(lower(text), 'performance|memory|speed') THEN 'performance' END, CASE WHEN kind = 'tutorial' THEN 'example' END, CASE WHEN kind = 'tutorial' THEN 'api_usage' END], lambda x: x IS NOT NULL)) AS tags,
            CASE WHEN lower(text) LIKE '%breaking%' THEN 'breaking_changes' WHEN lower(text) LIKE '%deprecat%' THEN 'deprecations' WHEN lower(text) LIKE '%security%' THEN 'security' WHEN lower(text) LIKE '%migrat%' THEN 'migration'
                 WHEN lower(text) LIKE '%performance%' THEN 'performance' WHEN lower(text) LIKE '%bug%' OR lower(text) LIKE '%fix%' THEN 'bug_fixes' WHEN lower(text) LIKE '%known issue%' THEN 'known_issues' ELSE 'new_features' END AS category FROM c),
    m AS (
        SELECT *, '{' || CASE WHEN kind = 'release_note' THEN '"change_category":"' || category || '",' ELSE '' END || '"knowledge_base":"code","n":' || k || CASE WHEN part IS NULL THEN '' ELSE ',"part_end_line":' || part || ',"part_start_line":' || part END
               || ',"section":"Part ' || k || '","source":' || coalesce(to_json(source)::VARCHAR, 'null') || ',"source_type":"' || kind || '","source_url":"u","tag":{"a":[1,"é"]},"task_tags":' || to_json(tags)::VARCHAR || ',"title":"T' || k || '"}' AS metadata FROM t)
    SELECT 'doc' || k AS document_id, i AS chunk_index, text, array_to_string(tags, ',') AS tags, metadata,
           sha256('{"document_id":"doc' || k || '","index":' || i || ',"metadata":' || metadata || ',"processor":"code-structural-v1","text":' || to_json(text)::VARCHAR || '}') AS chunk_fingerprint, 'Part ' || k AS section FROM m""")
def x2_code_documents(spark, sf_dir):  # noqa: ANN001, ANN201
    from lodestone.plans import code_documents

    k = F.col("doc_id").cast("string")
    body = F.lower(F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), "[^a-zA-Z]+", " "), F.lit(" ")))
    metadata = F.concat(F.lit('{"tag": {"a": [1, "é"]}, "n": '), k, F.lit(', "source": '), F.coalesce(F.concat(F.lit('"'), F.col("source"), F.lit('"')), F.lit("null")), F.lit(', "title": "old"}'))
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc"), k).alias("document_id"), F.when(F.col("doc_id") % 2 == 0, "release_note").otherwise("tutorial").alias("source_type"), F.lit("a.md").alias("path"), F.lit("u").alias("source_url"), F.concat(F.lit("T"), k).alias("title"),
        F.concat(F.lit("# Part "), k, F.lit("\n"), body).alias("content"), metadata.alias("metadata"),
    )
    found = code_documents.chunks(docs)
    tags = F.array_join(F.from_json(F.get_json_object("metadata", "$.task_tags"), "array<string>"), ",")
    return found.select("document_id", "chunk_index", "text", tags.alias("tags"), "metadata", "chunk_fingerprint", F.array_join("section_path", " > ").alias("section"))
