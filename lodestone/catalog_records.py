"""Queries of records, versions, evidence, checks and routed search, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone import catalog
from lodestone.functions import features, text
from lodestone.functions.hashing import sha256
from lodestone.operators import checks, clusters, graph, hub, records, retrieval
from lodestone.plans import evidence, markdown
from lodestone.registry import query, table


def _s(column: str):  # noqa: ANN202
    return F.col(column).cast("string")


def _picked(values: list[str], by):  # noqa: ANN001, ANN202
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


# ---- counts, clusters and findings


@query("SELECT (SELECT count(*) FROM documents) AS documents, count(*) AS pipeline_chunks, count(*) FILTER (turn % 2 = 0) AS active_pipeline_chunks FROM conversations")
def a2_status_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    return records.status_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations").withColumn("active", F.col("turn") % 2 == 0))


@query("SELECT event_type, round(count(*) / greatest(sum(abs(value) + 1), 1e-9), 6) AS documents_per_second, round(sum(event_id % 7) / greatest(sum(abs(value) + 1), 1e-9), 6) AS tokens_per_second FROM events GROUP BY event_type")
def a20_throughput(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = table(spark, sf_dir, "events").withColumns({"seconds": F.abs("value") + 1, "documents": F.lit(1), "tokens": F.col("event_id") % 7})
    return records.throughput(rows, "event_type", "seconds", ["documents", "tokens"])


@query(rf"""WITH RECURSIVE t AS (SELECT doc_id::VARCHAR AS id, lang, source, regexp_extract_all(lower(text), '{clusters.TOKEN}') AS t FROM documents),
          s AS (SELECT id, lang, source, CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')] ELSE list_distinct(list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i : i + 2], ' '))) END AS items FROM t),
          p AS (SELECT a.id AS x, b.id AS y FROM s AS a JOIN s AS b ON a.lang = b.lang AND a.source = b.source AND a.id <> b.id
                WHERE CASE WHEN len(a.items) + len(b.items) = 0 THEN true ELSE len(list_intersect(a.items, b.items)) / (len(a.items) + len(b.items) - len(list_intersect(a.items, b.items))) >= 0.85 END),
          r(id, other) AS (SELECT id, id FROM s UNION SELECT r.id, y FROM r JOIN p ON x = other),
          c AS (SELECT id, min(other) AS name FROM r GROUP BY id),
          n AS (SELECT name, 'cluster:' || sha256('["' || string_agg(id, '","' ORDER BY id) || '"]') AS cluster, count(*) AS size FROM c GROUP BY name)
          SELECT id AS doc_id, cluster, size FROM c JOIN n USING (name)""")
def a12_j12_g2_clusters(spark, sf_dir):  # noqa: ANN001, ANN201
    return clusters.clusters(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), ["lang", "source"])


_FINDINGS = r"""a AS (SELECT doc_id, doc_id % 3 AS kind, source, lang, text, list_slice(regexp_extract_all(lower(text), '[a-z]+'), 1, 5) AS items, (doc_id % 100) / 100 AS score, 'c' || (n_chars % 50) AS cluster FROM documents),
    g AS (SELECT *, list_sort(list_filter(list_transform(string_split_regex(lower(text), '[.!?。！？\n]+'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: length(x) >= 8)) AS segments FROM a),
    m AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, s, count(*) AS n FROM (SELECT doc_id, unnest(segments) AS s FROM g) GROUP BY ALL) GROUP BY doc_id),
    findings AS (
        SELECT 'low_quality_score' AS code, doc_id::VARCHAR AS key, score::DOUBLE AS observed FROM a WHERE score < 0.1
        UNION ALL SELECT 'repeated_list_item', doc_id::VARCHAR, len(items) - len(list_distinct(items)) FROM a WHERE len(items) > len(list_distinct(items))
        UNION ALL SELECT 'oversized_text_field', doc_id::VARCHAR, length(text) FROM a WHERE length(text) > 4000
        UNION ALL SELECT 'repeated_text_segment', doc_id::VARCHAR, n FROM m WHERE n > 2
        UNION ALL SELECT 'exact_duplicate_primary_text', min(doc_id)::VARCHAR, count(*) FROM a GROUP BY kind, source, lang, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) HAVING count(*) > 1
        UNION ALL SELECT 'near_duplicate_cluster', min(doc_id)::VARCHAR, count(*) FROM a GROUP BY kind, cluster HAVING count(*) > 8)"""


@query(f"WITH {_FINDINGS} SELECT code, key, observed FROM findings")
def a13_quality_findings(spark, sf_dir):  # noqa: ANN001, ANN201
    d = table(spark, sf_dir, "documents")
    assets = d.select(
        F.col("doc_id").alias("asset_id"), (F.col("doc_id") % 3).alias("asset_type"), F.col("source").alias("category"), F.col("lang").alias("language"), "text",
        F.slice(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0), 1, 5).alias("items"), (F.col("doc_id") % 100 / 100).alias("score"), F.concat(F.lit("c"), _s("n_chars").cast("bigint") % 50).alias("cluster"),
    )
    return checks.quality_findings(assets, 0.1, 4000, 2, 8)


# ---- snapshots, fingerprints, dispositions


def _library(spark, sf_dir):  # noqa: ANN001, ANN202
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    k = F.col("o_orderkey")
    attachments = o.select(F.concat(F.lit("A"), k).alias("attachment_key"), F.concat(F.lit("P"), "o_custkey").alias("parent_key"), F.when(k % 9 == 0, "text/html").otherwise("application/PDF").alias("mime_type"), F.when(k % 4 == 0, "bad").otherwise(F.upper(sha256(_s("o_orderkey")))).alias("digest"), F.col("o_orderstatus").alias("status"))
    none = F.array().cast("array<string>")
    objects = c.select(F.concat(F.lit("P"), "c_custkey").alias("key"), F.col("c_name").alias("title"), (F.col("c_custkey") % 13 == 0).alias("deleted"), F.array(F.concat(F.lit("N"), "c_nationkey"), F.concat(F.lit("N"), (F.col("c_nationkey") + 3) % 25), F.lit("gone")).alias("collections"))
    objects = objects.unionAll(o.select(F.concat(F.lit("A"), k), F.lit(""), k % 17 == 0, none))
    collections = n.select(F.concat(F.lit("N"), "n_nationkey").alias("key"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("All/"), "n_name")).alias("path"), (F.col("n_nationkey") % 5 == 0).alias("deleted"))
    return attachments, objects, collections


@query("""WITH n AS (SELECT 'N' || n_nationkey AS key, CASE WHEN n_nationkey % 2 = 0 THEN 'All/' || n_name ELSE n_name END AS path FROM nation WHERE n_nationkey % 5 <> 0),
          p AS (SELECT 'P' || c_custkey AS parent_key, c_name AS title, ['N' || c_nationkey, 'N' || ((c_nationkey + 3) % 25)] AS keys FROM customer WHERE c_custkey % 13 <> 0),
          l AS (SELECT parent_key, list(path ORDER BY path, key) AS paths FROM (SELECT parent_key, unnest(keys) AS key FROM p) JOIN n USING (key) GROUP BY parent_key),
          r AS (SELECT 'A' || o_orderkey AS attachment_key, 'P' || o_custkey AS parent_key, o_orderstatus AS status, CASE WHEN o_orderkey % 4 <> 0 THEN sha256(o_orderkey::VARCHAR) END AS digest FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 17 <> 0),
          m AS (SELECT r.*, title, coalesce(paths, []) AS paths, sha256('{"collections":' || to_json(coalesce(paths, []))::VARCHAR || ',"title":' || to_json(title)::VARCHAR || '}') AS meta FROM r JOIN p USING (parent_key) LEFT JOIN l USING (parent_key))
          SELECT 'zotero:user:7:' || parent_key || ':' || attachment_key || ':0' AS document_id, attachment_key, parent_key, title, array_to_string(paths, '|') AS paths, status, meta AS metadata_fingerprint, digest AS content_fingerprint,
            sha256('{"content_fingerprint":' || coalesce('"' || digest || '"', 'null') || ',"metadata_fingerprint":"' || meta || '","schema_version":1,"status":"' || status || '"}') AS document_fingerprint FROM m""")
def p12_h5_snapshot(spark, sf_dir):  # noqa: ANN001, ANN201
    return records.snapshot(*_library(spark, sf_dir), "7").withColumn("paths", F.array_join("paths", "|"))


@query(f"""WITH {catalog._VERSIONS} SELECT new.k, CASE WHEN old.k IS NULL THEN 'new_document' WHEN new.content <> old.content OR old.status <> 'ready' OR new.k % 37 = 0 THEN 'content_or_parser' WHEN new.archive <> old.archive THEN 'chunk_config'
          WHEN new.collections <> old.collections THEN 'embedding_config' WHEN new.metadata <> old.metadata THEN 'metadata' WHEN new.k % 31 = 0 THEN 'sparse_config' ELSE 'unchanged' END AS reason FROM new LEFT JOIN old USING (k)""")
def i2_invalidation_reason(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = catalog._versions(spark, sf_dir)
    shaped = lambda df, parse, sparse: df.select("k", "content", "status", parse.alias("parse"), F.col("archive").alias("chunk"), F.col("collections").alias("embedding"), "metadata", sparse.alias("sparse"))
    state = shaped(old, F.when(F.col("k") % 37 == 0, "p0").otherwise("p1"), F.when(F.col("k") % 31 == 0, "s0").otherwise("s1"))
    state = state.select("k", *(F.col(c).alias("s_" + c) for c in state.columns if c != "k"))
    return records.reason(shaped(new, F.lit("p1"), F.lit("s1")), state, "k")


@query(f"""WITH {catalog._VERSIONS}, b AS (SELECT new.k, old.k IS NULL AS fresh, new.content <> old.content AS c, new.k % 37 = 0 AS p,
            list_filter([CASE WHEN new.metadata <> old.metadata THEN 'abstract_prompt_hash' END, CASE WHEN new.archive <> old.archive THEN 'model' END], lambda x: x IS NOT NULL) AS changed,
            CASE old.status WHEN 'ready' THEN 'complete' WHEN 'missing_archive' THEN 'failed' ELSE 'inactive' END AS prior FROM new LEFT JOIN old USING (k))
          SELECT k, CASE WHEN fresh THEN 'new' WHEN c OR p OR len(changed) > 0 THEN 'changed' WHEN prior = 'failed' THEN 'failed' WHEN prior = 'inactive' THEN 'changed' ELSE 'unchanged' END AS disposition,
            CASE WHEN fresh THEN NULL WHEN c THEN 'source_content_changed' WHEN p THEN 'parse_changed' WHEN len(changed) > 0 THEN 'version_changed:' || array_to_string(changed, ',') WHEN prior = 'failed' THEN 'prior_failed' WHEN prior = 'inactive' THEN 'prior_inactive' END AS reason,
            CASE WHEN fresh THEN NULL WHEN c OR p THEN 'provenance' WHEN changed = ['abstract_prompt_hash'] THEN 'abstraction' WHEN len(changed) > 0 THEN 'classification' WHEN prior = 'failed' THEN 'failed_stage' WHEN prior = 'inactive' THEN 'provenance' END AS stage FROM b""")
def x19_disposition(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = catalog._versions(spark, sf_dir)
    versions = F.create_map(F.lit("abstract_prompt_hash"), _s("metadata"), F.lit("model"), F.col("archive"))
    docs = new.select("k", "content", F.lit("p1").alias("parse"), versions.alias("versions"))
    status = F.when(F.col("status") == "ready", "complete").when(F.col("status") == "missing_archive", "failed").otherwise("inactive")
    prior = old.select("k", F.col("content").alias("p_content"), F.when(F.col("k") % 37 == 0, "p0").otherwise("p1").alias("p_parse"), versions.alias("p_versions"), status.alias("p_status"))
    return records.disposition(docs, prior, "k", ["abstract_prompt_hash", "abstraction_schema", "abstraction_max_tokens"])


@query("""SELECT o_orderkey AS k, o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 AS needs_scan,
          ['ready', 'missing_archive', 'unstable_archive', 'missing_pdf', 'missing_pdf', 'ambiguous_attachment', 'error', 'invalid_archive'][o_orderkey % 8 + 1] AS wire FROM orders""")
def x17_attachment_rescan(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.concat(F.lit("/dav/"), k).alias("path"), F.col("o_custkey").alias("size"), F.col("o_orderdate").alias("mtime"))
    previous = rows.withColumns({"status": F.when(F.col("k") % 5 == 0, "missing_pdf").otherwise("ready"), "prop_exists": F.when(F.col("k") % 17 != 0, True)})
    current = rows.where("k % 7 <> 0").withColumns({"size": F.when(F.col("k") % 11 == 0, -1).otherwise(F.col("size")), "path": F.when(F.col("k") % 13 == 0, "/moved").otherwise(F.col("path"))})
    status = _picked(["ready", "missing_archive", "unstable_archive", "missing_pdf", "no_pdf", "ambiguous_attachment", "extraction_error", "bad_zip"], F.col("k"))
    return records.needs_scan(previous, current, "k").withColumn("wire", records.wire_status(status))


# ---- symbols and versions


@query("""WITH s AS (SELECT DISTINCT 'lib' || (p_partkey % 3) || '.mod' || (p_partkey % 40) || '.f' || (p_partkey % 200) AS name FROM part UNION SELECT 'f' || (s_suppkey % 9) FROM supplier),
          w AS (SELECT DISTINCT unnest(['f' || s_suppkey, 'mod' || (s_suppkey % 40) || '.f' || (s_suppkey % 200), '_' || s_suppkey]) AS wanted FROM supplier)
          SELECT wanted, arg_min(name, (length(name), name)) AS name FROM w JOIN s ON name = wanted OR ends_with(name, '.' || wanted) GROUP BY wanted""")
def j5_symbol_lookup(spark, sf_dir):  # noqa: ANN001, ANN201
    p, s = F.col("p_partkey"), F.col("s_suppkey")
    names = table(spark, sf_dir, "part").select(F.concat(F.lit("lib"), p % 3, F.lit(".mod"), p % 40, F.lit(".f"), p % 200).alias("name"))
    symbols = names.union(table(spark, sf_dir, "supplier").select(F.concat(F.lit("f"), s % 9))).distinct()
    wanted = table(spark, sf_dir, "supplier").select(F.explode(F.array(F.concat(F.lit("f"), s), F.concat(F.lit("mod"), s % 40, F.lit(".f"), s % 200), F.concat(F.lit("_"), s))).alias("wanted"))
    return records.symbol_lookup(symbols, wanted)


_RAW = ["main", "v1.02.3", "1.2rc1", "nightly", "ABCDEF1", "2.0.0.dev3", "1.10+CU-12", "not a version", " v3 ", "4.1.post2"]
_PARSED = [("main", "branch", None), ("1.2.3", "stable", None), ("1.2", "prerelease", None), ("nightly", "nightly", None), ("abcdef1", "commit", None), ("2.0.0", "prerelease", None), ("1.10", "stable", "cu.12"), (None, None, None), ("3", "stable", None), ("4.1", "stable", None)]
_PARSED_ROWS = ", ".join("(" + ", ".join([str(i), *("NULL" if v is None else f"'{v}'" for v in row)]) + ")" for i, row in enumerate(_PARSED))


@query(f"WITH p(i, normalized, release_type, local_build) AS (VALUES {_PARSED_ROWS}) SELECT doc_id, normalized, release_type, local_build FROM documents JOIN p ON doc_id % 10 = i")
def f28_versions(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").select("doc_id", *records.version_parts(_picked(_RAW, F.col("doc_id"))))


_STRIPPED = "CASE WHEN list_max(n) = 0 THEN [0] ELSE n[1 : list_max(list_transform(range(1, len(n) + 1), lambda i: CASE WHEN n[i] <> 0 THEN i ELSE 0 END))] END"


@query(f"""WITH t AS (SELECT o_custkey AS k, (o_orderkey % 5) || '.' || (o_orderkey % 7) || '.' || (o_orderkey % 3) AS version FROM orders WHERE o_orderkey % 11 <> 0),
          s AS (SELECT DISTINCT k, version, {_STRIPPED.replace("n", "n")} AS ord FROM (SELECT *, list_transform(string_split(version, '.'), lambda x: x::BIGINT) AS n FROM t)),
          i AS (SELECT k, version, {_STRIPPED} AS own FROM (SELECT *, list_transform(string_split(version, '.'), lambda x: x::BIGINT) AS n FROM (SELECT c_custkey AS k, (c_custkey % 5) || '.' || (c_custkey % 7) AS version FROM customer WHERE c_custkey % 6 <> 0))),
          b AS (SELECT s.*, own FROM s LEFT JOIN i USING (k))
          SELECT k, 'installed' AS strategy, version FROM i UNION ALL SELECT k, 'latest', max({{'o': ord, 'v': version}}).v FROM b GROUP BY k
          UNION ALL SELECT k, 'lower', max({{'o': ord, 'v': version}}).v FROM b WHERE ord < own GROUP BY k UNION ALL SELECT k, 'higher', min({{'o': ord, 'v': version}}).v FROM b WHERE ord > own GROUP BY k""")
def w12_selected_versions(spark, sf_dir):  # noqa: ANN001, ANN201
    o, c = F.col("o_orderkey"), F.col("c_custkey")
    number = F.concat_ws(".", (o % 5).cast("string"), (o % 7).cast("string"), (o % 3).cast("string"))
    tags = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.concat(_picked(["refs/tags/v", "v", ""], o), number, F.when(o % 11 == 0, "-rc1").otherwise("")).alias("tag"))
    installed = table(spark, sf_dir, "customer").select(c.alias("k"), F.when(c % 6 == 0, "unknown").otherwise(F.concat(c % 5, F.lit("."), c % 7, F.when(c % 2 == 0, "+cu12").otherwise(""))).alias("installed"))
    return records.selected_versions(tags, installed.withColumn("installed", F.regexp_replace("installed", r"\+.*$", "")), "k")


# ---- documents, selections, contexts


@query("""SELECT conv_id, turn, place::INT AS place, CASE WHEN n > 5 THEN 5 END AS next_cursor FROM (
            SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, md5(text)) AS place, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) WHERE place BETWEEN 3 AND 5""")
def k8_x6_document_page(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(F.col("text").cast("binary")).alias("id"))
    return records.page_of_chunks(rows, "conv_id", ["turn", "id"], 2, 3).select("conv_id", "turn", "place", "next_cursor")


_TYPES = ["source_code", "example", "tutorial", "issue"]


@query(f"""WITH r AS (SELECT doc_id, {_TYPES}[1 : doc_id % 4] AS asked, {_TYPES}[doc_id % 5 + 1 : 4] AS configured FROM documents)
          SELECT doc_id, array_to_string(CASE WHEN len(configured) = 0 THEN asked ELSE list_filter(asked, lambda t: list_contains(configured, t)) END, ',') AS selected,
            len(asked) > 0 AND len(configured) > 0 AND NOT list_has_any(asked, configured) AS refused FROM r""")
def u3_source_types(spark, sf_dir):  # noqa: ANN001, ANN201
    types, d = F.array(*map(F.lit, _TYPES)), F.col("doc_id")
    asked = F.when(d % 4 == 0, F.array().cast("array<string>")).otherwise(F.slice(types, F.lit(1), F.greatest(F.lit(1), d % 4).cast("int")))
    configured = F.when(d % 5 == 4, F.array().cast("array<string>")).otherwise(F.slice(types, (d % 5 + 1).cast("int"), F.lit(4)))
    selected, refused = records.allowed_types(F.col("asked"), F.col("configured"))
    return table(spark, sf_dir, "documents").select("doc_id", asked.alias("asked"), configured.alias("configured")).select("doc_id", F.array_join(selected, ",").alias("selected"), refused)


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT item_id * 3 FROM benchmark) OR source IN ('src3', 'src7') OR lang = 'fr' GROUP BY doc_id")
def u4_selected_documents(spark, sf_dir):  # noqa: ANN001, ANN201
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array("source", "lang").alias("collections"))
    names = spark.createDataFrame([("src3",), ("src7",), ("fr",)], "name string")
    return records.selected_documents(docs, "doc_id", table(spark, sf_dir, "benchmark").select((F.col("item_id") * 3).alias("doc_id")), names)


_RECORDS = f"""r AS (SELECT o_custkey AS k, {evidence.GIVEN}[o_orderkey % 4 + 1] AS list, o_orderkey AS place, 20 + o_orderkey % 30 AS characters FROM orders)"""


@query(f"""WITH {_RECORDS}, f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k ORDER BY list_position({evidence.GIVEN}, list), place) <= 8),
          s AS (SELECT *, sum(characters) OVER (PARTITION BY k ORDER BY list_position({evidence.TAKEN}, list) DESC, place) AS sum FROM f) SELECT k, list, place FROM s WHERE sum + 40 <= 220""")
def w10_record_budget(spark, sf_dir):  # noqa: ANN001, ANN201
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), _picked(evidence.GIVEN, o).alias("list"), o.alias("place"), (20 + o % 30).alias("characters"))
    return evidence.within_budget(rows, "k", 8, 220, 40).select("k", "list", "place")


@query(f"""WITH r AS (SELECT o_custkey AS k, {evidence.GIVEN}[o_orderkey % 4 + 1] AS list, o_orderkey AS record_id, ['accepted', 'resolved', 'open'][o_orderkey % 3 + 1] AS status, o_orderkey - o_orderkey % 4 AS experiment_id FROM orders),
          e AS (SELECT *, (k, experiment_id) IN (SELECT (k, record_id) FROM r WHERE list = 'recent_experiments') AS own FROM r),
          t(task, list) AS (VALUES {", ".join(f"('{task}', '{name}')" for task, lists in records.TASKS.items() for name in lists)})
          SELECT task, k, list, record_id FROM e JOIN t USING (list) WHERE CASE WHEN task = 'project_overview' AND list = 'active_decisions' THEN status = 'accepted' WHEN task = 'project_overview' AND list = 'known_failures' THEN status <> 'resolved'
            WHEN task IN ('code_debugging', 'experiment_analysis') AND list = 'known_failures' THEN own ELSE true END""")
def x39_task_context(spark, sf_dir):  # noqa: ANN001, ANN201
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), _picked(evidence.GIVEN, o).alias("list"), o.alias("record_id"), _picked(["accepted", "resolved", "open"], o).alias("status"), (o - o % 4).alias("experiment_id"))
    return records.task_context(rows, "k")


_VOCABULARY = [(kind, name, i) for kind, names in (("taxonomy", features.TAXONOMY), ("mvp_taxonomy", features.MVP_TAXONOMY), ("risk_flag", [*text.RISK, "missing_comparison"]), *(("family:" + f, names) for f, names in text.FAMILIES.items())) for i, name in enumerate(names)]


@query(f"""WITH v(kind, name, place) AS (VALUES {", ".join(f"('{k}', '{n}', {i})" for k, n, i in _VOCABULARY)}) SELECT kind, name, place FROM v""")
def x42_vocabularies(spark, sf_dir):  # noqa: ANN001, ANN201
    return spark.createDataFrame(_VOCABULARY, "kind string, name string, place int")


# ---- paragraphs of Markdown, writing entries


_SECTIONS = ["1. Introduction", "II. Related Work", "3.2 Proposed Method", "A.1 Ablation Experiments", "Conclusions and Outlook", "References", "Appendix B"]


def _markdown(spark, sf_dir):  # noqa: ANN001, ANN202
    """Documents whose every eighth sentence is a heading, with blank, table and comment lines."""
    lines = F.split(F.regexp_replace("text", r"\. ", ".\n"), "\n")
    heads = F.array(*(F.lit("## " + s) for s in _SECTIONS))

    def line(x, i):  # noqa: ANN001, ANN202
        head = F.element_at(heads, (F.pmod(F.col("doc_id") + i, F.lit(len(_SECTIONS))) + 1).cast("int"))
        return F.when(i % 8 == 1, head).when(i % 8 == 5, " ").when(i % 8 == 7, F.concat(F.lit(" | "), x)).when(i % 24 == 2, "<!-- x -->").otherwise(F.concat(F.lit("  "), x))

    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(lines, line), "\n").alias("body"))


_PARAGRAPHS = rf"""src AS (SELECT doc_id, string_split(replace(text, '. ', '.' || chr(10)), chr(10)) AS ls FROM documents),
    ln AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) - 1 AS i FROM src),
    lx AS (SELECT doc_id, i, CASE WHEN i % 8 = 1 THEN 'h' WHEN i % 8 = 5 OR trim(regexp_replace(x, '\s+', ' ', 'g')) = '' AND NOT (i % 8 = 7 OR i % 24 = 2) THEN 'b' WHEN i % 8 = 7 OR i % 24 = 2 THEN 's' WHEN regexp_matches(x, '^\s*(?:\||```|<!--)') THEN 's' ELSE 't' END AS kind,
            {_SECTIONS}[(doc_id + i) % 7 + 1] AS head, trim(x, ' ' || chr(9) || chr(13)) AS x FROM ln),
    ly AS (SELECT *, count(*) FILTER (kind = 'h') OVER w AS section_no, count(*) FILTER (kind IN ('h', 'b')) OVER w AS part, last_value(CASE WHEN kind = 'h' THEN head END IGNORE NULLS) OVER w AS section FROM lx WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    lz AS (SELECT doc_id, section_no, section, part, string_agg(x, ' ' ORDER BY i) AS text FROM ly WHERE kind = 't' AND section_no > 0 AND section <> 'References' GROUP BY ALL),
    paragraphs AS (SELECT doc_id, section_no, section, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY part) AS paragraph, text FROM lz)"""


@query(f"WITH {_PARAGRAPHS} SELECT doc_id, section_no, section, paragraph::INT AS paragraph, sha256(text) AS text_sha256 FROM paragraphs")
def w7_paragraphs(spark, sf_dir):  # noqa: ANN001, ANN201
    found = markdown.paragraphs(_markdown(spark, sf_dir), "doc_id", "body")
    return found.select("doc_id", "section_no", "section", "paragraph", sha256(F.col("text")).alias("text_sha256"))


_RHETORIC = catalog.ORACLES["f9_f11_f14_rhetoric"]
_FUNCTION_SQL = _RHETORIC[_RHETORIC.index("CASE WHEN NOT length(v)") : _RHETORIC.index(" AS function,")]
_FAMILIES_SQL = "CASE section WHEN '1. Introduction' THEN 'introduction' WHEN 'II. Related Work' THEN 'related_work' WHEN '3.2 Proposed Method' THEN 'method' WHEN 'A.1 Ablation Experiments' THEN 'experiment' WHEN 'Conclusions and Outlook' THEN 'conclusion' ELSE 'appendix b' END"
_PATTERN_CASE = "CASE function " + " ".join(f"WHEN '{f}' THEN '{p[0].replace(chr(39), chr(39) * 2)}'" for f, p in features.WRITING_PATTERNS.items()) + " END"


@query(rf"""WITH {_PARAGRAPHS}, d AS (SELECT doc_id, section_no, paragraph, {_FAMILIES_SQL} AS family, trim(regexp_replace(text, '\s+', ' ', 'g')) AS v FROM paragraphs),
          k AS (SELECT * FROM d WHERE NOT (regexp_matches(v, '(?i)^\s*(?:figure|fig\.|table|图|表)\s*\d+') OR (NOT regexp_matches(v, '{text.CJK_CHAR}') AND len(regexp_extract_all(v, '[A-Za-z]+(?:[-''][A-Za-z]+)*')) < 12))),
          f AS (SELECT *, {_FUNCTION_SQL} AS function, sha256(v) AS fingerprint FROM k),
          l AS (SELECT * FROM f WHERE function IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, fingerprint ORDER BY section_no DESC, paragraph DESC) = 1)
          SELECT doc_id, section_no, paragraph::INT AS paragraph, family, function, {_PATTERN_CASE} AS pattern, fingerprint FROM l""")
def c3_writing_entries(spark, sf_dir):  # noqa: ANN001, ANN201
    return markdown.writing_entries(_markdown(spark, sf_dir), "doc_id", "body").select("doc_id", "section_no", "paragraph", "family", "function", "pattern", "fingerprint")


# ---- evidence


_ESTIMATE = r"greatest(len(regexp_extract_all({0}, '[\p{{L}}\p{{M}}\p{{N}}_]+|[^\p{{L}}\p{{M}}\p{{N}}_\s]')), ceil(length({0}) / 4.0))::BIGINT"
_CUT = r"rtrim(left(array_to_string(list_slice(regexp_extract_all(content, '\s*(?:[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s])'), 1, remaining), ''), (remaining * 4)::INT), ' ' || chr(9) || chr(10) || chr(13))"


@query(rf"""WITH RECURSIVE h AS (SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 AND trim(text) <> '' THEN trim(text) WHEN turn % 4 = 0 THEN '' ELSE array_to_string(list_filter([role, 'note'], lambda x: x <> ''), chr(10)) END AS content FROM conversations),
          r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, md5(content)) AS rank FROM h),
          e(conv_id, rank, content, remaining, tokens, truncated, over, kept) AS (SELECT DISTINCT conv_id, 0::BIGINT, '', 60::BIGINT, 0::BIGINT, false, false, false FROM r
            UNION ALL SELECT conv_id, rank, CASE WHEN cut THEN short ELSE whole END, CASE WHEN skip OR n <= 0 THEN remaining ELSE remaining - n END, n, cut, over OR (NOT skip AND (n <= 0 OR remaining - n <= 0)), NOT skip AND n > 0
              FROM (SELECT *, over OR whole = '' AS skip, CASE WHEN (CASE WHEN cut THEN short ELSE whole END) = '' THEN 0 WHEN cut THEN {_ESTIMATE.format("short")} ELSE cost END AS n
                FROM (SELECT r.conv_id, r.rank, r.content AS whole, e.remaining, e.over, {_ESTIMATE.format("r.content")} AS cost, {_ESTIMATE.format("r.content")} > e.remaining AS cut, {_CUT.replace("content", "r.content").replace("remaining", "e.remaining")} AS short FROM e JOIN r ON r.conv_id = e.conv_id AND r.rank = e.rank + 1 AND r.rank <= 5)))
          SELECT conv_id, rank::INT AS rank, sha256(content) AS content_sha256, tokens, truncated FROM e WHERE kept""")
def c2_x4_w9_evidence_envelope(spark, sf_dir):  # noqa: ANN001, ANN201
    from pyspark.sql import Window

    own = F.when(F.col("turn") % 3 != 0, F.col("text"))
    notes = [F.when(F.col("turn") % 4 != 0, F.col("role")), F.when(F.col("turn") % 4 != 0, F.lit("note"))]
    content = F.when((F.col("turn") % 3 != 0) | (F.col("turn") % 4 != 0), evidence.context(own, *notes)).otherwise("")
    hits = table(spark, sf_dir, "conversations").select("conv_id", "turn", content.alias("content"))
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", F.md5(F.col("content").cast("binary")))))
    found = evidence.envelope(ranked, "conv_id", 5, 60)
    return found.select("conv_id", "rank", sha256(F.col("content")).alias("content_sha256"), "tokens", "truncated")


@query("""WITH p AS (SELECT doc_id, text FROM documents WHERE doc_id % 23 <> 0), e AS (SELECT doc_id, doc_id % 50 AS b, doc_id % 50 + 20 AS f FROM documents)
          SELECT doc_id::VARCHAR AS evidence_id, CASE WHEN text IS NULL THEN 'paragraph not found' WHEN e.doc_id % 19 = 0 THEN 'parse fingerprint changed' WHEN e.doc_id % 17 = 0 THEN 'source content fingerprint changed'
            WHEN e.doc_id % 7 = 0 THEN 'exact span no longer matches source' WHEN e.doc_id % 11 = 0 THEN 'source paragraph hash changed' END AS error FROM e LEFT JOIN p USING (doc_id) WHERE error IS NOT NULL""")
def x26_evidence_check(spark, sf_dir):  # noqa: ANN001, ANN201
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    begin = (k % 50).cast("int")
    paragraphs = d.where("doc_id % 23 <> 0").select(k.alias("document_id"), F.lit("p").alias("paragraph_id"), F.lit("v1").alias("p_parse"), F.lit("c1").alias("p_content"), F.col("text").alias("p_text"))
    told = F.when(k % 7 == 0, "~~ not so ~~").otherwise(F.substring(F.col("text"), begin + 1, F.lit(20)))
    given = d.select(_s("doc_id").alias("evidence_id"), k.alias("document_id"), F.lit("p").alias("paragraph_id"), F.when(k % 19 == 0, "v0").otherwise("v1").alias("parse"), F.when(k % 17 == 0, "c0").otherwise("c1").alias("content"), begin.alias("begin"), (begin + 20).alias("end"), told.alias("text"), F.when(k % 11 == 0, "0").otherwise(sha256(F.col("text"))).alias("paragraph_hash"))
    return checks.evidence_findings(given, paragraphs)


# ---- checks


_X13 = """l AS (SELECT o_orderkey AS line, lpad((CASE WHEN o_orderkey % 101 = 0 THEN o_orderkey - 1 ELSE o_orderkey END)::VARCHAR, 9, '0') AS id, o_orderkey AS k FROM orders),
    snapshot AS (SELECT 'duplicate_document_id' AS code, id AS key FROM l GROUP BY id HAVING count(*) > 1
        UNION ALL SELECT 'snapshot_order', b.id FROM l AS a JOIN l AS b ON b.line = a.line + 1 WHERE a.id > b.id
        UNION ALL SELECT 'missing_title', id FROM l WHERE k % 61 = 0
        UNION ALL SELECT 'fingerprint_mismatch', id FROM l WHERE k % 43 = 0
        UNION ALL SELECT 'manifest_db_mismatch', a.id FROM l AS a JOIN l AS b ON a.id = b.id WHERE b.k % 101 <> 0 AND (b.k % 59 = 0 OR a.k <> b.k))"""


def _snapshot_findings(spark, sf_dir):  # noqa: ANN001, ANN202
    k = F.col("o_orderkey")
    name = lambda c: F.lpad(c.cast("string"), 9, "0")
    rows = table(spark, sf_dir, "orders").select(k.alias("line"), name(F.when(k % 101 == 0, k - 1).otherwise(k)).alias("document_id"), F.concat(F.lit('{"k":'), k, F.lit("}")).alias("json"), F.when(k % 61 != 0, "t").alias("title"), k.alias("k"))
    lines = rows.withColumns({"recomputed": sha256(F.col("json")), "fingerprint": F.when(F.col("k") % 43 == 0, "0").otherwise(sha256(F.col("json")))})
    state = rows.where("k % 101 <> 0").select("document_id", F.when(F.col("k") % 59 == 0, "{}").otherwise(F.col("json")).alias("manifest_json"))
    return checks.snapshot_findings(lines, state, ["title"])


@query(f"WITH {_X13} SELECT code, key FROM snapshot")
def x13_snapshot_checks(spark, sf_dir):  # noqa: ANN001, ANN201
    return _snapshot_findings(spark, sf_dir)


_X14 = """r AS (SELECT user_id AS file, event_id AS line, 'd' || lpad((event_id - CASE WHEN event_id % 71 = 0 THEN 500 ELSE 0 END - event_id % 2 * (event_id % 83 // 82))::VARCHAR, 9, '0') AS id, CASE WHEN event_id % 53 = 0 THEN 'merge' WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op, event_id % 47 = 0 AS other FROM events),
    deltas AS (SELECT 'invalid_operation' AS code, id AS key FROM r WHERE op = 'merge' UNION ALL SELECT 'sync_id_mismatch', id FROM r WHERE other
        UNION ALL SELECT 'duplicate_delta_document', id FROM r GROUP BY file, id HAVING count(*) > 1
        UNION ALL SELECT 'delta_order', id FROM (SELECT *, lag(id) OVER (PARTITION BY file ORDER BY line) AS before FROM r) WHERE before > id
        UNION ALL SELECT 'unknown_document', id FROM r WHERE op = 'upsert' AND id NOT IN (SELECT 'd' || lpad(o_orderkey::VARCHAR, 9, '0') FROM orders WHERE o_orderkey % 3 <> 0))"""


def _delta_findings(spark, sf_dir):  # noqa: ANN001, ANN202
    e = F.col("event_id")
    number = e - F.when(e % 71 == 0, 500).otherwise(0) - e % 2 * F.floor(e % 83 / 82)
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("file"), e.alias("line"), F.concat(F.lit("d"), F.lpad(number.cast("string"), 9, "0")).alias("document_id"), F.when(e % 53 == 0, "merge").when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("operation"), F.when(e % 47 == 0, "x").otherwise("s").alias("sync_id"), F.lit("s").alias("file_sync"))
    documents = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.concat(F.lit("d"), F.lpad(_s("o_orderkey"), 9, "0")).alias("document_id"))
    return checks.delta_findings(rows, documents)


@query(f"WITH {_X14} SELECT code, key FROM deltas")
def x14_delta_checks(spark, sf_dir):  # noqa: ANN001, ANN201
    return _delta_findings(spark, sf_dir)


_X15 = """c AS (SELECT 'R' || r_regionkey AS key, r_name AS path, NULL AS fault FROM region UNION ALL SELECT 'N' || n_nationkey, CASE WHEN n_nationkey % 6 = 0 THEN '[missing:R9]/' ELSE r_name || '/' END || n_name, CASE WHEN n_nationkey % 6 = 0 THEN 'missing_parent' END FROM nation JOIN region ON n_regionkey = r_regionkey),
    collections AS (SELECT 'collection_fault' AS code, fault || ':' || key AS key FROM c WHERE fault IS NOT NULL UNION ALL SELECT 'unknown_collection', 'Z1'
        UNION ALL SELECT 'missing_collection', key FROM c WHERE key IN ('N3', 'R2') UNION ALL SELECT 'collection_path_mismatch', key FROM c WHERE key IN ('N4', 'N14'))"""


def _collection_findings(spark, sf_dir):  # noqa: ANN001, ANN202
    region = table(spark, sf_dir, "region").select(F.concat(F.lit("R"), "r_regionkey").alias("key"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_key"))
    nation = table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), "n_nationkey"), "n_name", F.concat(F.lit("R"), F.when(F.col("n_nationkey") % 6 == 0, 9).otherwise(F.col("n_regionkey"))))
    paths = graph.collection_paths(region.unionAll(nation))
    extra = spark.createDataFrame([("Z1", "gone")], "key string, path string")
    stored = paths.where(~F.col("key").isin("N3", "R2")).select("key", F.when(F.col("key").isin("N4", "N14"), "old").otherwise(F.col("path")).alias("path")).unionAll(extra)
    return checks.collection_findings(stored, paths)


@query(f"WITH {_X15} SELECT code, key FROM collections")
def x15_collection_checks(spark, sf_dir):  # noqa: ANN001, ANN201
    return _collection_findings(spark, sf_dir)


_J17 = """st AS (SELECT o_orderkey AS id, o_orderkey % 8 <> 0 AS active, o_totalprice AS content, coalesce(n, 0) + (o_orderkey % 20 = 1)::INT AS chunk_count FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
    tb AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 24 = 0 OR o_orderkey % 40 = 1),
    so AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 23 = 0 THEN -1.0 ELSE o_totalprice END AS own FROM orders WHERE o_orderkey % 19 <> 0),
    ch AS (SELECT l_orderkey AS id, l_orderkey || ':' || l_linenumber AS chunk FROM lineitem), pt AS (SELECT chunk || CASE WHEN id % 41 = 0 THEN 'x' ELSE '' END AS point FROM ch),
    index AS (SELECT 'active_tombstone' AS code, id::VARCHAR AS key FROM st WHERE active AND id IN (SELECT id FROM tb) UNION ALL SELECT 'inactive_without_tombstone', id::VARCHAR FROM st WHERE NOT active AND id NOT IN (SELECT id FROM tb)
        UNION ALL SELECT 'missing_source', st.id::VARCHAR FROM st LEFT JOIN so USING (id) WHERE active AND own IS NULL UNION ALL SELECT 'stale_content', id::VARCHAR FROM st JOIN so USING (id) WHERE active AND own <> content
        UNION ALL SELECT 'chunk_count_mismatch', st.id::VARCHAR FROM st LEFT JOIN (SELECT id, count(*) AS n FROM ch GROUP BY id) AS c USING (id) WHERE active AND coalesce(n, 0) <> chunk_count
        UNION ALL SELECT 'orphan_chunk', chunk FROM ch WHERE id NOT IN (SELECT id FROM st WHERE active) UNION ALL SELECT 'missing_point', chunk FROM ch WHERE id IN (SELECT id FROM st WHERE active) AND chunk NOT IN (SELECT point FROM pt)
        UNION ALL SELECT 'extra_point', point FROM pt WHERE point NOT IN (SELECT chunk FROM ch))"""


def _index_findings(spark, sf_dir):  # noqa: ANN001, ANN202
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    counted = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    state = o.join(counted, "o_orderkey", "left").select(k.alias("document_id"), (k % 8 != 0).alias("active"), F.col("o_totalprice").alias("content"), (F.coalesce("n", F.lit(0)) + (k % 20 == 1).cast("int")).alias("chunk_count"))
    tombstones = o.where((k % 24 == 0) | (k % 40 == 1)).select(k.alias("document_id"))
    sources = o.where(k % 19 != 0).select(k.alias("document_id"), F.when(k % 23 == 0, -1.0).otherwise(F.col("o_totalprice")).alias("content"))
    chunks = table(spark, sf_dir, "lineitem").select(F.concat_ws(":", _s("l_orderkey"), _s("l_linenumber")).alias("chunk_id"), F.col("l_orderkey").alias("document_id"))
    points = chunks.select(F.concat("chunk_id", F.when(F.col("document_id") % 41 == 0, "x").otherwise("")).alias("point_id"), "document_id")
    return checks.index_findings(state, tombstones, chunks, sources, points)


@query(f"WITH {_J17} SELECT code, key FROM index")
def j17_index_consistency(spark, sf_dir):  # noqa: ANN001, ANN201
    return _index_findings(spark, sf_dir)


_SUITES = {"snapshot": _snapshot_findings, "deltas": _delta_findings, "collections": _collection_findings, "index": _index_findings}


@query(f"""WITH {_X13}, {_X14}, {_X15}, {_J17} {" UNION ALL ".join(f"SELECT '{s}' AS suite, code, count(*) AS n, min(key) AS example FROM {s} GROUP BY code" for s in _SUITES)}""")
def c9_validation(spark, sf_dir):  # noqa: ANN001, ANN201
    parts = [f(spark, sf_dir).withColumn("suite", F.lit(s)) for s, f in _SUITES.items()]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return every.groupBy("suite", "code").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("example"))


# ---- routed search


_ASKED = ["how to read it", "a list of references", "traceback in loop", "is the version compatible", "upgrade path", "where"]
_INTENTS = ["api_usage", "source_understanding", "debug", "compatibility", "migration", "source_understanding"]
_PATHS = ["Intro > Literature Cited", "A/B :: Method", "References", "Results", "Works cited"]
_KINDS = ["source_code", "api_documentation", "example", "tutorial", "version_diff", "migration_guide", "issue", "other"]
_VENUES = ["NIPS", "ICLR", "", "neurips"]


def _hits(spark, sf_dir):  # noqa: ANN001, ANN202
    q, p = F.col("query_id"), F.col("point_id")
    hits = catalog._dense(spark, sf_dir, 10)
    asked = F.element_at(F.array(*map(F.lit, _ASKED)), F.expr(f"int(query_id div 100 % {len(_ASKED)} + 1)"))
    return hits.select(
        q, p, F.round("score", 9).alias("score"), "rank", asked.alias("query"), _picked(_PATHS, p).alias("path"), _picked(_KINDS, p).alias("source_type"), _picked([*features.EVIDENCE_ROLES, "unknown", "unknown"], p).alias("role"),
        p.alias("writing_id"), _picked(["1. Introduction", "2 Methods", "Overview"], p).alias("section"), _picked(_VENUES, p).alias("venue"), F.array(_picked(["Graph Learning!", "vision", "NeurIPS"], p)).alias("domains"), _picked(["a graph", "an image", "text"], F.expr("point_id div 2")).alias("title"), F.lit("").alias("text"),
    )


def _adjustments(spark, sf_dir):  # noqa: ANN001, ANN202
    return retrieval.feedback_scores(table(spark, sf_dir, "events").select(F.col("user_id").alias("target"), F.col("event_type").alias("label")), catalog.WEIGHTS)


def _routes(spark, sf_dir):  # noqa: ANN001, ANN202
    hits = _hits(spark, sf_dir)
    return {"literature": hub.literature(hits, 5), "code": hub.code(hits, 5), "writing": hub.writing(hits, _adjustments(spark, sf_dir), 5, section="Introduction", domain="graph learning")}


_DENSE = catalog._DENSE
_PRIORITY = "CASE intent " + " ".join(f"WHEN '{i}' THEN coalesce(nullif(list_position({list(k)}, kind), 0), 100) - 1" for i, k in features.SOURCE_PRIORITIES.items()) + " END"
_ROUTES = f"""{_DENSE}, w AS (SELECT user_id, greatest(-0.5, least(0.3, sum(CASE event_type {" ".join(f"WHEN '{k}' THEN {v}" for k, v in catalog.WEIGHTS.items())} ELSE 0.0 END::DOUBLE))) AS adjustment FROM events GROUP BY user_id),
    x AS (SELECT query_id, point_id, round(score, 9) AS score, rank, {_INTENTS}[query_id // 100 % 6 + 1] AS intent, query_id // 100 % 6 = 1 AS bibliography, point_id % 5 IN (0, 2, 4) AS listed, {_KINDS}[point_id % 8 + 1] AS kind, [0, 1, 2, 3, 4, 99, 99][point_id % 7 + 1] AS role,
            point_id % 3 <> 1 AS introduction, point_id % 3 = 0 OR point_id // 2 % 3 = 0 AS graph, adjustment FROM dense LEFT JOIN w ON user_id = point_id),
    literature AS (SELECT query_id, point_id, row_number() OVER (PARTITION BY query_id ORDER BY listed AND NOT bibliography, rank) AS new_rank FROM x QUALIFY new_rank <= 5),
    code AS (SELECT query_id, point_id, row_number() OVER (PARTITION BY query_id ORDER BY role, {_PRIORITY}, score DESC, rank) AS new_rank FROM x QUALIFY new_rank <= 5),
    writing AS (SELECT query_id, point_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score + coalesce(adjustment, 0), 9) DESC, rank) AS new_rank FROM x WHERE introduction AND graph QUALIFY new_rank <= 5)"""


@query(f"""WITH {_ROUTES} {" UNION ALL ".join(f"SELECT '{c}' AS corpus, query_id, point_id, new_rank::INT AS new_rank FROM {c}" for c in ("literature", "code", "writing"))}""")
def c1_k5_k6_p3_routed_search(spark, sf_dir):  # noqa: ANN001, ANN201
    parts = [df.select(F.lit(c).alias("corpus"), "query_id", "point_id", "new_rank") for c, df in _routes(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_SEARCHED = ["how to read it", "a list of references", "traceback in the loop", "is the version compatible", "the upgrade path of a template", "  "]
_SEARCH_SQL = f"""
    WITH e AS (
        SELECT vec_id AS p, embedding::DOUBLE[] AS e, coalesce(text, '') AS text, ['literature', 'code', 'writing'][vec_id % 3 + 1] AS corpus, vec_id % 10 <> 9 AS ready, vec_id // 3 AS n FROM embeddings LEFT JOIN documents ON doc_id = vec_id),
    v AS (SELECT * FROM e WHERE ready),
    q AS (SELECT p AS query_id, e, {_SEARCHED}[p // 100 % 6 + 1] AS query, p // 100 % 6 AS kind, c.corpus FROM e, (VALUES ('literature'), ('code'), ('writing')) AS c(corpus) WHERE p % 100 = 0 AND p // 100 % 6 <> 5),
    d AS (
        SELECT q.query_id, q.corpus, v.p, row_number() OVER (PARTITION BY q.query_id, q.corpus ORDER BY round(greatest(-1.0, least(1.0, list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))))), 9) DESC, v.p) AS rank
        FROM q JOIN v ON v.corpus = q.corpus AND (q.corpus <> 'writing' OR kind <> 4 OR v.n % 3 = 1) QUALIFY rank <= 20),
    t AS (SELECT p, corpus, g, regexp_extract_all(lower(text), '[a-z0-9_]+') AS ws FROM (SELECT *, 'all' AS g FROM v UNION ALL SELECT *, 'template' FROM v WHERE corpus = 'writing' AND n % 3 = 1)),
    z AS (SELECT corpus, g, count(*) AS docs, avg(len(ws)) AS mean FROM t GROUP BY corpus, g),
    tf AS (SELECT p, corpus, g, term, count(*) AS tf, length FROM (SELECT p, corpus, g, len(ws) AS length, unnest(ws) AS term FROM t) GROUP BY ALL),
    w AS (SELECT DISTINCT query_id, corpus, CASE WHEN corpus = 'writing' AND kind = 4 THEN 'template' ELSE 'all' END AS g, unnest(regexp_extract_all(lower(query), '[a-z0-9_]+')) AS term FROM q),
    df AS (SELECT corpus, g, term, count(*) AS df FROM tf GROUP BY corpus, g, term),
    s AS (
        SELECT query_id, corpus, p, row_number() OVER (PARTITION BY query_id, corpus ORDER BY round(score, 9) DESC, p) AS rank FROM (
            SELECT query_id, corpus, p, sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS score
            FROM tf JOIN w USING (corpus, g, term) JOIN df USING (corpus, g, term) JOIN z USING (corpus, g) GROUP BY query_id, corpus, p) QUALIFY rank <= 20),
    f AS (
        SELECT query_id, corpus, p, round(score, 9) AS score, row_number() OVER (PARTITION BY query_id, corpus ORDER BY round(score, 12) DESC, p) AS rank FROM (
            SELECT query_id, corpus, p, sum(1.0::DOUBLE / (60 + rank)) AS score FROM (FROM d UNION ALL FROM s) GROUP BY query_id, corpus, p) QUALIFY rank <= 20),
    x AS (
        SELECT f.*, kind, p % 5 IN (0, 2, 4) AND kind <> 1 AS listed, {_KINDS}[p % 8 + 1] AS source, [0, 1, 2, 3, 4, 99, 99][p % 7 + 1] AS role, {_INTENTS}[kind + 1] AS intent
        FROM f JOIN q USING (query_id, corpus) WHERE rank <= CASE WHEN corpus = 'code' OR corpus = 'literature' AND kind = 1 THEN 5 ELSE 20 END AND (corpus <> 'writing' OR n_introduction(p)))"""


def _search_sql() -> str:
    priority = _PRIORITY.replace(", kind)", ", source)")
    head = _SEARCH_SQL.replace("n_introduction(p)", "p % 4 <> 1")
    return f"""{head}
        SELECT corpus, query_id, p AS point_id, score, row_number() OVER (PARTITION BY corpus, query_id ORDER BY CASE WHEN corpus = 'literature' THEN listed::INT WHEN corpus = 'code' THEN role ELSE 0 END,
                   CASE WHEN corpus = 'code' THEN {priority} ELSE 0 END, CASE WHEN corpus <> 'literature' THEN -score ELSE 0 END, rank)::INT AS new_rank,
               CASE WHEN corpus = 'literature' AND max(listed) OVER (PARTITION BY corpus, query_id) THEN 'bibliography_sections_demoted' ELSE '' END AS warnings
        FROM x QUALIFY new_rank <= 5"""


@query(_search_sql())
def c1_k11_hub_search(spark, sf_dir):  # noqa: ANN001, ANN201
    p = F.col("vec_id")
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), F.coalesce("text", F.lit("")).alias("text"))
    every = table(spark, sf_dir, "embeddings").join(texts, "vec_id", "left")
    queries = every.where(p % 100 == 0).select(p.alias("query_id"), F.element_at(F.array(*map(F.lit, _SEARCHED)), F.expr("int(vec_id div 100 % 6 + 1)")).alias("query"), F.col("embedding").alias("vec"))
    points = every.select(
        p.alias("point_id"), _picked(list(hub.CORPORA), p).alias("corpus"), F.coalesce("text", F.lit("")).alias("text"), F.col("embedding").alias("vec"), F.when(p % 10 == 9, "gone").otherwise("ready").alias("status"), _picked(_PATHS, p).alias("path"), _picked(_KINDS, p).alias("source_type"),
        _picked([*features.EVIDENCE_ROLES, "unknown", "unknown"], p).alias("role"), p.alias("writing_id"), _picked(["1. Introduction", "2 Methods", "Overview", "introduction"], p).alias("section"), F.lit("").alias("venue"), F.array().cast("array<string>").alias("domains"), F.lit("").alias("title"), _picked(["strategy", "template", "phrase"], F.expr("vec_id div 3")).alias("asset_type"),
    )
    out = None
    for corpus in hub.CORPORA:
        post = {"section": "Introduction"} if corpus == "writing" else {}
        found = hub.search(queries, points, corpus, catalog._tokens, equal={"status": "ready"}, **post)
        found = found.select(F.lit(corpus).alias("corpus"), "query_id", "point_id", F.round("score", 9).alias("score"), "new_rank", F.array_join("warnings", ",").alias("warnings"))
        out = found if out is None else out.unionByName(found)
    return out


@query(f"""WITH {_DENSE}, h AS (SELECT query_id, rank, point_id // 10 AS document_id, point_id % 10 AS chunk_index FROM dense WHERE rank <= 3)
          SELECT query_id, rank::INT AS rank, string_agg((vec_id % 10) || ':' || label, ',' ORDER BY vec_id) AS neighbours FROM h JOIN embeddings ON vec_id // 10 = document_id AND vec_id % 10 BETWEEN chunk_index - 1 AND chunk_index + 2 GROUP BY ALL""")
def x46_search_with_neighbours(spark, sf_dir):  # noqa: ANN001, ANN201
    hits = catalog._dense(spark, sf_dir, 3).select("query_id", "rank", F.expr("point_id div 10").alias("document_id"), (F.col("point_id") % 10).alias("chunk_index"))
    chunks = table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 10").alias("document_id"), (F.col("vec_id") % 10).alias("chunk_index"), _s("label").alias("text"))
    found = hub.with_neighbours(hits, chunks, 1, 2)
    return found.select("query_id", "rank", F.array_join(F.transform("neighbours", lambda n: F.concat(n["near"], F.lit(":"), n["text"])), ",").alias("neighbours"))
