"""All queries of the engine's own operators on the driver's tables, and their SQL.

Where the tables lack a notion (versions, states, sections), it is derived from keys by arithmetic,
the same way on both sides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestone.functions import hashing, text, vector
from lodestone.operators import changelog, graph, metrics, provenance, retrieval
from lodestone.plans import chunking
from lodestone.registry import ORACLES, QUERIES, query, table  # noqa: F401

NAMESPACE = uuid.UUID("6f1f2f0e-9a4e-5b1c-8a53-0d2c8c4d7e11")
WEIGHTS = {"purchase": 0.1, "error": -0.15, "view": 0.01, "click": -0.02}


def _words(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '[a-z0-9_]+')"


def _tokens(column: str):  # noqa: ANN202
    return F.regexp_extract_all(F.lower(F.col(column)), F.lit("[a-z0-9_]+"), 0)


# ---- text functions


@query("""SELECT doc_id, greatest(1, len(regexp_extract_all(text, '[^\\s]+')))::BIGINT AS tokens,
          greatest(len(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+|[^\\p{L}\\p{M}\\p{N}_\\s]')), ceil(length(text) / 4.0))::BIGINT AS estimate FROM documents""")
def f2_f3_token_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).alias("tokens"), text.token_estimate(F.col("text")).alias("estimate"))


@query(f"""WITH l AS (SELECT doc_id, regexp_extract_all(text, '{text.LEXICAL.replace("'", "''")}') AS t FROM documents)
          SELECT doc_id, len(t)::BIGINT AS n, len(list_distinct(t))::BIGINT AS distinct_n, coalesce(t[1], '') AS first FROM l""")
def f6_lexical_tokens(spark, sf_dir):  # noqa: ANN001, ANN201
    found = table(spark, sf_dir, "documents").select("doc_id", text.lexical_tokens(F.col("text")).alias("t"))
    return found.select("doc_id", F.size("t").cast("bigint").alias("n"), F.size(F.array_distinct("t")).cast("bigint").alias("distinct_n"), F.coalesce(F.get("t", F.lit(0)), F.lit("")).alias("first"))


@query("""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?])\\s*', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)
          SELECT doc_id, len(s)::BIGINT AS n, coalesce(max(len(x)), 0)::BIGINT AS longest FROM s LEFT JOIN LATERAL (SELECT unnest(s.s) AS x) ON true GROUP BY doc_id, s""")
def f4_sentences(spark, sf_dir):  # noqa: ANN001, ANN201
    found = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.trim(F.regexp_replace("text", r"\s+", " "))).alias("s"))
    return found.select("doc_id", F.size("s").cast("bigint").alias("n"), F.coalesce(F.array_max(F.transform("s", F.length)), F.lit(0)).cast("bigint").alias("longest"))


@query(f"""SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '{text.CITATION}', '[CITATION]', 'g'), '{text.NUMBER}', '[VALUE]', 'g')) AS masked_sha256 FROM documents""")
def f13_masking(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").select("doc_id", hashing.sha256(text.masked(F.col("text"))).alias("masked_sha256"))


@query(f"""SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '{text.ASSIGNMENT}', '\\1[REDACTED]', 'g'), '{text.KEY_PARAMETER}', '\\1[REDACTED]', 'g')) AS redacted_sha256,
          regexp_matches(text, '{text.INJECTION}') AS injected, length(text) > 500 AS cut FROM documents""")
def f26_p6_redaction(spark, sf_dir):  # noqa: ANN001, ANN201
    _, cut, injected = text.marked(F.col("text"), 500)
    return table(spark, sf_dir, "documents").select("doc_id", hashing.sha256(text.redacted(F.col("text"))).alias("redacted_sha256"), injected.alias("injected"), cut.alias("cut"))


@query(f"""SELECT doc_id, CASE WHEN c > 0.2 * l THEN 'zh' WHEN l > 0 THEN 'en' ELSE 'und' END AS language,
          regexp_matches(text, '(?i)^\\s*(?:figure|fig\\.|table|图|表)\\s*\\d+') OR (c = 0 AND len(regexp_extract_all(text, '[A-Za-z]+(?:[-''][A-Za-z]+)*')) < 12) AS excluded
          FROM (SELECT *, len(regexp_extract_all(text, '{text.CJK_CHAR}')) AS c, len(regexp_extract_all(text, '[A-Za-z]')) AS l FROM documents)""")
def f17_p8_language(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").select("doc_id", text.language(F.col("text")).alias("language"), text.excluded_material(F.col("text")).alias("excluded"))


def _bounded(pattern: str) -> str:
    """A pattern within word boundaries that count letters beyond ASCII, too."""
    edge = r"[^\p{L}\p{M}\p{N}_]"
    return "(?i)" + pattern.replace(r"\b(?:", f"(?:^|{edge})(?:", 1).removesuffix(r"\b") + f"(?:$|{edge})"


_FLAGS = ", ".join(f"CASE WHEN regexp_matches(text, '{_bounded(p)}')" + (r" AND NOT regexp_matches(text, '\d')" if f == "vague_claim" else "") + f" THEN '{f}' END" for f, p in text.RISK.items())
_CATEGORY = "['result_reporting', 'future_work', 'incremental_novelty_positioning'][doc_id % 3 + 1]"


def _category():  # noqa: ANN202
    names = F.array(F.lit("result_reporting"), F.lit("future_work"), F.lit("incremental_novelty_positioning"))
    return F.element_at(names, (F.col("doc_id") % 3 + 1).cast("int"))


@query(f"""WITH f AS (SELECT doc_id, text, {_CATEGORY} AS category,
            list_sort(list_filter([{_FLAGS}, CASE WHEN {_CATEGORY} = 'incremental_novelty_positioning' AND NOT regexp_matches(text, '{_bounded(text.COMPARISON)}') THEN 'missing_comparison' END], lambda x: x IS NOT NULL)) AS flags,
            len(regexp_extract_all(text, '[A-Za-z0-9-]+|{text.CJK_CHAR}')) AS n FROM documents)
          SELECT doc_id, array_to_string(flags, ',') AS flags, round(greatest(0, least(1, 0.2 * 0.8 + 0.2 * CASE WHEN n BETWEEN 8 AND 80 THEN 1.0 ELSE 0.6 END
            + 0.15 * CASE WHEN regexp_matches(text, '^(?:This|It|These|Those|They)\\b') THEN 0.6 ELSE 1.0 END
            + 0.15 * CASE WHEN regexp_matches(rtrim(text), '[.?!。？！]$') THEN 1.0 ELSE 0.7 END
            + 0.15 * CASE WHEN length(trim(text)) >= 20 THEN 1.0 ELSE 0.5 END
            + 0.15 * CASE WHEN category = 'result_reporting' OR category = 'future_work' THEN CASE WHEN category = 'result_reporting' THEN 1.0 ELSE 0.5 END ELSE 1.0 END
            - least(0.25, 0.05 * len(flags))))::DOUBLE, 6) AS quality FROM f""")
def f18_f19_risk_quality(spark, sf_dir):  # noqa: ANN001, ANN201
    flags = text.risk_flags(F.col("text"), _category())
    quality = text.material_quality(F.col("text"), _category(), F.lit("experiment"), F.lit(0.8), flags)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(flags, ",").alias("flags"), quality.alias("quality"))


_SECTIONS = ["1. Introduction", "II. Related Work", "3.2 Proposed Method", "A.1 Ablation Experiments", "Conclusions and Outlook", "实验", "Appendix B: Proofs"]
_FAMILY_SQL = "CASE section WHEN '1. Introduction' THEN 'introduction' WHEN 'II. Related Work' THEN 'related_work' WHEN '3.2 Proposed Method' THEN 'method' WHEN 'A.1 Ablation Experiments' THEN 'experiment' WHEN 'Conclusions and Outlook' THEN 'conclusion' WHEN '实验' THEN 'experiment' ELSE 'appendix b proofs' END"


def _sectioned(spark, sf_dir):  # noqa: ANN001, ANN202
    section = F.element_at(F.array(*map(F.lit, _SECTIONS)), (F.col("doc_id") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", "text", section.alias("section"))


_SECTIONED = f"SELECT doc_id, text, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS v, {_SECTIONS}[doc_id % 7 + 1] AS section FROM documents"


@query(f"""WITH d AS ({_SECTIONED}), f AS (SELECT *, {_FAMILY_SQL} AS family FROM d)
          SELECT doc_id, family, CASE WHEN NOT length(v) BETWEEN 60 AND 1800 OR regexp_matches(v, '{text.FORMULA}') THEN NULL
            WHEN family = 'introduction' THEN CASE WHEN regexp_matches(v, '(?i)we (?:propose|present|introduce)|our contribution') THEN 'contribution_statement' WHEN regexp_matches(v, '{text.GAP}') THEN 'research_gap' WHEN regexp_matches(v, '(?i)motiv|therefore|to address') THEN 'motivation' ELSE 'background' END
            WHEN family = 'related_work' THEN CASE WHEN regexp_matches(v, '(?i)whereas|unlike|compared') THEN 'method_comparison' ELSE 'method_summary' END
            WHEN family = 'method' THEN CASE WHEN regexp_matches(v, '(?i)because|in order to|allows us') THEN 'design_rationale' ELSE 'method_overview' END
            WHEN family = 'experiment' THEN CASE WHEN regexp_matches(v, '(?i)\\b(?:outperform|higher|lower|increase|decrease|improv\\w*\\s+by|compared (?:with|to)|versus)\\b') THEN 'quantitative_comparison' WHEN regexp_matches(v, '(?i)indicat|suggest|because') THEN 'result_interpretation' ELSE 'experimental_setup' END
            WHEN family = 'conclusion' THEN CASE WHEN regexp_matches(v, '(?i)\\bfuture|will (?:investigate|explore|study|extend)\\b') THEN 'future_work' WHEN regexp_matches(v, '(?i)\\b(?:remain|limitation|limited|challenge|cannot|fails?)\\b') THEN 'limitation' ELSE 'work_summary' END END AS function,
            round(least(1, greatest(0, 0.55 + CASE WHEN length(v) BETWEEN 90 AND 900 THEN 0.15 ELSE 0 END + CASE WHEN regexp_matches(v, '^(This|It|They|These|Those)\\b') THEN 0 ELSE 0.1 END - CASE WHEN regexp_matches(v, '{text.CITATION}') THEN 0.05 ELSE 0 END + CASE WHEN regexp_matches(v, '[.!?]$') THEN 0.05 ELSE 0 END))::DOUBLE, 6) AS quality FROM f""")
def f9_f11_f14_rhetoric(spark, sf_dir):  # noqa: ANN001, ANN201
    value, family = F.col("value"), F.col("family")
    rows = _sectioned(spark, sf_dir).select("doc_id", text.collapsed(F.col("text")).alias("value"), text.section_family(F.col("section")).alias("family"))
    return rows.select("doc_id", "family", text.rhetorical_function(value, family).alias("function"), F.round(text.rule_quality(value), 6).alias("quality"))


_ROLE_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(s), '{p}') THEN '{r}'" for r, p in text.SENTENCE_ROLES.items()) + " WHEN i = 1 THEN 'establish_context' ELSE 'summarize_progress' END"


@query(f"""WITH d AS (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?])\\s*', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS ss FROM documents),
          e AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM d),
          r AS (SELECT doc_id, i, {_ROLE_SQL} AS role FROM e),
          t AS (SELECT doc_id, i, role, lead(role) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM r)
          SELECT d.doc_id, coalesce(string_agg(role, ' -> ' ORDER BY i), '') AS pattern, coalesce(string_agg(role || '_to_' || after, ',' ORDER BY i) FILTER (after IS NOT NULL), '') AS transitions FROM d LEFT JOIN t USING (doc_id) GROUP BY d.doc_id""")
def f15_w3_paragraph_structure(spark, sf_dir):  # noqa: ANN001, ANN201
    found = table(spark, sf_dir, "documents").select("doc_id", text.sentence_roles(F.col("text")).alias("roles"))
    return found.select("doc_id", F.array_join("roles", " -> ").alias("pattern"), F.array_join(text.transitions(F.col("roles")), ",").alias("transitions"))




@query(f"""WITH p AS (SELECT page_id, ['', 'docs/migration/', 'src/examples/', 'tutorials/', 'a/README.', 'x/CHANGELOG-'][page_id % 6 + 1] || page_id || ['.py', '.md'][page_id % 2 + 1] AS path, html FROM pages),
          s AS (SELECT *, CASE WHEN lower(path) LIKE '%migration%' THEN 'migration_guide' WHEN regexp_matches(lower(path), '(changelog|release)[^/]*$') THEN 'changelog' WHEN lower(path) LIKE '%.py' THEN 'source_code' WHEN '/' || lower(path) LIKE '%/examples/%' THEN 'example' WHEN '/' || lower(path) LIKE '%/tutorial%' THEN 'tutorial' WHEN regexp_matches(lower(path), '(^|/)readme[^/]*$') THEN 'repository_readme' ELSE 'api_documentation' END AS source_type FROM p)
          SELECT page_id, source_type, array_to_string(list_sort(list_filter([{", ".join("CASE WHEN " + " OR ".join(f"contains(lower(html), '{w}')" for w in ws) + f" THEN '{t}' END" for t, ws in text.TASK_TAGS.items())},
            CASE WHEN source_type IN ('example', 'tutorial') THEN 'example' END, CASE WHEN source_type IN ('example', 'tutorial') THEN 'api_usage' END, CASE WHEN source_type = 'source_code' THEN 'implementation' END], lambda x: x IS NOT NULL)), ',') AS tags FROM s""")
def s20_f22_source_types(spark, sf_dir):  # noqa: ANN001, ANN201
    heads, tails = ["", "docs/migration/", "src/examples/", "tutorials/", "a/README.", "x/CHANGELOG-"], [".py", ".md"]
    path = F.concat(F.element_at(F.array(*map(F.lit, heads)), (F.col("page_id") % 6 + 1).cast("int")), F.col("page_id").cast("string"), F.element_at(F.array(*map(F.lit, tails)), (F.col("page_id") % 2 + 1).cast("int")))
    typed = table(spark, sf_dir, "pages").select("page_id", "html", text.source_type_of_path(path).alias("source_type"))
    return typed.select("page_id", "source_type", F.array_join(text.task_tags(F.col("source_type"), F.col("html")), ",").alias("tags"))


@query("""SELECT doc_id, CASE """ + " ".join(f"WHEN regexp_matches(text, '(?i){p}') THEN '{n}'" for n, p in text.CODE_INTENTS.items()) + """ ELSE 'source_understanding' END AS intent,
          CASE WHEN s::INT + t::INT + p::INT = 1 THEN CASE WHEN s THEN 'strategy' WHEN t THEN 'template' ELSE 'phrase' END END AS asset
          FROM (SELECT *, """ + ", ".join(f"regexp_matches(text, '(?i){p}') AS {n[0]}" for n, p in text.ASSET_INTENTS.items()) + """ FROM documents)""")
def f20_f21_intents(spark, sf_dir):  # noqa: ANN001, ANN201
    # the initials name the three asset patterns in the SQL
    return table(spark, sf_dir, "documents").select("doc_id", text.code_intent(F.col("text")).alias("intent"), text.asset_intent(F.col("text")).alias("asset"))


# ---- identities


@query("""SELECT doc_id, sha256(text) AS sha256, substr(sha256(doc_id::VARCHAR), 1, 32) AS artifact, ((('0x' || substr(sha256(doc_id::VARCHAR), 1, 16))::UBIGINT) % 7)::BIGINT AS partition,
          'zotero:user:' || doc_id || ':' || source || ':0' AS document FROM documents""")
def h2_h6_h7_s11_identities(spark, sf_dir):  # noqa: ANN001, ANN201
    key = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select("doc_id", hashing.sha256(F.col("text")).alias("sha256"), hashing.artifact_name(key).alias("artifact"), hashing.stable_partition(key, 7).alias("partition"), hashing.document_id(F.lit("user"), key, F.col("source"), F.lit("0"), F.lit(None)).alias("document"))


@query("""SELECT source, sha256(string_agg(sha256(text), ',' ORDER BY doc_id)) AS fingerprint, count(*) AS n FROM documents GROUP BY source""")
def h9_corpus_fingerprint(spark, sf_dir):  # noqa: ANN001, ANN201
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", hashing.sha256(F.col("text")).alias("h"))
    return hashing.corpus_fingerprint(docs, "source", "doc_id", "h")


# ---- chunking and budgets


@query("""WITH RECURSIVE p AS (SELECT doc_id, trim(x) AS x, i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) WHERE trim(x) <> ''),
          q AS (SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k, greatest(1, len(regexp_extract_all(x, '[^\\s]+'))) AS n FROM p),
          f(doc_id, k, chunk, used) AS (SELECT doc_id, k, 0, n FROM q WHERE k = 1 UNION ALL
            SELECT q.doc_id, q.k, CASE WHEN used + n > 64 THEN chunk + 1 ELSE chunk END, CASE WHEN used + n > 64 THEN n ELSE used + n END FROM f JOIN q ON q.doc_id = f.doc_id AND q.k = f.k + 1)
          SELECT f.doc_id, chunk::BIGINT AS chunk_index, sum(n)::BIGINT AS token_count, sha256(string_agg(x, chr(10) || chr(10) ORDER BY f.k)) AS text_sha256 FROM f JOIN q USING (doc_id, k) GROUP BY f.doc_id, chunk""")
def w4_chunks(spark, sf_dir):  # noqa: ANN001, ANN201
    return chunking.chunks(table(spark, sf_dir, "documents"), "doc_id", "text", 64, "\n").select("doc_id", "chunk_index", "token_count", "text_sha256")


@query("""SELECT conv_id, turn, least(length(text), 1500 - before)::BIGINT AS granted FROM (
            SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM conversations) WHERE before < 1500 AND length(text) > 0""")
def w9_evidence_budget(spark, sf_dir):  # noqa: ANN001, ANN201
    hits = table(spark, sf_dir, "conversations").withColumn("cost", F.length("text").cast("bigint"))
    return chunking.budgeted(hits, "conv_id", "turn", "cost", 1500).select("conv_id", "turn", "granted")


@query("SELECT conv_id, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous FROM conversations GROUP BY conv_id")
def w14_contiguity(spark, sf_dir):  # noqa: ANN001, ANN201
    return changelog.contiguous(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query("""SELECT c.conv_id, c.turn, h.turn AS hit FROM conversations AS c JOIN (SELECT conv_id, turn FROM conversations WHERE turn % 3 = 1) AS h ON c.conv_id = h.conv_id AND c.turn BETWEEN h.turn - 1 AND h.turn + 1""")
def j15_neighbours(spark, sf_dir):  # noqa: ANN001, ANN201
    chunks = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("chunk_index"))
    near = retrieval.neighbours(chunks, chunks.where("chunk_index % 3 = 1"), 1, 1)
    return near.select(F.col("document_id").alias("conv_id"), F.col("chunk_index").alias("turn"), F.col("hit_index").alias("hit"))


# ---- retrieval


def _dense(spark, sf_dir, k):  # noqa: ANN001, ANN202
    points = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vec"))
    queries = points.where("point_id % 100 = 0").select(F.col("point_id").alias("query_id"), F.col("vec").alias("query"))
    return retrieval.dense(queries, points, k)


_COSINE = "list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e)))"
_DENSE = f"""v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    dense AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, point_id) AS rank FROM (
        SELECT q.vec_id AS query_id, v.vec_id AS point_id, greatest(-1.0, least(1.0, {_COSINE})) AS score FROM v AS q, v WHERE q.vec_id % 100 = 0) QUALIFY rank <= 10)"""


@query(f"WITH {_DENSE} SELECT query_id, point_id, round(score, 6) AS score, rank::INT AS rank FROM dense")
def k1_v2_dense_top_k(spark, sf_dir):  # noqa: ANN001, ANN201
    return _dense(spark, sf_dir, 10).withColumn("score", F.round("score", 6))


def _sparse(spark, sf_dir, k):  # noqa: ANN001, ANN202
    # every document with an id divisible by 100 asks for its long words
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("point_id"), "text")
    queries = docs.where("point_id % 100 = 0").select(F.col("point_id").alias("query_id"), F.explode(F.filter(_tokens("text"), lambda t: F.length(t) > 7)).alias("term"))
    return retrieval.sparse(queries, docs, _tokens("text"), k)


_SPARSE = f"""t AS (SELECT doc_id AS point_id, {_words("text")} AS ws FROM documents),
    z AS (SELECT count(*) AS docs, avg(len(ws)) AS mean FROM t),
    p AS (SELECT point_id, term, count(*) AS tf, length FROM (SELECT point_id, len(ws) AS length, unnest(ws) AS term FROM t) GROUP BY point_id, term, length),
    q AS (SELECT DISTINCT point_id AS query_id, unnest(list_filter(ws, lambda x: len(x) > 7)) AS term FROM t WHERE point_id % 100 = 0),
    df AS (SELECT term, count(*) AS df FROM p WHERE term IN (SELECT term FROM q) GROUP BY term),
    sparse AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, point_id) AS rank FROM (
        SELECT query_id, point_id, sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS score
        FROM p JOIN q USING (term) JOIN df USING (term), z GROUP BY query_id, point_id) QUALIFY rank <= 10)"""


@query(f"WITH {_SPARSE} SELECT query_id, point_id, round(score, 6) AS score, rank::INT AS rank FROM sparse")
def k2_bm25_top_k(spark, sf_dir):  # noqa: ANN001, ANN201
    return _sparse(spark, sf_dir, 10).withColumn("score", F.round("score", 6))


@query(f"""WITH {_DENSE}, {_SPARSE}, a AS (SELECT query_id, point_id, rank FROM dense UNION ALL SELECT vec_id, point_id, rank FROM sparse JOIN embeddings ON query_id = vec_id),
          f AS (SELECT query_id, point_id, sum(1.0::DOUBLE / (60 + rank)) AS score FROM a GROUP BY query_id, point_id)
          SELECT query_id, point_id, round(score, 9) AS score, (row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, point_id))::INT AS rank FROM f QUALIFY rank <= 10""")
def k3_a3_hybrid_search(spark, sf_dir):  # noqa: ANN001, ANN201
    # a query has the vector and the document of its number
    asked = table(spark, sf_dir, "embeddings").where("vec_id % 100 = 0").select("vec_id")
    sparse = asked.join(_sparse(spark, sf_dir, 10), F.col("vec_id") == F.col("query_id"))
    rankings = [_dense(spark, sf_dir, 10), sparse.select(F.col("vec_id").alias("query_id"), "point_id", "rank")]
    return retrieval.hybrid(rankings, 10).select(F.col("query_id").cast("bigint").alias("query_id"), "point_id", F.round("score", 9).alias("score"), "rank")


flagship = k3_a3_hybrid_search


@query(f"""WITH q AS (SELECT item_id AS query_id, list_distinct(list_filter({_words("text")}, lambda x: len(x) > 1)) AS q FROM benchmark),
          d AS (SELECT doc_id AS point_id, list_distinct(list_filter({_words("text")}, lambda x: len(x) > 1)) AS d FROM documents)
          SELECT query_id, point_id, round(len(list_intersect(q, d)) / greatest(1, len(q)), 6) AS score, (row_number() OVER (PARTITION BY query_id ORDER BY len(list_intersect(q, d)) / greatest(1, len(q)) DESC, point_id))::INT AS rank FROM q, d QUALIFY rank <= 5""")
def k9_token_overlap(spark, sf_dir):  # noqa: ANN001, ANN201
    own = lambda c: F.array_distinct(F.filter(_tokens(c), lambda x: F.length(x) > 1))
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), own("text").alias("query"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("point_id"), own("text").alias("tokens"))
    return retrieval.token_overlap(queries, docs, 5).withColumn("score", F.round("score", 6))


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND source IN ('src1', 'src2') AND n_chars BETWEEN 100 AND 4000")
def p1_filter(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").where(retrieval.matches(equal={"lang": "en", "source": ""}, within={"source": ["src1", "src2"]}, ranges={"n_chars": (100, 4000)})).select("doc_id")


@query("SELECT source AS value, count(*) AS n FROM documents WHERE source <> '' GROUP BY source ORDER BY n DESC, value LIMIT 7 OFFSET 2")
def a1_facets(spark, sf_dir):  # noqa: ANN001, ANN201
    return retrieval.facets(table(spark, sf_dir, "documents"), F.col("source"), 2, 7)


@query(f"""WITH {_DENSE}, w AS (SELECT user_id, greatest(-0.5, least(0.3, sum(CASE event_type {" ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.items())} ELSE 0.0 END::DOUBLE))) AS adjustment FROM events GROUP BY user_id)
          SELECT query_id, point_id, (row_number() OVER (PARTITION BY query_id ORDER BY round(score + coalesce(adjustment, 0), 9) DESC, rank))::INT AS new_rank FROM dense LEFT JOIN w ON user_id = point_id""")
def a6_k7_feedback_rerank(spark, sf_dir):  # noqa: ANN001, ANN201
    scores = retrieval.feedback_scores(table(spark, sf_dir, "events").select(F.col("user_id").alias("target"), F.col("event_type").alias("label")), WEIGHTS)
    hits = _dense(spark, sf_dir, 10).join(scores, F.col("point_id") == F.col("target"), "left")
    return retrieval.reordered(hits, F.round(F.col("score") + F.coalesce("adjustment", F.lit(0.0)), 9).desc()).select("query_id", "point_id", "new_rank")


@query(f"""WITH {_DENSE} SELECT query_id, point_id, (row_number() OVER (PARTITION BY query_id ORDER BY label % 2, CASE label % 3 WHEN 1 THEN 0 ELSE 1 END, rank))::INT AS new_rank FROM dense JOIN embeddings ON vec_id = point_id""")
def k5_k6_evidence_order(spark, sf_dir):  # noqa: ANN001, ANN201
    labels = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), "label")
    hits = _dense(spark, sf_dir, 10).join(labels, "point_id")
    return retrieval.reordered(hits, F.col("label") % 2, F.when(F.col("label") % 3 == 1, 0).otherwise(1)).select("query_id", "point_id", "new_rank")


@query("""SELECT count(*) AS n, CASE count(*) WHEN 0 THEN 'not_found' WHEN 1 THEN 'unique' ELSE 'ambiguous' END AS status FROM customer WHERE lower(c_name) = 'customer#000000003' OR contains(lower(c_mktsegment), 'zzz')""")
def j14_x7_resolution(spark, sf_dir):  # noqa: ANN001, ANN201
    return retrieval.resolution(table(spark, sf_dir, "customer").where((F.lower("c_name") == "customer#000000003") | F.lower("c_mktsegment").contains("zzz")))


# ---- change log


def _versions(spark, sf_dir):  # noqa: ANN001, ANN202
    """Two snapshots of the orders."""
    o = table(spark, sf_dir, "orders")
    status = lambda k: F.when(F.col("o_orderkey") % k == 0, "missing_archive").when(F.col("o_orderkey") % k == 1, "invalid_archive").otherwise("ready")
    archive, collections = F.col("o_orderstatus"), F.col("o_orderpriority")
    old = o.where("o_orderkey % 17 <> 0").select(F.col("o_orderkey").alias("k"), status(23).alias("status"), F.col("o_totalprice").alias("content"), archive.alias("archive"), F.col("o_custkey").alias("metadata"), collections.alias("collections"))
    touched = lambda k, c, other: F.when(F.col("o_orderkey") % k == 0, other).otherwise(c)
    new = o.where("o_orderkey % 19 <> 0").select(
        F.col("o_orderkey").alias("k"), status(29).alias("status"), touched(13, F.col("o_totalprice"), F.lit(0.0)).alias("content"), touched(11, archive, F.lit("X")).alias("archive"), touched(7, F.col("o_custkey"), F.lit(-1)).alias("metadata"), touched(14, collections, F.lit("moved")).alias("collections")
    )
    return old, new


_VERSIONS = """old AS (SELECT o_orderkey AS k, CASE o_orderkey % 23 WHEN 0 THEN 'missing_archive' WHEN 1 THEN 'invalid_archive' ELSE 'ready' END AS status, o_totalprice AS content, o_orderstatus AS archive, o_custkey AS metadata, o_orderpriority AS collections FROM orders WHERE o_orderkey % 17 <> 0),
    new AS (SELECT o_orderkey AS k, CASE o_orderkey % 29 WHEN 0 THEN 'missing_archive' WHEN 1 THEN 'invalid_archive' ELSE 'ready' END AS status, CASE WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE o_totalprice END AS content, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS archive, CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_custkey END AS metadata, CASE WHEN o_orderkey % 14 = 0 THEN 'moved' ELSE o_orderpriority END AS collections FROM orders WHERE o_orderkey % 19 <> 0)"""
_DIFF = f"""{_VERSIONS}, diff AS (SELECT coalesce(old.k, new.k) AS k, CASE WHEN new.k IS NULL THEN 'delete' ELSE 'upsert' END AS operation,
    CASE WHEN new.k IS NULL THEN 'deleted' WHEN old.k IS NULL THEN 'new_document' WHEN old.status <> 'ready' AND new.status = 'ready' THEN 'attachment_became_available' WHEN old.status = 'ready' AND new.status = 'missing_archive' THEN 'attachment_missing'
         WHEN old.status <> new.status AND new.status = 'invalid_archive' THEN 'attachment_became_invalid' WHEN old.content <> new.content THEN 'content_changed' WHEN old.archive <> new.archive THEN 'attachment_replaced'
         WHEN old.metadata <> new.metadata AND old.collections <> new.collections THEN 'collection_changed' WHEN old.metadata <> new.metadata THEN 'metadata_changed' WHEN old.status <> new.status THEN 'attachment_became_invalid' END AS reason,
    new.status = 'ready' AS ready FROM old FULL JOIN new ON old.k = new.k)"""


@query(f"WITH {_DIFF} SELECT k, operation, reason FROM diff WHERE reason IS NOT NULL")
def j2_j3_snapshot_diff(spark, sf_dir):  # noqa: ANN001, ANN201
    return changelog.snapshot_diff(*_versions(spark, sf_dir), "k")


@query(f"WITH {_DIFF} SELECT k, coalesce(ready AND reason IN ('new_document', 'attachment_became_available', 'content_changed', 'attachment_replaced'), false) AS chunk_required FROM diff WHERE reason IS NOT NULL")
def i10_chunk_policy(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = _versions(spark, sf_dir)
    diff = changelog.snapshot_diff(old, new, "k").join(new.select("k", (F.col("status") == "ready").alias("ready")), "k", "left")
    return diff.select("k", F.coalesce(changelog.chunk_required(F.col("reason"), F.col("ready")), F.lit(False)).alias("chunk_required"))


@query(f"""WITH {_VERSIONS} SELECT new.k, CASE WHEN old.k IS NULL OR new.content <> old.content OR old.status <> 'ready' THEN 'parse' WHEN new.metadata <> old.metadata THEN 'payload' WHEN old.archive <> 'F' OR new.archive <> old.archive THEN 'chunk' WHEN old.collections = '1-URGENT' OR new.collections <> old.collections THEN 'embed' ELSE 'skip' END AS stage FROM new LEFT JOIN old USING (k)""")
def i1_stage_decision(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = _versions(spark, sf_dir)
    docs = new.select("k", "content", "metadata", F.lit("p").alias("parse_fp"), F.col("archive").alias("chunk_fp"), F.col("collections").alias("embed_fp"))
    ready = lambda c: F.when(c, "ready").otherwise("stale")
    state = old.select("k", F.col("content").alias("s_content"), F.col("metadata").alias("s_metadata"), F.lit("p").alias("s_parse_fp"), F.col("archive").alias("s_chunk_fp"), F.col("collections").alias("s_embed_fp"), F.col("status").alias("s_parse"), ready(F.col("archive") == "F").alias("s_chunk"), ready(F.col("collections") != "1-URGENT").alias("s_embed"))
    return changelog.stage(docs, state, "k")


@query(f"WITH {_VERSIONS} SELECT coalesce(old.k, new.k) AS k, CASE WHEN old.k IS NULL THEN 'introduced' WHEN new.k IS NULL THEN 'removed' WHEN old.content = new.content THEN 'unchanged' WHEN old.archive <> new.archive THEN 'signature_changed' WHEN old.collections <> new.collections THEN 'moved' ELSE 'modified' END AS status, CASE WHEN old.k IS NOT NULL AND new.k IS NOT NULL AND old.content <> new.content AND old.archive = new.archive THEN 0.8 ELSE 1.0 END::DOUBLE AS confidence FROM old FULL JOIN new ON old.k = new.k")
def j1_v7_u1_symbol_diff(spark, sf_dir):  # noqa: ANN001, ANN201
    own = lambda df: df.select("k", F.col("content").alias("ast_hash"), F.col("archive").alias("signature"), F.col("collections").alias("path"))
    old, new = _versions(spark, sf_dir)
    return changelog.pair_diff(own(old), own(new), "k")


@query(f"WITH {_VERSIONS} SELECT new.k, coalesce(old.status = 'ready' AND old.content = new.content AND old.metadata = new.metadata, false) AS skip FROM new LEFT JOIN old USING (k)")
def i3_skip_unchanged(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = _versions(spark, sf_dir)
    return changelog.skippable(new, old.withColumn("active", F.col("status") == "ready"), "k", ["content", "metadata"]).select("k", "skip")


@query(f"WITH {_VERSIONS} SELECT k FROM old WHERE status = 'ready' AND k NOT IN (SELECT k FROM new)")
def j6_u2_prune(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = _versions(spark, sf_dir)
    return changelog.pruned(old.withColumn("active", F.col("status") == "ready"), new, "k").select("k")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'error'")
def t3_t4_u5_delta_fold(spark, sf_dir):  # noqa: ANN001, ANN201
    log = table(spark, sf_dir, "events").withColumn("operation", F.when(F.col("event_type") == "error", "delete").otherwise("upsert"))
    return changelog.folded(log, "user_id", "event_id", "operation").select("user_id", "event_id", "event_type")


def _syncs(spark, sf_dir):  # noqa: ANN001, ANN202
    e = table(spark, sf_dir, "events").where("event_id % 97 <> 5")
    return e.select((F.col("event_id") + 1).alias("sequence"), F.col("event_id").cast("string").alias("sync_id"), F.when(F.col("event_id") > 0, (F.col("event_id") - 1).cast("string")).alias("previous_sync_id"), F.when(F.col("event_id") % 50 == 7, -1).otherwise(F.col("event_id")).alias("from_version"), (F.col("event_id") + 1).alias("target_version"))


@query("""WITH c AS (SELECT event_id + 1 AS sequence, event_id::VARCHAR AS sync_id, CASE WHEN event_id > 0 THEN (event_id - 1)::VARCHAR END AS previous, CASE WHEN event_id % 50 = 7 THEN -1 ELSE event_id END AS from_version, event_id + 1 AS target FROM events WHERE event_id % 97 <> 5)
          SELECT sequence, fault FROM (SELECT sequence, CASE WHEN sequence <> coalesce(lag(sequence) OVER w, 0) + 1 THEN 'sequence_gap' WHEN previous IS DISTINCT FROM lag(sync_id) OVER w THEN 'wrong_predecessor' WHEN from_version <> lag(target) OVER w THEN 'version_gap' END AS fault FROM c WINDOW w AS (ORDER BY sequence)) WHERE fault IS NOT NULL""")
def s4_w1_chain_faults(spark, sf_dir):  # noqa: ANN001, ANN201
    return changelog.chain_faults(_syncs(spark, sf_dir))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n > 3 AND o_orderstatus <> 'P'")
def w11_retention(spark, sf_dir):  # noqa: ANN001, ANN201
    return changelog.expired(table(spark, sf_dir, "orders"), "o_custkey", 3, F.col("o_orderdate"), "o_orderkey", F.col("o_orderstatus") == "P").select("o_custkey", "o_orderkey")


@query(f"WITH {_VERSIONS} SELECT (SELECT count(*) FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)) AS gone, (SELECT count(*) FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)) AS come, false AS same")
def i11_snapshot_changed(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = _versions(spark, sf_dir)
    return changelog.same_rows(old, new)


# ---- aggregations


@query("""WITH s AS (SELECT vec_id AS query_id, label FROM embeddings WHERE vec_id % 100 = 0), """ + _DENSE + """,
          f AS (SELECT d.query_id, min(rank) AS first FROM dense AS d JOIN embeddings AS e ON e.vec_id = point_id JOIN s USING (query_id) WHERE e.label = s.label AND rank <= 5 GROUP BY d.query_id)
          SELECT count(first) / count(*) AS recall_at_k, coalesce(sum(1.0::DOUBLE / first), 0) / count(*) AS mrr FROM s LEFT JOIN f USING (query_id)""")
def a8_a9_w2_ranking_metrics(spark, sf_dir):  # noqa: ANN001, ANN201
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), F.col("label").alias("found"))
    samples = e.where("point_id % 100 = 0").select(F.col("point_id").alias("query_id"), F.col("found").alias("expected"))
    return metrics.ranking_metrics(samples, _dense(spark, sf_dir, 10).join(e, "point_id"), 5)


@query("SELECT lang, count(*) AS n, avg((toxic = (contains(text, 'moron') OR contains(text, 'clown'))::INT)::INT::DOUBLE) AS accuracy FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def a10_x41_accuracy(spark, sf_dir):  # noqa: ANN001, ANN201
    both = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return metrics.classification_metrics(both.withColumn("guess", (F.col("text").contains("moron") | F.col("text").contains("clown")).cast("int")), "lang", "toxic", "guess")


@query("SELECT event_type, count(*) AS n, avg(value) AS mean, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY event_type")
def a18_a19_latency(spark, sf_dir):  # noqa: ANN001, ANN201
    return metrics.latency(table(spark, sf_dir, "events"), "event_type", "value")


@query("SELECT coalesce(p_brand, 'unknown') AS value, count(*) AS n FROM part GROUP BY 1")
def a14_a16_a22_histogram(spark, sf_dir):  # noqa: ANN001, ANN201
    return metrics.histogram(table(spark, sf_dir, "part"), F.col("p_brand"))


@query("SELECT count(n_chars) AS n, min(n_chars) AS least, avg(n_chars) AS mean, max(n_chars) AS most FROM documents")
def a14_distribution(spark, sf_dir):  # noqa: ANN001, ANN201
    return metrics.distribution(table(spark, sf_dir, "documents"), "n_chars")


@query("""WITH b AS (SELECT c_nationkey::VARCHAR AS "group", c_mktsegment AS metric, avg(c_acctbal) AS v FROM customer WHERE c_custkey % 2 = 0 GROUP BY ALL),
          c AS (SELECT c_nationkey::VARCHAR AS "group", c_mktsegment AS metric, avg(c_acctbal) AS v FROM customer WHERE c_custkey % 3 = 0 GROUP BY ALL),
          r AS (SELECT b."group", b.metric, list_filter([CASE WHEN c.v IS NULL THEN 'missing_candidate' END, CASE WHEN c.v < 3000 THEN 'below_minimum' END, CASE WHEN c.v > 7000 THEN 'above_maximum' END, CASE WHEN b.v - c.v > 500 THEN 'regression' END], lambda x: x IS NOT NULL) AS rs FROM b LEFT JOIN c USING ("group", metric))
          SELECT "group", metric, len(rs) = 0 AS passed, array_to_string(rs, ',') AS reasons FROM r""")
def a17_c8_regression_gate(spark, sf_dir):  # noqa: ANN001, ANN201
    def measured(k):  # noqa: ANN001, ANN202
        return table(spark, sf_dir, "customer").where(F.col("c_custkey") % k == 0).groupBy(F.col("c_nationkey").cast("string").alias("group"), F.col("c_mktsegment").alias("metric")).agg(F.avg("c_acctbal").alias("value"))

    limits = measured(2).select("group", "metric", F.lit(3000.0).alias("low"), F.lit(7000.0).alias("high"), F.lit(500.0).alias("max_drop"))
    return metrics.gate(limits, measured(2), measured(3))


@query("SELECT lang, count(*) AS n, avg(n_chars) AS mean_words, median(n_chars) AS median_words, avg((contains(text, '?'))::INT::DOUBLE) AS questions FROM documents GROUP BY lang")
def a4_writing_profile(spark, sf_dir):  # noqa: ANN001, ANN201
    return metrics.profile(table(spark, sf_dir, "documents"), "lang", "n_chars", {"questions": F.col("text").contains("?")})


@query("""WITH t AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS term FROM documents), c AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL)
          SELECT lang, term, n, (row_number() OVER (PARTITION BY lang ORDER BY n DESC, term))::INT AS rank FROM c QUALIFY rank <= 20""")
def a4_f7_top_terms(spark, sf_dir):  # noqa: ANN001, ANN201
    return metrics.top_terms(table(spark, sf_dir, "documents"), "lang", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), 0), 20)


@query("""SELECT CASE WHEN event_type NOT IN ('view', 'click', 'purchase') THEN 'malformed' WHEN c_custkey IS NULL THEN 'orphan' ELSE 'valid' END AS status, count(*) AS n FROM events LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0) ON user_id = c_custkey GROUP BY 1""")
def a7_x25_event_audit(spark, sf_dir):  # noqa: ANN001, ANN201
    known = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select("c_custkey")
    return metrics.event_audit(table(spark, sf_dir, "events"), known, "user_id", "event_type", ["view", "click", "purchase"])


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_o_orderstatus, count(DISTINCT o_orderpriority) AS n_o_orderpriority, count(DISTINCT o_orderstatus) <= 1 AND count(DISTINCT o_orderpriority) <= 1 AS comparable FROM orders GROUP BY o_custkey")
def a24_comparability(spark, sf_dir):  # noqa: ANN001, ANN201
    return metrics.comparable(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


# ---- spans and references


@query("""WITH r AS (SELECT DISTINCT l_orderkey AS k, l_partkey || ':' || l_quantity::BIGINT AS range_id, (l_partkey % 100)::BIGINT AS b, (l_partkey % 100)::BIGINT + l_quantity::BIGINT AS e FROM lineitem),
          s AS (SELECT o_orderkey AS k, (i * 30)::BIGINT AS sb, (i * 30 + 25)::BIGINT AS se FROM orders, range(0, 5) AS t(i) WHERE o_orderkey % 4 = 0)
          SELECT r.k, range_id, e - b AS length, coalesce(sum(least(e, se) - greatest(b, sb)) FILTER (se IS NOT NULL), 0)::BIGINT AS covered, coalesce(sum(least(e, se) - greatest(b, sb)) FILTER (se IS NOT NULL), 0) = e - b AS complete
          FROM r LEFT JOIN s ON r.k = s.k AND b < se AND sb < e GROUP BY r.k, range_id, b, e""")
def j7_p10_span_cover(spark, sf_dir):  # noqa: ANN001, ANN201
    begin = (F.col("l_partkey") % 100).cast("bigint")
    ranges = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.concat_ws(":", F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string")).alias("range_id"), begin.alias("begin"), (begin + F.col("l_quantity")).cast("bigint").alias("end")).distinct()
    segments = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("segment_id"))
    segments = segments.select("k", "segment_id", (F.col("segment_id") * 30).cast("bigint").alias("s_begin"), (F.col("segment_id") * 30 + 25).cast("bigint").alias("s_end"), F.lit(0).cast("bigint").alias("source_begin"))
    return provenance.covered(ranges, segments, "k")


@query("SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey HAVING bool_and(l_suppkey % 5 <> 0)")
def j10_eligible_records(spark, sf_dir):  # noqa: ANN001, ANN201
    refs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_suppkey").alias("refs"))
    records = table(spark, sf_dir, "orders").select("o_orderkey").join(refs, "o_orderkey", "left")
    return provenance.eligible(records, "o_orderkey", "refs", table(spark, sf_dir, "lineitem").select("l_suppkey").distinct().where("l_suppkey % 5 <> 0"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")
def j16_orphans(spark, sf_dir):  # noqa: ANN001, ANN201
    return provenance.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_nationkey < 20"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT conv_id, avg(length(text)) AS mean, max(turn) AS last, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id")
def j11_latest_event(spark, sf_dir):  # noqa: ANN001, ANN201
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(F.avg(F.length("text")).alias("mean"), F.max("turn").alias("last"), F.max_by("role", "turn").alias("last_role"))


# ---- hierarchy, vectors, contamination


@query("""WITH RECURSIVE n AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END AS name, CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 50 = 49 THEN -1 ELSE p_partkey - 1 END AS parent FROM part),
          l AS (SELECT k::VARCHAR AS key, CASE WHEN name = '' THEN '[unnamed:' || k || ']' ELSE name END AS label, parent::VARCHAR AS parent FROM n),
          t(key, path, fault) AS (SELECT key, CASE WHEN parent IS NULL THEN label ELSE '[missing:' || parent || ']/' || label END, CASE WHEN parent IS NOT NULL THEN 'missing_parent' END FROM l WHERE parent IS NULL OR parent NOT IN (SELECT key FROM l)
            UNION ALL SELECT l.key, t.path || '/' || l.label, NULL FROM l JOIN t ON l.parent = t.key)
          SELECT key, path, fault FROM t""")
def g1_collection_paths(spark, sf_dir):  # noqa: ANN001, ANN201
    key = F.col("p_partkey")
    parent = F.when(key % 50 == 0, F.lit(None)).when(key % 50 == 49, F.lit(-1)).otherwise(key - 1)
    nodes = table(spark, sf_dir, "part").select(key.cast("string").alias("key"), F.when(key % 11 == 0, "").otherwise(F.col("p_name")).alias("name"), parent.cast("string").alias("parent_key"))
    return graph.collection_paths(nodes)


@query("SELECT vec_id, round(list_sum(list_transform(embedding[1:16], lambda x: x::DOUBLE)) / sqrt(list_sum(list_transform(embedding[1:16], lambda x: x::DOUBLE * x::DOUBLE))), 6) AS total FROM embeddings")
def v1_truncate(spark, sf_dir):  # noqa: ANN001, ANN201
    cut = vector.truncated(F.col("embedding"), 16)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.aggregate(cut, F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query(f"""WITH b AS (SELECT item_id, regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g') AS own, {_words("text")} AS w FROM benchmark), d AS (SELECT doc_id, lower(coalesce(text, '')) AS body, {_words("coalesce(text, '')")} AS w FROM documents),
          bs AS (SELECT item_id, count(*) OVER (PARTITION BY item_id) AS n, s FROM (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM b)),
          ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM d),
          o AS (SELECT item_id, doc_id, count(*) AS shared, count(*) / n AS overlap FROM bs JOIN ds USING (s) GROUP BY item_id, doc_id, n),
          e AS (SELECT item_id, doc_id FROM b JOIN d ON own <> '' AND contains(body, own)),
          p AS (SELECT item_id, doc_id, coalesce(shared, 0) AS shared, coalesce(overlap, 0) AS overlap, e.doc_id IS NOT NULL AS exact FROM o FULL JOIN e USING (item_id, doc_id)),
          g AS (SELECT item_id, i, array_to_string(w[i : i + m - 1], ' ') AS s, m FROM b, range(1, 13) AS x(m), LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)),
          h AS (SELECT doc_id, array_to_string(w[i : i + m - 1], ' ') AS s, m FROM (SELECT DISTINCT d.* FROM d JOIN p USING (doc_id)) AS d, range(1, 13) AS x(m), LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)),
          r AS (SELECT item_id, doc_id, max(g.m) AS run FROM p JOIN g USING (item_id) JOIN h USING (doc_id, s, m) GROUP BY item_id, doc_id)
          SELECT item_id, doc_id, shared, round(overlap, 6) AS overlap, exact, least(coalesce(run, 0), 12) AS run,
                 CASE WHEN exact OR run >= 12 OR overlap >= 0.5 THEN 'high' WHEN run >= 8 OR overlap >= 0.2 THEN 'match' ELSE 'low' END AS risk
          FROM p LEFT JOIN r USING (item_id, doc_id)""")
def j13_v3_v6_contamination(spark, sf_dir):  # noqa: ANN001, ANN201
    found = provenance.similarity(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), _tokens)
    return found.select("item_id", "doc_id", "shared", F.round("overlap", 6).alias("overlap"), "exact", F.least("run", F.lit(12)).cast("bigint").alias("run"), "risk")


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW) <= 2 AS allowed FROM events")
def w15_rate_limit(spark, sf_dir):  # noqa: ANN001, ANN201
    from pyspark.sql import Window

    by = Window.partitionBy("user_id").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-60_000_000, 0)
    return table(spark, sf_dir, "events").select("event_id", (F.count(F.lit(1)).over(by) <= 2).alias("allowed"))


from lodestone import catalog_code, catalog_library, catalog_materials, catalog_provenance, catalog_records, catalog_state, catalog_texts  # noqa: E402, F401 - they register their queries
