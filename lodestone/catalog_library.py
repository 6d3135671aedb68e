"""Queries of metadata, profiles, queues, dates, provenance and last checks, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone import catalog
from lodestone.functions import hashing, text
from lodestone.operators import library, provenance
from lodestone.registry import query, table


def _s(column: str):  # noqa: ANN202
    return F.col(column).cast("string")


_SPANS = catalog.ORACLES["j7_p10_span_cover"]


@query(f"""SELECT k % 7 AS family, coalesce(sum(covered) / nullif(sum(length), 0), 0) AS ratio FROM ({_SPANS.replace("SELECT r.k, range_id", "SELECT r.k AS k, range_id")}) GROUP BY 1""")
def a21_x21_coverage(spark, sf_dir):  # noqa: ANN001, ANN201
    spans = catalog.QUERIES["j7_p10_span_cover"](spark, sf_dir)
    return provenance.coverage(spans.withColumn("family", F.col("k") % 7), "family")


@query("SELECT o_orderkey, array_to_string(CASE WHEN o_orderkey % 5 = 0 THEN [] ELSE range(o_orderkey % 40, o_orderkey % 40 + o_orderkey % 4 + 1) END, ',') AS pages FROM orders")
def f29_page_numbers(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("o_orderkey")
    first = F.when(k % 5 != 0, k % 40)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.transform(text.page_numbers(first, k % 40 + k % 4), lambda p: p.cast("string")), ",").alias("pages"))


_CJK = ["图 神经网络 图", "图神经", ""]


@query(f"""SELECT doc_id, sha256(text || {_CJK}[doc_id % 3 + 1] || [chr(10) || 'mark 图 神经 经网 网络', chr(10) || 'mark 图神 神经', ''][doc_id % 3 + 1]) AS sparse_sha256 FROM documents""")
def f1_sparse_text(spark, sf_dir):  # noqa: ANN001, ANN201
    value = F.concat("text", F.element_at(F.array(*map(F.lit, _CJK)), (F.col("doc_id") % 3 + 1).cast("int")))
    return table(spark, sf_dir, "documents").select("doc_id", hashing.sha256(text.sparse_text(value, "mark")).alias("sparse_sha256"))


_HEADS = [("3.2) Our Approach!", "our approach"), ("IV. Results & Analysis", "results analysis"), ("Appendix A.1: Proofs", "proofs"), ("  Overview  ", "overview"), ("实验 设置", "实验 设置"), ("7", "7")]


@query(f"SELECT doc_id, {[h for _, h in _HEADS]}[doc_id % 6 + 1] AS heading FROM documents")
def f8_section_headings(spark, sf_dir):  # noqa: ANN001, ANN201
    value = F.element_at(F.array(*(F.lit(h) for h, _ in _HEADS)), (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", text.section_heading(value).alias("heading"))


@query("""SELECT doc_id, '{"lang":' || coalesce(to_json(lang)::VARCHAR, 'null') || ',"n":' || n_chars || ',"tags":' || to_json([source, 'é "x"'])::VARCHAR || '}' AS json FROM documents""")
def h1_canonical_json(spark, sf_dir):  # noqa: ANN001, ANN201
    return table(spark, sf_dir, "documents").select("doc_id", hashing.canonical_json(tags=F.array("source", F.lit('é "x"')), n=F.col("n_chars"), lang=F.col("lang")).alias("json"))


@query("""SELECT o_orderkey AS k, 'Order ' || o_orderkey AS title, CASE o_orderkey % 4 WHEN 0 THEN 'May 2019 (v2)' WHEN 1 THEN '20190' WHEN 2 THEN '12/2020-2021' END AS date, CASE WHEN o_orderkey % 7 = 0 THEN '1999' WHEN o_orderkey % 4 = 0 THEN '2019' WHEN o_orderkey % 4 = 2 THEN '2020' END AS year,
          CASE WHEN o_orderkey % 3 <> 0 THEN '10.1/ab' || o_orderkey END AS doi, array_to_string(list_sort(list_distinct([o_orderpriority, 'a b', o_orderstatus])), '|') AS tags FROM orders""")
def h4_normal_metadata(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("o_orderkey")
    date = F.when(k % 4 == 0, "May  2019\n(v2)").when(k % 4 == 1, "20190").when(k % 4 == 2, " 12/2020-2021").otherwise("  ")
    tags = F.array(F.concat(F.lit(" "), "o_orderpriority"), F.lit("a  b"), F.lit("a b "), F.col("o_orderstatus"), F.lit(" "), F.lit(None))
    fields = library.normal_metadata(F.concat(F.lit(" Order \t"), k), date, F.when(k % 7 == 0, " 1999"), F.when(k % 3 != 0, F.concat(F.lit("10.1 /AB"), k)).otherwise(" "), tags)
    return table(spark, sf_dir, "orders").select(k.alias("k"), *fields).withColumn("tags", F.array_join("tags", "|"))


@query(f"""WITH e AS (SELECT doc_id, source AS paper, text, ['introduction', 'method', 'experiment'][doc_id % 3 + 1] AS family FROM documents),
          k AS (SELECT paper, len(regexp_extract_all(text, {"'" + text.LEXICAL.replace("'", "''") + "'"})) AS n, contains(text, '?') AS q FROM e WHERE paper IN ('src1', 'src2', 'src5') AND family IN ('introduction', 'experiment'))
          SELECT paper, count(*) AS n, avg(n) AS mean_words, median(n) AS median_words, count(DISTINCT paper) AS papers, avg(q::INT::DOUBLE) AS questions FROM k WHERE n >= 20 GROUP BY paper UNION ALL SELECT 'absent', 0, NULL, NULL, 0, NULL""")
def a5_a4_profiles(spark, sf_dir):  # noqa: ANN001, ANN201
    section = F.element_at(F.array(F.lit("1 Introduction"), F.lit("2 Methods"), F.lit("3. Results")), (F.col("doc_id") % 3 + 1).cast("int"))
    entries = table(spark, sf_dir, "documents").select(F.col("source").alias("paper"), "text", section.alias("section"))
    papers = spark.createDataFrame([("src1",), ("src2",), ("src5",), ("absent",)], "paper string")
    own, missing = library.profile_entries(entries, papers, ["Introduction", "Experiments"])
    return library.writing_profile(own, "paper").unionByName(missing.withColumns({"n": F.lit(0), "papers": F.lit(0)}), allowMissingColumns=True)


@query("""WITH q AS (SELECT o_orderkey AS task, ['pending', 'running', 'completed', 'failed'][o_orderkey % 4 + 1] AS status, CASE WHEN o_orderkey % 12 <> 1 THEN o_orderdate END AS started FROM orders WHERE o_orderkey % 5 <> 0),
          r AS (SELECT task, CASE WHEN status = 'running' AND (started IS NULL OR started < TIMESTAMP '1997-01-01' - INTERVAL 6 HOUR) THEN 'failed' ELSE status END AS status FROM q), w AS (SELECT o_orderkey AS task FROM orders WHERE o_orderkey % 3 = 0)
          SELECT coalesce(r.task, w.task) AS task, CASE WHEN w.task IS NOT NULL AND coalesce(status, '') NOT IN ('pending', 'running') THEN 'pending' ELSE status END AS status FROM r FULL JOIN w ON r.task = w.task""")
def i8_recovered_queue(spark, sf_dir):  # noqa: ANN001, ANN201
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    status = F.element_at(F.array(*map(F.lit, ["pending", "running", "completed", "failed"])), (k % 4 + 1).cast("int"))
    queue = o.where("o_orderkey % 5 <> 0").select(k.alias("task"), status.alias("status"), F.when(k % 12 != 1, F.col("o_orderdate")).alias("started"))
    return library.recovered_queue(queue, F.lit("1997-01-01").cast("timestamp_ntz"), 21_600, o.where("o_orderkey % 3 = 0").select(k.alias("task")))


_AFTER = [("120", 120.0), (" 1.5 ", 1.5), ("Wed, 21 Oct 2015 07:28:00 GMT", 60.0), ("Tue, 20 Oct 2015 07:28:00 GMT", 0.0), ("soon", None), ("-3", None)]


@query(f"SELECT doc_id, [{', '.join('NULL' if s is None else str(s) for _, s in _AFTER)}][doc_id % 6 + 1]::DOUBLE AS seconds, CASE doc_id % 3 WHEN 0 THEN '2021-01-02' WHEN 1 THEN '2020-05-05' END AS updated FROM documents")
def v11_dates_x18_updated(spark, sf_dir):  # noqa: ANN001, ANN201
    value = F.element_at(F.array(*(F.lit(v) for v, _ in _AFTER)), (F.col("doc_id") % 6 + 1).cast("int"))
    now = F.to_timestamp(F.lit("2015-10-21 07:27:00"))
    updated = library.stable_updated_at(F.when(F.col("doc_id") % 3 == 0, "2021-01-02"), F.when(F.col("doc_id") % 3 < 2, "2020-05-05"), F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", library.seconds_until(value, now).alias("seconds"), updated.alias("updated"))


@query("""WITH a AS (SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'doc:' ELSE 'zotero:' END || o_orderkey AS id, o_orderkey AS k FROM orders) SELECT id, CASE WHEN k % 9 = 0 THEN 'invalid_document_id' ELSE 'unknown_document' END AS code FROM a WHERE k % 9 = 0 OR k % 4 = 0""")
def p11_unknown_ids(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("o_orderkey")
    asked = table(spark, sf_dir, "orders").select(F.concat(F.when(k % 9 == 0, "doc:").otherwise("zotero:"), k).alias("id"))
    known = table(spark, sf_dir, "orders").where("o_orderkey % 4 <> 0").select(F.concat(F.lit("zotero:"), k).alias("id"))
    return library.unknown_ids(asked, known, "id")


@query("""WITH e AS (SELECT l_orderkey AS id, l_linenumber AS n FROM lineitem), d AS (SELECT DISTINCT id, n FROM e)
          SELECT o_orderkey AS asset_id, 'unknown_accepted_asset' AS error FROM orders WHERE o_orderkey % 13 = 0 UNION ALL SELECT id, 'accepted_evidence_missing' FROM d JOIN orders ON o_orderkey = id WHERE id % 13 <> 0 AND (id * 10 + n) % 17 = 0
          UNION ALL SELECT o_orderkey, 'category_mismatch' FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 11 = 0 UNION ALL SELECT o_orderkey, 'score_mismatch' FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 7 = 0""")
def j18_source_joins(spark, sf_dir):  # noqa: ANN001, ANN201
    k, mark = F.col("o_orderkey"), F.col("l_orderkey") * 10 + F.col("l_linenumber")
    ids = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("asset_id")).agg(F.collect_set(mark).alias("evidence_ids"))
    orders = table(spark, sf_dir, "orders")
    assets = orders.where("o_orderkey % 13 <> 0").select(k.alias("asset_id"), F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("score")).join(ids, "asset_id", "left")
    payloads = orders.select(k.alias("asset_id"), F.when(k % 11 == 0, "x").otherwise(F.col("o_orderpriority")).alias("category"), F.when(k % 7 == 0, -1.0).otherwise(F.col("o_totalprice")).alias("score"))
    evidence = table(spark, sf_dir, "lineitem").select(mark.alias("evidence_id")).distinct().where("evidence_id % 17 <> 0")
    return library.source_join_findings(payloads, assets, evidence)


@query("""SELECT l_orderkey AS d, l_linenumber % 2 AS chunk, min(p) AS first_page, max(p) AS last_page, arg_min('H' || l_partkey % 5 || ' > ' || l_linenumber % 3, place) AS section, count(DISTINCT l_partkey % 9) AS n_refs
          FROM (SELECT *, CASE WHEN l_partkey % 4 <> 0 THEN l_suppkey % 30 END AS p, l_linenumber * 1000000 + l_partkey AS place FROM lineitem) AS y GROUP BY l_orderkey, l_linenumber % 2""")
def x3_chunk_provenance(spark, sf_dir):  # noqa: ANN001, ANN201
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("d"), (F.col("l_linenumber") % 2).alias("chunk"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("place"), F.when(F.col("l_partkey") % 4 != 0, F.col("l_suppkey") % 30).alias("page"),
        F.array(F.concat(F.lit("H"), F.col("l_partkey") % 5), (F.col("l_linenumber") % 3).cast("string")).alias("headings"), (F.col("l_partkey") % 9).cast("string").alias("ref"),
    )
    return library.chunk_provenance(items, "d").select("d", "chunk", "first_page", "last_page", "section", F.size("refs").cast("bigint").alias("n_refs"))


@query("""SELECT c_custkey AS asset_id, CASE WHEN c_custkey % 3 <> 0 THEN 'stale_acknowledgement' WHEN c_custkey % 4 = 0 THEN 'acknowledged' WHEN c_custkey % 5 = 0 THEN 'reviewed' ELSE 'unreviewed' END AS state FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0""")
def x28_audit_sets(spark, sf_dir):  # noqa: ANN001, ANN201
    own = lambda n: table(spark, sf_dir, "customer").where(F.col("c_custkey") % n == 0).select(F.col("c_custkey").alias("asset_id"))
    return library.audit_sets(own(3), own(4), own(5))


_GATES = [name for names, _ in library.RECOMMENDATIONS for name in names]


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 1 THEN 'stop_and_fix_extraction_contract' WHEN c_custkey % 7 = 0 THEN 'complete_all_review_decisions' WHEN c_custkey % 5 = 0 THEN 'build_or_fix_isolated_candidate'
          WHEN c_custkey % 3 = 0 THEN 'run_or_fix_candidate_retrieval_evaluation' ELSE 'eligible_for_manual_expansion_decision' END AS recommendation FROM customer""")
def x29_recommendation(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("c_custkey")
    values = {"extraction": k % 11 != 0, "exact_span": F.when(k % 13 != 1, True), "complete_review": k % 7 != 0, "isolated_candidate": F.when(k % 5 != 0, True), "retrieval_quality": k % 3 != 0}
    gates = table(spark, sf_dir, "customer").select(k.alias("k"), *(values.get(g, F.lit(True)).alias(g) for g in _GATES))
    return library.recommendation(gates, "k")


@query("""WITH c AS (SELECT o_orderkey - (o_orderkey % 50 = 0)::INT AS id, o_orderkey AS k FROM orders), e AS (SELECT s_suppkey - (s_suppkey % 30 = 0)::INT AS id FROM supplier), v AS (SELECT o_orderkey AS id, o_orderkey + (o_orderkey % 41 = 0)::INT * 10000000 AS change, o_orderkey % 3 = 0 AS passed, o_orderkey % 3 <> 0 OR o_orderkey % 9 = 0 AS bad_exit FROM orders)
          SELECT 'duplicate_change' AS code, id::VARCHAR AS key FROM c GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'duplicate_evidence', id::VARCHAR FROM e GROUP BY id HAVING count(*) > 1
          UNION ALL SELECT 'unknown_evidence', id::VARCHAR FROM c, (SELECT unnest([0, 7]) AS step) WHERE k % 130 + step NOT IN (SELECT id FROM e) UNION ALL SELECT 'unknown_change', id::VARCHAR FROM v WHERE change NOT IN (SELECT id FROM c)
          UNION ALL SELECT 'status_belies_exit_code', id::VARCHAR FROM v WHERE passed = bad_exit""")
def x36_adaptation(spark, sf_dir):  # noqa: ANN001, ANN201
    o, k, s = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("s_suppkey")
    changes = o.select((k - (k % 50 == 0).cast("int")).alias("change_id"), F.array(k % 130, k % 130 + 7).alias("evidence_ids"))
    evidence = table(spark, sf_dir, "supplier").select((s - (s % 30 == 0).cast("int")).alias("evidence_id"))
    checks = o.select(k.alias("verification_id"), (k + (k % 41 == 0).cast("int") * 10000000).alias("change_id"), F.when(k % 3 == 0, "passed").otherwise("failed").alias("status"), ((k % 3 != 0) | (k % 9 == 0)).cast("int").alias("exit_code"))
    return library.adaptation_findings(changes, evidence, checks)


@query(r"""SELECT conv_id, min(turn) AS turn FROM conversations GROUP BY conv_id, trim(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_]+', ' ', 'g'))""")
def f31_distinct_segments(spark, sf_dir):  # noqa: ANN001, ANN201
    return library.distinct_segments(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text").select("conv_id", "turn")


_LOOKUPS = {"doi": "10.1/C7", "item_key": "I12", "attachment_key": "A30", "title": "customer#00000001", "citation_key": "KEY21"}


@query(r"""WITH d AS (SELECT c_custkey::VARCHAR AS document_id, c_name AS title, '10.1/c' || c_custkey % 40 AS doi, 'I' || c_custkey % 25 AS item, 'A' || c_custkey AS attachment, CASE WHEN c_custkey % 2 = 0 THEN 'Key' || c_custkey % 30 END AS citation FROM customer),
          f AS (SELECT 'doi' AS "by", * FROM d WHERE lower(doi) = '10.1/c7' UNION ALL SELECT 'item_key', * FROM d WHERE item = 'I12' UNION ALL SELECT 'attachment_key', * FROM d WHERE attachment = 'A30' UNION ALL SELECT 'title', * FROM d WHERE contains(lower(title), 'customer#00000001')
            UNION ALL SELECT 'citation_key', * FROM d WHERE item IN (SELECT item FROM d WHERE lower(citation) = 'key21'))
          SELECT "by", document_id FROM f QUALIFY row_number() OVER (PARTITION BY "by" ORDER BY title, document_id) <= 50""")
def j14_references(spark, sf_dir):  # noqa: ANN001, ANN201
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    docs = c.select(k.cast("string").alias("document_id"), F.col("c_name").alias("title"), F.concat(F.lit("10.1/c"), k % 40).alias("doi"), F.concat(F.lit("I"), k % 25).alias("item_key"), F.concat(F.lit("A"), k).alias("attachment_key"))
    citations = c.where("c_custkey % 2 = 0").select(F.concat(F.lit("I"), k % 25).alias("item_key"), F.concat(F.lit('{"data":{"citationKey":"Key'), k % 30, F.lit('"}}')).alias("payload"))
    found = [library.resolve_reference(docs, citations, **{name: value}).select(F.lit(name).alias("by"), "document_id") for name, value in _LOOKUPS.items()]
    return found[0].unionAll(found[1]).unionAll(found[2]).unionAll(found[3]).unionAll(found[4])


@query("""SELECT lang, sha256(string_agg(sha256(c.text), ',' ORDER BY conv_id, turn)) AS fingerprint, count(*) AS n FROM conversations AS c JOIN documents AS d ON doc_id = conv_id WHERE turn % 2 = 0 AND doc_id % 3 <> 0 GROUP BY lang""")
def h9_ready_corpus(spark, sf_dir):  # noqa: ANN001, ANN201
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), "lang", F.when(F.col("doc_id") % 3 != 0, "ready").otherwise("stale").alias("status"))
    chunks = table(spark, sf_dir, "conversations").select("conv_id", "turn", hashing.sha256(F.col("text")).alias("h"), (F.col("turn") % 2 == 0).alias("active"))
    rows = library.ready_chunks(chunks, docs, "conv_id").join(docs.select("conv_id", "lang"), "conv_id")
    return hashing.corpus_fingerprint(rows.withColumn("place", F.struct("conv_id", "turn")), "lang", "place", "h")


@query("SELECT o_custkey % 5 AS step, o_custkey % 5 <> 0 AS changed FROM orders GROUP BY 1, 2")
def i11_ordered_snapshot(spark, sf_dir):  # noqa: ANN001, ANN201
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("place"), _s("o_custkey").alias("record"))
    variants = [o, o.where("place > 1"), o.withColumn("record", F.when(F.col("place") == 7, "x").otherwise(F.col("record"))), o.withColumn("place", F.col("place") + 1), o.unionAll(spark.createDataFrame([(-1, "new")], "place bigint, record string"))]
    found = [library.same_records(o, v, "place", "record").select(F.lit(i).cast("bigint").alias("step"), "changed") for i, v in enumerate(variants)]
    return found[0].unionAll(found[1]).unionAll(found[2]).unionAll(found[3]).unionAll(found[4])
