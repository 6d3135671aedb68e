"""Queries of record checks, request batches and run plans, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions import features, text
from lodestone.operators import planner, runs, stored_records
from lodestone.plans import requests
from lodestone.registry import query, scratch, table


@query("""
    SELECT doc_id, 'phrase' AS kind, array_to_string(list_filter([
        CASE WHEN lang IS NULL THEN 'missing language' END, CASE WHEN doc_id % 11 = 0 THEN 'missing position' END, CASE WHEN text IS NULL THEN 'missing text' END, CASE WHEN doc_id % 7 = 0 THEN 'unknown note' END,
        CASE WHEN doc_id % 13 = 0 THEN 'evidence_ids' END, CASE WHEN lang <> 'en' THEN 'language' END, CASE WHEN doc_id % 130 > 100 THEN 'quality_score' END,
        CASE WHEN NOT regexp_matches(text, '[^\\s]') OR length(text) > 500 THEN 'text' END, CASE WHEN doc_id % 17 = 0 THEN 'claim_strength' END], lambda x: x IS NOT NULL), ';') AS faults FROM documents""")
def x23_stored_records(spark, sf_dir):  # noqa: ANN001, ANN201
    d, lit = F.col("doc_id"), F.lit
    ids = F.when(d % 13 == 0, F.array(lit("evidence:1"), lit("evidence:1"))).otherwise(F.array(lit("evidence:1"), F.concat(lit("evidence:x"), d.cast("string"))))
    fields = {"phrase_id": F.concat(lit("phrase:"), d.cast("string")), "asset_type": lit("phrase"), "evidence_ids": ids, "category": F.get(F.array(*map(F.lit, features.TAXONOMY)), (d % len(features.TAXONOMY)).cast("int")), "language": F.col("lang")}
    fields |= {"quality_score": (d % 130).cast("double") / 100, "text": F.col("text"), "function": lit("f"), "position": F.when(d % 11 != 0, lit("p")), "register": lit("r"), "claim_strength": F.when(d % 17 == 0, "loud").otherwise("strong"), "constraints": F.array(lit("c"))}
    fields |= {c: lit("v") for c in ("analyzer_provider", "analyzer_model", "prompt_version", "prompt_hash", "analyzer_request_hash", "analyzer_response_hash")}
    fields |= {"response_schema_version": lit("abstraction-v7"), "taxonomy_version": lit("writing-taxonomy-v1"), "schema_version": lit("writing-material-v1"), "note": F.when(d % 7 == 0, lit("n"))}
    json = F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())))  # without nulls
    records = table(spark, sf_dir, "documents").select("doc_id", F.lit("phrase").alias("kind"), F.concat(F.left(json, F.length(json) - 1), F.lit(',"cluster_id":null}')).alias("record"))
    return stored_records.checked(records, "doc_id", "kind", "record").withColumn("faults", F.array_join("faults", ";"))


@query("""
    WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
    p AS (SELECT doc_id, i, length(x) % 23 AS n FROM l),
    s AS (SELECT doc_id, i, o AS first, least(8, n - o) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i, o) AS r FROM p, LATERAL (SELECT unnest(range(0, n, 8)) AS o) WHERE n > 0),
    f AS (
        SELECT doc_id, r, i, first, n, 0 AS batch, 1 AS held, n AS used FROM s WHERE r = 1
        UNION ALL
        SELECT s.doc_id, s.r, s.i, s.first, s.n, f.batch + (f.held >= 3 OR f.used + s.n > 8)::INT, CASE WHEN f.held >= 3 OR f.used + s.n > 8 THEN 1 ELSE f.held + 1 END, CASE WHEN f.held >= 3 OR f.used + s.n > 8 THEN s.n ELSE f.used + s.n END
        FROM f JOIN s ON s.doc_id = f.doc_id AND s.r = f.r + 1)
    SELECT doc_id, batch::INT AS batch, i::INT AS paragraph, first::INT AS first_sentence, n::INT AS sentences FROM f""")
def w8_request_batches(spark, sf_dir):  # noqa: ANN001, ANN201
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "x"))
    paragraphs = lines.select("doc_id", (F.col("i") + 1).alias("paragraph"), (F.length("x") % 23).alias("n"))
    return requests.batched(paragraphs, "doc_id", "paragraph", "n", 3, 8).select("doc_id", "batch", "paragraph", "first_sentence", "sentences")


_PLANNED = """
    WITH o AS (
        SELECT o_orderkey AS k, o_orderkey % 7 <> 0 AS here, o_orderkey % 5 <> 0 AS known, o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 AS active,
               CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 6 = 0 THEN 'delete' ELSE 'upsert' END END AS change, o_orderkey % 9 <> 0 AS ready,
               o_orderkey % 13 = 0 AS content, o_orderkey % 17 = 0 AS parse, o_orderkey % 19 = 0 AS metadata, o_orderkey % 23 = 0 AS chunk, o_orderkey % 29 = 0 AS embed, o_orderkey % 31 = 0 AS dense
        FROM orders),
    s AS (
        SELECT *, CASE WHEN NOT known OR (content AND here) OR parse THEN 'parse' WHEN metadata AND here THEN 'payload' WHEN chunk THEN 'chunk' WHEN embed OR dense THEN 'embed' ELSE 'skip' END AS stage FROM o)"""


@query(_PLANNED + """
    SELECT 'full' AS mode, k::VARCHAR AS document_id, CASE WHEN here THEN stage ELSE 'delete' END AS action FROM s WHERE here OR active
    UNION ALL SELECT 'full_force', k::VARCHAR, 'parse' FROM s WHERE here
    UNION ALL SELECT 'parse', k::VARCHAR, CASE WHEN stage = 'embed' THEN 'skip' ELSE stage END FROM s WHERE here
    UNION ALL SELECT 'incremental', k::VARCHAR, CASE WHEN change = 'delete' OR NOT ready THEN CASE WHEN active THEN 'delete' ELSE 'skip' END ELSE stage END FROM s WHERE change IS NOT NULL AND (here OR change = 'delete')
    UNION ALL SELECT 'resume', k::VARCHAR, stage FROM s WHERE active
    UNION ALL SELECT 'embed', k::VARCHAR, 'embed' FROM s WHERE active AND NOT chunk AND (embed OR dense)
    UNION ALL (SELECT 'limit', k::VARCHAR, stage FROM s WHERE here ORDER BY k DESC LIMIT 50)""")
def i13_run_plans(spark, sf_dir):  # noqa: ANN001, ANN201
    k, orders = F.col("o_orderkey"), table(spark, sf_dir, "orders")
    ident, here = k.cast("string").alias("document_id"), k % 7 != 0
    prints = [F.lit("m").alias("metadata"), F.lit("p").alias("parse_fp"), F.lit("c").alias("chunk_fp"), F.lit("e").alias("embed_fp")]
    snapshot = orders.where(here).select(ident, F.lit("a").alias("attachment_key"), (-k).alias("line"), F.lit("x").alias("content"), *prints)
    told = lambda c, n: F.when(k % n == 0, "failed").otherwise("ready").alias(c)
    old = lambda c, n, v: F.when((k % n == 0) & here, "old").otherwise(v).alias(c)
    state = orders.where(k % 5 != 0).select(ident, F.lit("a").alias("attachment_key"), (k % 11 != 0).alias("active"), old("content", 13, "x"), old("metadata", 19, "m"), *prints[1:], told("parse", 17), told("chunk", 23), told("embed", 29), told("dense", 31), F.lit("ready").alias("sparse"))
    # an earlier change of the same document is overruled
    kinds = F.when(k % 6 == 0, "delete").otherwise("upsert")
    made = F.array(F.struct(F.lit(1).alias("sequence"), F.lit("upsert").alias("operation")), F.struct(F.lit(2).alias("sequence"), kinds.alias("operation")))
    changes = orders.where((k % 3 == 0) & (here | (k % 6 == 0))).select(ident, k.alias("place"), (k % 9 != 0).alias("ready"), F.inline(made))
    every = planner.joined(snapshot, state, changes)
    runs = {"full": planner.plan(every, "reconcile"), "full_force": planner.plan(every, "full", force=True), "parse": planner.plan(every, "parse"), "incremental": planner.plan(every, "incremental"), "resume": planner.plan(every, "resume"), "embed": planner.plan(every, "embed"), "limit": planner.plan(every, "full", limit=50, prune=True)}
    out = None
    for mode, rows in runs.items():
        rows = rows.select(F.lit(mode).alias("mode"), "document_id", "action")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(None)
def i14_resumed_run(spark, sf_dir):  # noqa: ANN001, ANN201
    """(unit, tokens, sentences) of every document, by a run that stops after three parts of eight and is resumed."""
    d = table(spark, sf_dir, "documents")
    units = d.select(F.col("doc_id").cast("string").alias("unit"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("fingerprint"), F.coalesce("text", F.lit("")).alias("text"))
    work = lambda df: df.select("unit", text.token_count(F.col("text")).alias("tokens"), F.size(text.sentences(F.col("text"))).cast("bigint").alias("sentences"))
    folder, versions = scratch(spark, "run"), {"tokens": "1", "sentences": "1"}
    runs.resumed(units, work, versions, folder, most=3)
    return runs.resumed(units, work, versions, folder)
