"""Queries of incremental state, code, logs and metrics, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone import catalog
from lodestone.functions import code, features, hashing, text
from lodestone.operators import hub, metrics, records, retrieval, state
from lodestone.registry import query, table


def _s(column: str):  # noqa: ANN202
    return F.col(column).cast("string")


# ---- state


@query(f"WITH {catalog._VERSIONS} SELECT coalesce(new.k, old.k) AS k, CASE WHEN new.k IS NULL THEN old.content ELSE new.content END AS content, CASE WHEN new.k IS NULL THEN old.status ELSE new.status END AS status, old.collections AS stage FROM old FULL JOIN new ON old.k = new.k")
def i5_source_upsert(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = catalog._versions(spark, sf_dir)
    return state.upserted(old.select("k", "content", "status", F.col("collections").alias("stage")), new, "k", ["content", "status"])


_TOMBS = f"""{catalog._VERSIONS}, gone AS (SELECT k, 'pruned' AS reason FROM old WHERE k % 29 = 3), tombs AS (SELECT k, 'earlier' AS reason FROM old WHERE k % 6 = 0),
    i AS (SELECT coalesce(old.k, n.k) AS k, CASE WHEN gone.k IS NOT NULL THEN false WHEN n.k IS NOT NULL THEN true ELSE old.status = 'ready' END AS active FROM old FULL JOIN (SELECT k FROM new WHERE k % 4 = 0) AS n ON old.k = n.k LEFT JOIN gone ON gone.k = coalesce(old.k, n.k))"""


@query(f"WITH {_TOMBS} SELECT 'index' AS part, k, active::VARCHAR AS value FROM i UNION ALL SELECT 'tombstone', k, reason FROM tombs WHERE k NOT IN (SELECT k FROM new WHERE k % 4 = 0) AND k NOT IN (SELECT k FROM gone) UNION ALL SELECT 'tombstone', k, reason FROM gone")
def i4_tombstones(spark, sf_dir):  # noqa: ANN001, ANN201
    old, new = catalog._versions(spark, sf_dir)
    index, tombs = state.tombstoned(old.select("k", (F.col("status") == "ready").alias("active")), old.where("k % 6 = 0").select("k", F.lit("earlier").alias("reason")), new.where("k % 4 = 0"), old.where("k % 29 = 3").select("k", F.lit("pruned").alias("reason")), "k")
    return index.select(F.lit("index").alias("part"), "k", _s("active").alias("value")).unionByName(tombs.select(F.lit("tombstone").alias("part"), "k", F.col("reason").alias("value")))


@query("""WITH c AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 5 = 0 THEN 1 ELSE 9 END AS f FROM orders)
          SELECT k, CASE WHEN f <= 0 THEN 'stale' ELSE 'ready' END AS parse, CASE WHEN f <= 1 THEN 'stale' ELSE 'ready' END AS chunk, CASE WHEN f <= 2 THEN 'stale' ELSE 'ready' END AS embedding, CASE WHEN f <= 3 THEN 'stale' ELSE 'ready' END AS index, k % 11 <> 0 AS active FROM c""")
def i6_invalidation(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), *(F.lit("ready").alias(c) for c in state.STAGES), F.lit(True).alias("active"))
    levels = [(k % 7 == 0, "content"), (k % 5 == 0, "chunks"), (k % 11 == 0, "unavailable")]
    changes = [table(spark, sf_dir, "orders").where(c).select(k.alias("k"), F.lit(level).alias("level")) for c, level in levels]
    return state.invalidated(rows, changes[0].unionAll(changes[1]).unionAll(changes[2]), "k")


@query("""WITH o AS (SELECT conv_id, turn, text, turn % 5 <> 4 AS active FROM conversations WHERE turn % 4 <> 3), n AS (SELECT conv_id, turn, text || '!' AS text FROM conversations WHERE conv_id % 3 = 0 AND turn % 3 <> 1)
          SELECT coalesce(o.conv_id, n.conv_id) AS conv_id, coalesce(o.turn, n.turn) AS turn, md5(CASE WHEN n.turn IS NOT NULL THEN n.text ELSE o.text END) AS text_md5,
            CASE WHEN n.turn IS NOT NULL THEN true WHEN coalesce(o.conv_id, n.conv_id) IN (SELECT conv_id FROM n) THEN false ELSE o.active END AS active FROM o FULL JOIN n ON o.conv_id = n.conv_id AND o.turn = n.turn""")
def i7_replaced_chunks(spark, sf_dir):  # noqa: ANN001, ANN201
    c = table(spark, sf_dir, "conversations")
    old = c.where("turn % 4 <> 3").select("conv_id", "turn", "text", (F.col("turn") % 5 != 4).alias("active"))
    new = c.where("conv_id % 3 = 0 AND turn % 3 <> 1").select("conv_id", "turn", F.concat("text", F.lit("!")).alias("text"))
    return state.replaced_chunks(old, new, "conv_id", "turn").select("conv_id", "turn", F.md5(F.col("text").cast("binary")).alias("text_md5"), "active")


@query("""SELECT user_id, sequence, operation FROM (SELECT user_id, max(event_id) AS sequence, arg_max(event_type, event_id) AS operation FROM events GROUP BY user_id) WHERE sequence % 3 <> 0""")
def i9_pending_operations(spark, sf_dir):  # noqa: ANN001, ANN201
    log = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("sequence"), F.col("event_type").alias("operation"))
    return state.pending_operations(log, "user_id", log.where("sequence % 3 = 0"))


_MIRROR = """loc AS (SELECT c_custkey AS k, c_custkey % 10 AS version, c_custkey % 9 = 0 AS deleted FROM customer WHERE c_custkey % 8 <> 0),
    rem AS (SELECT c_custkey AS k, c_custkey % 10 + (c_custkey % 6 = 0)::INT AS version FROM customer WHERE c_custkey % 5 <> 0)"""


@query(f"""WITH {_MIRROR}, a AS (SELECT coalesce(loc.k, rem.k) AS k, coalesce(rem.version, loc.version) AS version, CASE WHEN rem.k IS NOT NULL THEN false WHEN loc.k % 10 = 0 THEN true ELSE loc.deleted END AS deleted, coalesce(loc.deleted, true) AS before FROM loc FULL JOIN rem ON loc.k = rem.k)
          SELECT 'mirror' AS part, k, version, deleted FROM a UNION ALL SELECT 'deletion', k, version, true FROM a WHERE deleted AND NOT before""")
def i12_mirror(spark, sf_dir):  # noqa: ANN001, ANN201
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    local = c.where("c_custkey % 8 <> 0").select(k.alias("k"), (k % 10).alias("version"), (k % 9 == 0).alias("deleted"))
    remote = c.where("c_custkey % 5 <> 0").select(k.alias("k"), (k % 10 + (k % 6 == 0).cast("int")).alias("version"))
    after, gone = state.mirrored(local, remote, local.where("k % 10 = 0").select("k"), "k")
    return after.select(F.lit("mirror").alias("part"), "k", "version", "deleted").unionByName(gone.select(F.lit("deletion").alias("part"), "k", "version", F.lit(True).alias("deleted")))


@query(f"WITH {_MIRROR} SELECT rem.k FROM rem LEFT JOIN loc USING (k) WHERE loc.k IS NULL OR rem.version <> loc.version OR loc.deleted")
def j21_remote_changes(spark, sf_dir):  # noqa: ANN001, ANN201
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    local = c.where("c_custkey % 8 <> 0").select(k.alias("k"), (k % 10).alias("version"), (k % 9 == 0).alias("deleted"))
    return state.to_fetch(c.where("c_custkey % 5 <> 0").select(k.alias("k"), (k % 10 + (k % 6 == 0).cast("int")).alias("version")), local, "k")


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 4 <> 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0)")
def p13_embed_pending(spark, sf_dir):  # noqa: ANN001, ANN201
    k = F.col("o_orderkey")
    mark = lambda n: F.when(k % n == 0, "stale").otherwise("ready")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), (k % 3 != 0).alias("active"), mark(4).alias("chunk"), mark(5).alias("embedding"), mark(7).alias("dense"), mark(11).alias("sparse"), F.lit("f").alias("expected"), F.when(k % 13 != 0, "f").alias("fingerprint"))
    return state.embed_pending(rows, "k")


@query("SELECT user_id, max(event_id % 17) + 1 AS attempt FROM events GROUP BY user_id")
def w13_next_attempt(spark, sf_dir):  # noqa: ANN001, ANN201
    return state.attempts(table(spark, sf_dir, "events").withColumn("attempt", F.col("event_id") % 17), "user_id")


_STATES = ["planned", "running", "completed", "failed", "cancelled"]


@query(f"""WITH e AS (SELECT user_id, event_id, {_STATES}[event_id % 5 + 1] AS status FROM events), l AS (SELECT *, coalesce(lag(status) OVER (PARTITION BY user_id ORDER BY event_id), 'new') AS before FROM e)
          SELECT user_id, event_id, before, status FROM l WHERE NOT (before = 'new' AND status = 'planned' OR before = 'planned' AND status IN ('running', 'cancelled') OR before = 'running' AND status IN ('completed', 'failed', 'cancelled'))""")
def t6_transition_faults(spark, sf_dir):  # noqa: ANN001, ANN201
    status = F.element_at(F.array(*map(F.lit, _STATES)), (F.col("event_id") % 5 + 1).cast("int"))
    return state.transition_faults(table(spark, sf_dir, "events").select("user_id", "event_id", status.alias("status")), "user_id", "event_id", "status")


@query("SELECT source, count(*) AS selected, count(l.doc_id) AS known, count(*) - count(l.doc_id) AS fresh FROM documents LEFT JOIN labels AS l USING (doc_id) GROUP BY source")
def x10_ingest_plan(spark, sf_dir):  # noqa: ANN001, ANN201
    return state.ingest_plan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "source")


@query("SELECT event_id AS sequence, event_id % 7 || CASE WHEN event_id % 4 = 0 THEN 'old' ELSE 'new' END AS delta_sha256 FROM events")
def x11_consumed_all(spark, sf_dir):  # noqa: ANN001, ANN201
    own = lambda mark: table(spark, sf_dir, "events").select(F.col("event_id").alias("sequence"), F.concat(F.col("event_id") % 7, F.lit(mark)).alias("delta_sha256"))
    return state.consumed_all(own("old").where("sequence % 4 = 0"), own("new"))


@query("""SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'ready_without_path' WHEN o_orderkey % 7 = 0 THEN 'missing_archive' ELSE 'hash_mismatch' END AS code, o_orderkey::VARCHAR AS key FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0)""")
def x16_attachment_checks(spark, sf_dir):  # noqa: ANN001, ANN201
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    path = F.concat(F.lit("/dav/"), k)
    own = o.select(k.alias("key"), F.when(F.col("o_orderstatus") == "F", "ready").otherwise("missing_pdf").alias("status"), F.when(k % 5 != 0, path).alias("path"), hashing.sha256(_s("o_orderkey")).alias("digest"))
    archives = o.where("o_orderkey % 7 <> 0").select(path.alias("path"), F.when(k % 11 == 0, "0").otherwise(hashing.sha256(_s("o_orderkey"))).alias("found"))
    return state.attachment_findings(own, archives)


@query("SELECT event_id::VARCHAR AS path, user_id AS source FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 48 HOUR AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def x32_cleanup(spark, sf_dir):  # noqa: ANN001, ANN201
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max("ts")).first()[0]
    files = e.select(_s("event_id").alias("path"), F.col("user_id").alias("source"), F.col("ts").alias("modified"))
    return state.cleanup(files, F.lit(now), 48, table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("source"))).select("path", "source")


@query("SELECT 'a' || o_orderkey AS name FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 3)")
def u6_unreferenced(spark, sf_dir):  # noqa: ANN001, ANN201
    expected = table(spark, sf_dir, "lineitem").where("l_linenumber > 3").select(F.concat(F.lit("a"), "l_orderkey").alias("name"))
    return state.unreferenced(table(spark, sf_dir, "orders").select(F.concat(F.lit("a"), "o_orderkey").alias("name")), expected)


@query("""WITH w AS (SELECT s_suppkey % 4 AS library, (s_suppkey % 5) || '.' || (s_suppkey % 3) AS version FROM supplier GROUP BY ALL),
          t AS (SELECT library, CASE (a + b) % 3 WHEN 0 THEN 'v' WHEN 1 THEN 'release-' ELSE '' END || a || '.' || b || CASE WHEN a = 4 THEN '.0' ELSE '' END AS tag, a || '.' || b AS version, (a + b) % 3 AS kind, a = 4 AS long FROM range(0, 4) AS l(library), range(0, 5) AS x(a), range(0, 3) AS y(b))
          SELECT w.library, w.version, min(tag) AS tag FROM w JOIN t ON t.library = w.library AND regexp_replace(t.version, '(\\.0+)+$', '') = regexp_replace(w.version, '(\\.0+)+$', '') GROUP BY ALL""")
def x31_resolved_tags(spark, sf_dir):  # noqa: ANN001, ANN201
    s = F.col("s_suppkey")
    wanted = table(spark, sf_dir, "supplier").select((s % 4).alias("library"), F.concat_ws(".", (s % 5).cast("string"), (s % 3).cast("string")).alias("version")).distinct()
    grid = spark.range(0, 4).withColumnRenamed("id", "library").select("library", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("a")).select("library", "a", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("b"))
    head = F.when((F.col("a") + F.col("b")) % 3 == 0, "v").when((F.col("a") + F.col("b")) % 3 == 1, "release-").otherwise("")
    tags = grid.select("library", F.concat(head, "a", F.lit("."), "b", F.when(F.col("a") == 4, ".0").otherwise("")).alias("tag"))
    return state.resolved_tags(wanted, tags, ["v{version}", "release-{version}", "{version}"])


@query("""WITH r AS (SELECT o_custkey AS k, (o_orderkey % 5) || '.' || (o_orderkey % 13) AS version, CASE WHEN o_orderkey % 13 % 3 = 0 THEN 'Breaking change' WHEN o_orderkey % 13 % 3 = 1 THEN 'unbreaking' ELSE 'fixes' END AS notes FROM orders WHERE o_orderkey % 6 <> 0),
          l AS (SELECT k, max({'a': split_part(version, '.', 1)::INT, 'b': split_part(version, '.', 2)::INT, 'n': notes}) AS m FROM r GROUP BY k)
          SELECT k, m.a || '.' || m.b AS latest, (m.a || '.' || m.b) IS DISTINCT FROM CASE WHEN k % 4 <> 0 THEN '4.12' END AS changed, m.n = 'Breaking change' AS breaking FROM l""")
def x30_release_watch(spark, sf_dir):  # noqa: ANN001, ANN201
    o = F.col("o_orderkey")
    notes = F.when(o % 13 % 3 == 0, "Breaking change").when(o % 13 % 3 == 1, "unbreaking").otherwise("fixes")
    releases = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.concat(o % 5, F.lit("."), o % 13, F.when(o % 6 == 0, "rc1").otherwise("")).alias("version"), notes.alias("notes"))
    seen = table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("k"), F.lit("4.12").alias("seen"))
    return state.release_watch(releases, seen, "k")


@query("""WITH r AS (SELECT DISTINCT l_orderkey AS d, l_linenumber AS p, l_partkey AS ref FROM lineitem), c AS (SELECT DISTINCT l_orderkey AS d, l_linenumber % 2 AS chunk_id, l_partkey AS ref FROM lineitem WHERE l_partkey % 50 <> 0),
          e AS (SELECT r.d, p, r.ref, count(DISTINCT chunk_id) AS n, min(chunk_id) AS chunk_id FROM r LEFT JOIN c ON c.d = r.d AND c.ref = r.ref GROUP BY ALL), q AS (SELECT d, p, bool_and(n = 1) AND count(DISTINCT chunk_id) = 1 AS sound, min(chunk_id) AS chunk_id FROM e GROUP BY d, p)
          SELECT d, p AS paragraph_id, CASE WHEN bool_and(sound) OVER (PARTITION BY d) THEN chunk_id END AS chunk_id, bool_and(sound) OVER (PARTITION BY d) AS available FROM q""")
def j8_contained_paragraphs(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = table(spark, sf_dir, "lineitem")
    refs = rows.select(F.col("l_orderkey").alias("d"), F.col("l_linenumber").alias("paragraph_id"), F.col("l_partkey").alias("ref"))
    chunks = rows.where("l_partkey % 50 <> 0").select(F.col("l_orderkey").alias("d"), (F.col("l_linenumber") % 2).alias("chunk_id"), F.col("l_partkey").alias("ref"))
    return state.contained(refs, chunks, "d")


@query("""WITH s AS (SELECT p_name AS symbol, p_partkey % 100 AS path, p_partkey % 3 AS version FROM part), m AS (SELECT DISTINCT s_suppkey % 100 AS path, s_suppkey % 3 AS version FROM supplier), h AS (SELECT p_name AS symbol, p_partkey AS point_id, p_retailprice AS score FROM part)
          SELECT symbol, point_id, score FROM s JOIN m USING (path, version) JOIN h USING (symbol)""")
def j4_symbol_hits(spark, sf_dir):  # noqa: ANN001, ANN201
    p, s = table(spark, sf_dir, "part"), F.col("s_suppkey")
    symbols = p.select(F.col("p_name").alias("symbol"), (F.col("p_partkey") % 100).alias("path"), (F.col("p_partkey") % 3).alias("version"))
    markers = table(spark, sf_dir, "supplier").select((s % 100).alias("path"), (s % 3).alias("version")).distinct()
    return state.source_markers(symbols, markers, p.select(F.col("p_name").alias("symbol"), F.col("p_partkey").alias("point_id"), F.col("p_retailprice").alias("score"))).select("symbol", "point_id", "score")


@query("""WITH a AS (SELECT doc_id, sha256('{"config":"parser","before":"' || sha256(text) || '"}') AS parse FROM documents), b AS (SELECT *, sha256('{"config":"' || 'chunk' || doc_id % 2 || '","before":"' || parse || '"}') AS chunk FROM a)
          SELECT doc_id, parse, chunk, sha256('{"config":"embedding","before":"' || chunk || '"}') AS embedding FROM b""")
def h3_stage_chain(spark, sf_dir):  # noqa: ANN001, ANN201
    chain = state.stage_chain(hashing.sha256(F.col("text")), F.lit("parser"), F.concat(F.lit("chunk"), F.col("doc_id") % 2), F.lit("embedding"))
    return table(spark, sf_dir, "documents").select("doc_id", *(c.alias(name) for c, name in zip(chain, ("parse", "chunk", "embedding"), strict=True)))


# ---- hits and projections


@query("""SELECT doc_id, left(text, 320) AS excerpt, CASE WHEN doc_id % 3 = 0 THEN 'mode' END AS kept FROM documents""")
def p7_return_modes(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("source_excerpt"), F.col("text").alias("original"), F.when(F.col("doc_id") % 3 == 0, "mode").alias("kept"))
    return hub.pattern_first(rows).select("doc_id", F.col("source_excerpt").alias("excerpt"), "kept")


@query("""SELECT conv_id, turn, source_type FROM (SELECT conv_id, turn, ['issue', 'pull_request', 'commit', 'api_documentation', 'source_code'][turn % 5 + 1] AS source_type FROM conversations) WHERE source_type NOT IN ('issue', 'pull_request', 'commit')""")
def p5_issue_gate(spark, sf_dir):  # noqa: ANN001, ANN201
    kind = F.element_at(F.array(*map(F.lit, ["issue", "pull_request", "commit", "api_documentation", "source_code"])), (F.col("turn") % 5 + 1).cast("int"))
    return hub.without_issues(table(spark, sf_dir, "conversations").select("conv_id", "turn", kind.alias("source_type")), allowed=False)[0]


@query(f"""WITH {catalog._DENSE}, r AS (SELECT query_id, point_id, round(score, 6) * (1 + label % 3) AS new_score FROM dense JOIN embeddings ON vec_id = point_id)
          SELECT query_id, point_id, (row_number() OVER (PARTITION BY query_id ORDER BY round(new_score, 6) DESC, point_id))::INT AS new_rank FROM r QUALIFY new_rank <= 5""")
def k4_reranked(spark, sf_dir):  # noqa: ANN001, ANN201
    labels = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), "label")
    hits = catalog._dense(spark, sf_dir, 10).join(labels, "point_id").withColumn("new_score", F.round(F.round("score", 6) * (1 + F.col("label") % 3), 6))
    return hub.reranked(hits, "new_score", 5).select("query_id", "point_id", "new_rank")


@query("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY) WHERE n <= 5""")
def k10_recent_experiments(spark, sf_dir):  # noqa: ANN001, ANN201
    e = table(spark, sf_dir, "events")
    return hub.recent(e, "user_id", "ts", "event_id", F.lit(e.agg(F.max("ts")).first()[0]), 10, 5).select("user_id", "event_id")


@query("""WITH p AS (SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN 'w' || page_id END AS writing_id, lower(coalesce(url, '')) AS t FROM pages)
          SELECT page_id, coalesce(writing_id, 'p' || page_id) AS writing_id, array_to_string(list_filter(['declared', CASE WHEN contains(t, 'image') THEN 'x' END], lambda x: x = 'declared'), ',') AS declared FROM p""")
def x5_writing_hits(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("p"), "page_id").alias("point_id"), F.when(F.col("page_id") % 3 != 0, F.concat(F.lit("w"), "page_id")).alias("writing_id"), F.array(F.lit("declared")).alias("domains"), F.col("url").alias("title"), F.lit("").alias("text"))
    return hub.writing_hits(rows).select("page_id", "writing_id", F.array_join("domains", ",").alias("declared"))


@query("SELECT conv_id, turn, coalesce(d.lang, 'none') AS lang FROM conversations LEFT JOIN documents AS d ON doc_id = conv_id")
def x8_payload_refresh(spark, sf_dir):  # noqa: ANN001, ANN201
    points = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lit("none").alias("lang"))
    return hub.refreshed(points, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), "lang"), "conv_id", ["lang"])


# ---- metrics


_SAMPLES = """s AS (SELECT vec_id AS query_id, label % 3 AS grp, label AS source, CASE WHEN vec_id % 200 = 0 THEN label + 1 END AS version, CASE WHEN vec_id % 300 = 0 THEN vec_id % 7 END AS symbol, (vec_id % 900) / 1000 AS seconds FROM embeddings WHERE vec_id % 100 = 0),
    h AS (SELECT d.query_id, rank, e.label AS source, e.label + d.rank % 2 AS version, point_id % 7 AS symbol, point_id % 4 <> 0 AS traceable, point_id % 3 = 0 AS inferred FROM dense AS d JOIN embeddings AS e ON e.vec_id = point_id WHERE rank <= 5)"""


@query(f"""WITH {catalog._DENSE}, {_SAMPLES}, e AS (SELECT s.query_id, grp, s.version, s.symbol, seconds, min(rank) FILTER (h.source = s.source) AS first, arg_min(traceable, rank) FILTER (h.source = s.source) AS told, coalesce(bool_or(h.version = s.version), false) AS v, coalesce(bool_or(h.symbol = s.symbol), false) AS y,
            count(rank) AS hits, count(*) FILTER (inferred AND NOT traceable) AS bad FROM s LEFT JOIN h USING (query_id) GROUP BY ALL)
          SELECT grp, round(count(first) / count(*), 6) AS recall_at_k, coalesce(round(sum(1 / first) / count(*), 6), 0) AS mrr, round(count(*) FILTER (first = 1) / count(*), 6) AS source_type_accuracy,
            CASE WHEN count(version) > 0 THEN round(count(*) FILTER (v) / count(version), 6) ELSE 0 END AS version_recall, CASE WHEN count(symbol) > 0 THEN round(count(*) FILTER (y) / count(symbol), 6) ELSE 0 END AS symbol_recall,
            round(count(*) FILTER (told) / count(*), 6) AS evidence_completeness, CASE WHEN sum(hits) > 0 THEN round(sum(bad) / sum(hits), 6) ELSE 0 END AS unsupported_rate, round(avg(seconds), 6) AS mean_seconds, quantile_disc(seconds, 0.95) AS p95_seconds FROM e GROUP BY grp""")
def a8_code_metrics(spark, sf_dir):  # noqa: ANN001, ANN201
    e, v = table(spark, sf_dir, "embeddings"), F.col("vec_id")
    samples = e.where("vec_id % 100 = 0").select(v.alias("query_id"), (F.col("label") % 3).alias("grp"), F.col("label").alias("source"), F.when(v % 200 == 0, F.col("label") + 1).alias("version"), F.when(v % 300 == 0, v % 7).alias("symbol"), (v % 900 / 1000).alias("seconds"))
    hits = catalog._dense(spark, sf_dir, 10).join(e.select(v.alias("point_id"), "label"), "point_id")
    hits = hits.select("query_id", "rank", F.col("label").alias("source"), (F.col("label") + F.col("rank") % 2).alias("version"), (F.col("point_id") % 7).alias("symbol"), (F.col("point_id") % 4 != 0).alias("traceable"), (F.col("point_id") % 3 == 0).alias("inferred"))
    return metrics.code_metrics(samples, hits, "grp", 5)


@query("""WITH r AS (SELECT lang, doc_id AS d, 'f' || doc_id % 3 AS function, CASE WHEN doc_id % 5 <> 0 THEN 'f' || doc_id % 2 END AS ef, 's' || doc_id % 4 AS section, CASE WHEN doc_id % 7 <> 0 THEN 's' || doc_id % 4 END AS es, doc_id % 6 <> 0 AS traceable, CASE WHEN doc_id % 8 <> 0 THEN 'd' || doc_id % 3 END AS domain, CASE WHEN doc_id % 9 <> 0 THEN 'd' || doc_id % 2 END AS ed,
            CASE WHEN doc_id % 4 = 0 THEN 'high' WHEN doc_id % 4 = 1 THEN 'low' END AS risk, CASE WHEN doc_id % 3 <> 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'match' ELSE 'low' END END AS er, n_chars % 400 AS m FROM documents)
          SELECT lang, round(count(*) FILTER (function = ef) / count(ef), 6) AS function_accuracy, round(count(*) FILTER (section = es) / count(es), 6) AS section_accuracy, round(count(*) FILTER (traceable) / count(*), 6) AS traceability, round((count(m) - count(DISTINCT m)) / count(m), 6) AS duplicate_ratio,
            round(count(*) FILTER (domain <> ed) / count(domain), 6) AS wrong_domain_rate, round(count(*) FILTER ((er = 'low') = (coalesce(risk, 'low') = 'low')) / count(er), 6) AS risk_detection FROM r GROUP BY lang""")
def a10_writing_metrics(spark, sf_dir):  # noqa: ANN001, ANN201
    d = F.col("doc_id")
    name = lambda mark, n: F.concat(F.lit(mark), d % n)
    rows = table(spark, sf_dir, "documents").select(
        "lang", name("f", 3).alias("function"), F.when(d % 5 != 0, name("f", 2)).alias("expected_function"), name("s", 4).alias("section"), F.when(d % 7 != 0, name("s", 4)).alias("expected_section"), (d % 6 != 0).alias("traceable"), F.when(d % 8 != 0, name("d", 3)).alias("domain"),
        F.when(d % 9 != 0, name("d", 2)).alias("expected_domain"), F.when(d % 4 == 0, "high").when(d % 4 == 1, "low").alias("risk"), F.when(d % 3 != 0, F.when(d % 2 == 0, "match").otherwise("low")).alias("expected_risk"), (F.col("n_chars") % 400).alias("material_id"),
    )
    return metrics.writing_metrics(rows, "lang")


@query("""WITH e AS (SELECT user_id % 10 AS g, ['document', 'candidate', 'call'][event_id % 3 + 1] AS kind, event_type <> 'error' AS ok, ['exact_span', 'provider_timeout', 'provider', NULL][event_id % 4 + 1] AS code FROM events)
          SELECT g, round(count(*) FILTER (kind = 'document' AND NOT ok) / count(*) FILTER (kind = 'document'), 6) AS document_failure, round(count(*) FILTER (kind = 'candidate' AND code = 'exact_span') / count(*) FILTER (kind = 'candidate'), 6) AS span_rejection,
            round(count(*) FILTER (kind = 'call' AND code = 'provider_timeout') / count(*) FILTER (kind = 'call'), 6) AS provider_failure FROM e GROUP BY g""")
def a15_gate_rates(spark, sf_dir):  # noqa: ANN001, ANN201
    e = F.col("event_id")
    code_ = F.when(e % 4 == 0, "exact_span").when(e % 4 == 1, "provider_timeout").when(e % 4 == 2, "provider")
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("g"), F.element_at(F.array(*map(F.lit, ["document", "candidate", "call"])), (e % 3 + 1).cast("int")).alias("kind"), (F.col("event_type") != "error").alias("ok"), code_.alias("code"))
    return metrics.gate_rates(rows, "g")


@query("SELECT event_type, count(*) AS batches, sum(event_id % 9) AS texts, round(sum(value), 6) AS seconds, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY event_type")
def a18_endpoint_stats(spark, sf_dir):  # noqa: ANN001, ANN201
    return metrics.endpoint_stats(table(spark, sf_dir, "events").withColumn("texts", F.col("event_id") % 9), "event_type", "texts", "value")


@query("""WITH r AS (SELECT source, doc_id % 11 <> 0 AS ok, doc_id % 5 AS chunks, n_chars AS tokens, doc_id % 7 AS pages, doc_id % 100 AS seconds FROM documents)
          SELECT source, count(*) FILTER (ok) AS parsed, count(*) FILTER (NOT ok) AS failed, coalesce(sum(chunks) FILTER (ok), 0) AS chunks, coalesce(sum(tokens) FILTER (ok), 0) AS tokens, coalesce(sum(pages) FILTER (ok), 0) AS pages, quantile_disc(seconds, 0.95) AS parse_p95 FROM r GROUP BY source""")
def a19_run_summary(spark, sf_dir):  # noqa: ANN001, ANN201
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("source", (d % 11 != 0).alias("ok"), (d % 5).alias("chunks"), F.col("n_chars").alias("tokens"), (d % 7).alias("pages"), (d % 100).alias("seconds"))
    return metrics.run_summary(rows, "source")


@query("SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus IN ('F', 'P')) AS final, bool_and(o_orderstatus IN ('F', 'P')) AS complete FROM orders GROUP BY o_custkey")
def a16_review_status(spark, sf_dir):  # noqa: ANN001, ANN201
    return metrics.review_status(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", ["F", "P"])


@query(f"""WITH {catalog._DENSE}, t AS (SELECT d.query_id, rank, point_id // 2 AS material, point_id % 5 <> 0 AS joined FROM dense AS d WHERE rank <= 5), s AS (SELECT vec_id AS query_id, vec_id // 2 + (vec_id % 300 = 0)::INT AS expected FROM embeddings WHERE vec_id % 100 = 0),
          f AS (SELECT s.query_id, min(rank) AS first FROM s JOIN t ON t.query_id = s.query_id AND material = expected GROUP BY 1)
          SELECT (SELECT count(first) / count(*) FROM s LEFT JOIN f USING (query_id)) AS recall_at_k, (SELECT coalesce(sum(1.0::DOUBLE / first), 0) / count(*) FROM s LEFT JOIN f USING (query_id)) AS mrr,
            (SELECT count(*) FILTER (joined) / count(*) FROM t) AS source_join, (SELECT (count(*) - count(DISTINCT (query_id, material))) / count(*) FROM t) AS duplicates""")
def a11_candidate_metrics(spark, sf_dir):  # noqa: ANN001, ANN201
    hits = catalog._dense(spark, sf_dir, 10).select("query_id", "rank", F.expr("point_id div 2").alias("material"), (F.col("point_id") % 5 != 0).alias("joined"))
    samples = table(spark, sf_dir, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.expr("vec_id div 2 + int(vec_id % 300 = 0)").alias("expected"))
    return metrics.candidate_metrics(samples, hits, 5)


@query(rf"""WITH d AS (SELECT lang, regexp_replace(text, '([^\p{{L}}\p{{M}}\p{{N}}_])', '\1\1', 'g') AS w FROM documents),
          t AS (SELECT lang, unnest(list_filter(list_transform(regexp_extract_all(w, '(?:^|[^\p{{L}}\p{{M}}\p{{N}}_])([A-Za-z](?:[A-Za-z]|--){{3,}})(?:$|[^\p{{L}}\p{{M}}\p{{N}}_])', 1), lambda x: lower(replace(x, '--', '-'))), lambda w: w NOT IN ({", ".join(f"'{w}'" for w in text.STOP_WORDS)}))) AS term FROM d), c AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL)
          SELECT lang, term, n, (row_number() OVER (PARTITION BY lang ORDER BY n DESC, term))::INT AS rank FROM c QUALIFY rank <= 30""")
def a4_f7_profile_terms(spark, sf_dir):  # noqa: ANN001, ANN201
    # the tables hold no CJK texts, whose bigrams count as well
    return metrics.top_terms(table(spark, sf_dir, "documents"), "lang", text.profile_terms(F.col("text")), 30)


@query("""SELECT value, n, CASE WHEN total > 9 THEN 9 END AS next_cursor FROM (SELECT value, count(*) AS n, count(*) OVER () AS total FROM (SELECT unnest(['tag' || doc_id % 13, lang, '']) AS value FROM documents) WHERE value <> '' GROUP BY value) ORDER BY n DESC, value LIMIT 5 OFFSET 4""")
def a1_exploded_facets(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = table(spark, sf_dir, "documents").select(F.explode(F.array(F.concat(F.lit("tag"), F.col("doc_id") % 13), "lang", F.lit(""))).alias("tag"))
    return retrieval.facet_page(rows, F.col("tag"), 4, 5)


# ---- code, logs and texts


_ROOT = "/work/project"


@query(r"""WITH b AS (SELECT page_id, 'Traceback (most recent call last):' || chr(10) || '  File "' || ['/work/project/a.py', 'b/c.py', '/usr/lib/site-packages/x.py', '/opt/y.py'][page_id % 4 + 1] || '", line ' || page_id || ', in f' || page_id % 3 || chr(10) || '    g()' || chr(10) || '  File "/usr/lib/site-packages/z.py", line 3, in <module>' || chr(10)
            || ['ValueError: no', 'pkg.mod.TypeError: g() got an unexpected keyword argument ''key''', 'done'][page_id % 3 + 1] AS log FROM pages)
          SELECT page_id, 2::BIGINT AS frames, (page_id % 4 < 2)::BIGINT AS project_frames, 1 + (page_id % 4 = 2)::BIGINT AS dependency_frames, '<module>' AS last_function, ['ValueError', 'pkg.mod.TypeError', NULL][page_id % 3 + 1] AS exception,
            ['no', 'g() got an unexpected keyword argument ''key''', ''][page_id % 3 + 1] AS message, CASE WHEN page_id % 3 = 1 THEN 'key' ELSE '' END AS keywords FROM b""")
def f27_debug_logs(spark, sf_dir):  # noqa: ANN001, ANN201
    p = F.col("page_id")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (p % len(values) + 1).cast("int"))
    log = F.concat(F.lit('Traceback (most recent call last):\n  File "'), pick(["/work/project/a.py", "b/c.py", "/usr/lib/site-packages/x.py", "/opt/y.py"]), F.lit('", line '), p, F.lit(", in f"), p % 3, F.lit('\n    g()\n  File "/usr/lib/site-packages/z.py", line 3, in <module>\n'), pick(["ValueError: no", "pkg.mod.TypeError: g() got an unexpected keyword argument 'key'", "done"]))
    rows = table(spark, sf_dir, "pages").select("page_id", log.alias("log"))
    return rows.select("page_id", *code.debug_log(F.col("log"), _ROOT)).withColumn("keywords", F.array_join("keywords", ","))


@query(r"""SELECT doc_id, count(*) AS n, sum(e - b)::BIGINT AS covered FROM (SELECT doc_id, 0 AS b, length(s) AS e, s FROM (SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '[^\s](?s:.*?)(?:[.!?]+(?:\s|$)|[。！？]+|$)'), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13)))) AS s FROM documents)) WHERE length(s) > 0 GROUP BY doc_id""")
def f5_sentence_spans(spark, sf_dir):  # noqa: ANN001, ANN201
    spans = code.sentence_spans(table(spark, sf_dir, "documents"), "doc_id", "text")
    return spans.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("begin")).alias("covered"))


def _files(spark, sf_dir):  # noqa: ANN001, ANN202
    """Pages as files: a third of Python, with a class and a function each, the others of Markdown."""
    p = F.col("page_id")
    python = F.concat(F.lit("import os\nfrom a import b\n\n\nclass C"), p, F.lit('(Base):\n    """Doc."""\n    LIMIT = 1\n\n    def run(self, x: int = 1) -> str:\n        return b(x)\n\n\ndef f'), p, F.lit("(y):\n    return os.path.join(y)\n"), F.when(p % 9 == 0, "def broken(:\n").otherwise(""))
    markdown = F.concat(F.lit("Preface\n\n# One\ntext "), p, F.lit("\n\n```py\n# no heading\n```\n### Deep\nmore\n\nUnder\n-----\nlast\n# Two\nend"))
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("pkg/m"), p, F.when(p % 3 == 0, ".py").otherwise(".md")).alias("path"), F.when(p % 3 == 0, python).otherwise(markdown).alias("body"))


_MARKUP = [(0, "", 7), (1, "One", None), (2, "One > Deep", 13), (3, "One > Under", 16), (4, "Two", 9)]


@query(f"""WITH m(n, section, size) AS (VALUES {", ".join(f"({n}, '{s}', {z if z else 'NULL'})" for n, s, z in _MARKUP)}),
          y(n, symbol, kind) AS (VALUES (0, 'C', 'class'), (1, 'C.run', 'method'), (2, 'f', 'function'))
          SELECT page_id, n, section, NULL AS symbol, NULL AS symbol_type, coalesce(size, 5 + 1 + 5 + length(page_id::VARCHAR) + 2 + 5 + 1 + 12 + 1 + 3)::BIGINT AS size FROM pages, m WHERE page_id % 3 <> 0
          UNION ALL SELECT page_id, n, NULL, 'pkg.m' || page_id || '.' || CASE n WHEN 0 THEN 'C' || page_id WHEN 1 THEN 'C' || page_id || '.run' ELSE 'f' || page_id END, kind,
            CASE n WHEN 0 THEN 25 + 2 + 14 + length(page_id::VARCHAR) + 1 + 14 + 1 + 13 WHEN 1 THEN 25 + 2 + 8 + length(page_id::VARCHAR) + 1 + 37 + 1 + 19 ELSE 25 + 2 + 9 + length(page_id::VARCHAR) + 1 + 26 END FROM pages, y WHERE page_id % 3 = 0 AND page_id % 9 <> 0
          UNION ALL SELECT page_id, 0, NULL, NULL, 'module', 182 + 2 * length(page_id::VARCHAR) FROM pages WHERE page_id % 9 = 0""")
def w5_w6_x1_x2_code_chunks(spark, sf_dir):  # noqa: ANN001, ANN201
    found = code.code_chunks(_files(spark, sf_dir), "page_id", "path", "body")
    return found.select("page_id", "n", "section", "symbol", "symbol_type", F.length("text").cast("bigint").alias("size"))


@query("""WITH s(n, name, kind, relations) AS (VALUES (0, 'os', 'import', 'imports os'), (1, 'b', 'import', 'imports a.b'), (2, 'C', 'class', 'inherits Base'), (3, 'C.LIMIT', 'constant', ''), (4, 'C.run', 'method', 'calls b'), (5, 'f', 'function', 'calls os.path.join'))
          SELECT page_id, n, 'pkg.m' || page_id || '.' || CASE n WHEN 2 THEN 'C' || page_id WHEN 3 THEN 'C' || page_id || '.LIMIT' WHEN 4 THEN 'C' || page_id || '.run' WHEN 5 THEN 'f' || page_id ELSE name END AS name, kind, relations FROM pages, s WHERE page_id % 3 = 0 AND page_id % 9 <> 0""")
def v10_symbols(spark, sf_dir):  # noqa: ANN001, ANN201
    files = _files(spark, sf_dir).where(F.col("path").endswith(".py"))
    return code.code_symbols(files, "page_id", "path", "body").withColumn("relations", F.array_join("relations", ","))


_OLD = ["f(a, b: int = 1) -> str", "f(a, *, k=None)", "f(a", "f(a, /, b, *args, **kw)"]
_NEW = ["f(a: str, b: int = 2, c=3) -> int", "f(k=None)", "f(a)", "f(a, b, **kw)"]


@query("""SELECT doc_id, ['c', '', 'a', ''][doc_id % 4 + 1] AS added, ['', 'a', '', 'args'][doc_id % 4 + 1] AS removed, ['a', '', '', ''][doc_id % 4 + 1] AS types, ['b', '', '', ''][doc_id % 4 + 1] AS defaults, doc_id % 4 = 0 AS result_changed FROM documents""")
def v8_signature_diffs(spark, sf_dir):  # noqa: ANN001, ANN201
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("doc_id") % 4 + 1).cast("int"))
    found = code.signature_diffs(table(spark, sf_dir, "documents").select("doc_id", pick(_OLD).alias("old"), pick(_NEW).alias("new")), "doc_id", "old", "new")
    return found.drop("n").withColumns({c: F.array_join(c, ",") for c in ("added", "removed", "types", "defaults")})


@query(f"""WITH {catalog._DENSE}, x AS (SELECT query_id, point_id, round(score, 9) AS score, rank, ['source_code', 'api_documentation', 'version_diff', 'migration_guide', 'release_note', 'issue'][point_id % 6 + 1] AS kind, point_id % 4 AS v FROM dense)
          SELECT query_id, point_id, (row_number() OVER (PARTITION BY query_id ORDER BY CASE v WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 4 END, list_position(['version_diff', 'migration_guide', 'release_note', 'api_documentation', 'source_code'], kind), score DESC, rank))::INT AS new_rank FROM x WHERE kind <> 'issue' AND kind <> 'source_code' QUALIFY new_rank <= 5""")
def x47_version_comparison(spark, sf_dir):  # noqa: ANN001, ANN201
    kinds = ["source_code", "api_documentation", "version_diff", "migration_guide", "release_note", "issue"]
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("point_id") % 6 + 1).cast("int"))
    hits = catalog._dense(spark, sf_dir, 10).withColumns({"score": F.round("score", 9), "source_type": kind, "version": (F.col("point_id") % 4).cast("string")})
    return hub.version_comparison(hits, "1", "2", 5).select("query_id", "point_id", "new_rank")
