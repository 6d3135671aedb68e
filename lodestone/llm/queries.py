"""The queries of the training-data operators, one each, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import ball_kmeans, bpe, exact_dedup, idfiles, jaccard_join, licenses, maxscore, mixing, paired_files, perspectives, quality, substring_dedup, toxicity
from lodestone.llm.shared import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.detections(table(spark, sf_dir, "documents"))


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assignments(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op8_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.read(idfiles.write(table(spark, sf_dir, "documents")), ids=False)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.assignments(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_paired_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paired_files.rewrite(table(spark, sf_dir, "sales"), table(spark, sf_dir, "sale_lines"))


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_kmeans.cluster(table(spark, sf_dir, "embeddings"))


def _kmeans_sql(rounds: int = 10) -> str:
    """Plain rounds: every vector against every centroid."""
    steps = [
        """v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY key, vec) - 1 AS c, vec FROM (
                SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS key, vec FROM v ORDER BY key, vec LIMIT 8))""",
    ]
    near = """a{0} AS MATERIALIZED (
            SELECT vec_id, vec, arg_min(c, struct_pack(d := d, c := c)) AS c, min(d) AS d FROM (
                SELECT n, v.vec_id, v.vec, c{0}.c, list_sum(list_transform(list_zip(v.vec, c{0}.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
                FROM (SELECT *, row_number() OVER () AS n FROM v) AS v, c{0}) GROUP BY n, vec_id, vec)"""
    for i in range(rounds):
        steps += [
            near.format(i),
            f"""c{i + 1} AS MATERIALIZED (
            SELECT c{i}.c, coalesce(m.vec, c{i}.vec) AS vec FROM c{i} LEFT JOIN (
                SELECT c, list(floor(total / n)::BIGINT ORDER BY part) AS vec FROM (
                    SELECT c, part, sum(x)::DOUBLE AS total, count(*)::DOUBLE AS n FROM (SELECT c, unnest(vec) AS x, generate_subscripts(vec, 1) AS part FROM a{i}) GROUP BY c, part)
                GROUP BY c) AS m ON m.c = c{i}.c)""",
        ]
    return f"""
        WITH {", ".join([*steps, near.format(rounds)])}
        SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c.vec, ',')) AS centroid_sha256
        FROM a{rounds} AS a JOIN c{rounds} AS c ON a.c = c.c"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op13_ball_kmeans": _kmeans_sql(),
    "op3_perspectives": r"""
        WITH m AS (
            SELECT DISTINCT conv_id, turn, nullif(role, '') AS role, coalesce(text, '') AS text,
                   floor(turn / 32)::BIGINT AS block, md5(coalesce(nullif(role, ''), '') || '|' || coalesce(text, '')) AS key
            FROM conversations),
        c AS (
            SELECT *, ceil(count(*) OVER (PARTITION BY conv_id, block) / 32)::BIGINT AS slices,
                   ((((coalesce(turn, 0) % 32) + 32) % 32) * 4294967296 + ('0x' || substr(key, 1, 8))::BIGINT) / (32 * 4294967296) AS share
            FROM m),
        s AS (
            SELECT *, CASE WHEN slices > 1 THEN least(floor(share * slices * 32)::BIGINT, slices * 32 - 1) ELSE 0 END AS slice FROM c),
        p AS (SELECT DISTINCT conv_id, role AS perspective FROM m WHERE role IS NOT NULL AND role <> 'system'),
        r AS (
            SELECT s.conv_id, perspective, block, slice, turn, key, coalesce(role = perspective, false) AS mine,
                   CASE WHEN role = perspective THEN '<|im_start|>assistant' || chr(10)
                        WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
                        ELSE '<|im_start|>user' || coalesce(' name=' || replace(role, '<|', '< |'), '') || chr(10) END AS head,
                   replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
            FROM s JOIN p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
        o AS (
            SELECT *, sum(length(head) + length(body)) OVER w - length(body) AS begins, sum(length(head) + length(body)) OVER w - 1 AS ends
            FROM r WINDOW w AS (PARTITION BY conv_id, perspective, block, slice ORDER BY turn NULLS FIRST, key))
        SELECT conv_id, perspective, block, slice, count(*) AS n_messages, count(*) FILTER (mine) AS n_trained,
               string_agg(head || body, '' ORDER BY turn NULLS FIRST, key) AS rendered,
               coalesce(string_agg(begins::BIGINT || '-' || ends::BIGINT, ',' ORDER BY turn NULLS FIRST, key) FILTER (mine), '') AS loss_spans
        FROM o GROUP BY conv_id, perspective, block, slice""",
    "op4_maxscore": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.vec, v.vec)::BIGINT AS score
            FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op9_jaccard_join": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                                WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                                ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], ' '))) END AS items
            FROM w),
        u AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s),
        linked AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM u AS a JOIN u AS b ON a.item = b.item AND a.doc_id <> b.doc_id AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM s UNION SELECT reach.doc_id, y FROM reach JOIN linked ON x = other)
        SELECT doc_id, len(items)::BIGINT AS n_shingles, (SELECT min(other) FROM reach WHERE reach.doc_id = s.doc_id) AS component_id FROM s""",
    "op10_mixing": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS key
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
            FROM d GROUP BY source),
        level(n, source, source_size, weight, target, done) AS (
            SELECT 0, source, source_size, weight,
                   (sum(source_size) OVER ())::DOUBLE * weight / sum(weight) OVER (), false FROM s
            UNION ALL
            SELECT n + 1, source, source_size, weight,
                   CASE WHEN target >= 3 * source_size THEN (3 * source_size)::DOUBLE
                        ELSE (sum(source_size) OVER ()
                              - sum(CASE WHEN target >= 3 * source_size THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE * weight
                             / sum(CASE WHEN target >= 3 * source_size THEN 0 ELSE weight END) OVER () END, false
            FROM level WHERE n < 40),
        goal AS (
            SELECT source, source_size, target,
                   CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS whole
            FROM level WHERE n = 40),
        j AS (
            SELECT d.*, source_size, target, whole, greatest(0.0, target - whole * source_size) AS rest,
                   sum(size) OVER (PARTITION BY d.source ORDER BY key) - size / 2.0 AS middle
            FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source)
        SELECT doc_id, size, source_size, target, (size * (whole + (middle <= rest)::BIGINT))::BIGINT AS taken FROM j""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: f for name, f in list(globals().items()) if name.startswith("op")}
