"""Runs in committed parts, which a later call resumes: each part is proved by digests of its inputs, versions and rows before it is reused.

A run deals its units to parts by a hash of their names. A part's rows are written first and its manifest last; both writes are committed as a whole by
Spark's writer, so a part without a manifest was not finished and is written anew. On resuming, every manifest must name the same selection (units with
their fingerprints) and the same versions, and the rows found must have the digest that it states; otherwise the run refuses with ``Mismatch`` and
changes nothing. Digests don't depend on order or partitions: the number of rows and the sum and the exclusive or of their 64-bit hashes.

Null names and fingerprints are values of their own; repeated units are worked on as often as they occur. A run without units has empty parts.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = 8
_MANIFEST = "part int, selection string, versions string, inputs string, outputs string"


class Mismatch(RuntimeError):
    """What a folder holds isn't what the run would continue."""


def digest(rows: DataFrame) -> str:
    """What rows hold, whatever their order."""
    hashed = rows.select(F.xxhash64(*(F.to_json(F.struct(c)) for c in sorted(rows.columns))).alias("h"))
    found = hashed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x")).first()
    return f"{found.n}:{found.s or 0}:{found.x or 0}"


def _manifests(spark: SparkSession, folder: str) -> dict[int, dict]:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    named = [s.getPath() for s in fs.listStatus(target)] if fs.exists(target) else []
    done = [p.toString() for p in named if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return {r.part: r.asDict() for r in spark.read.schema(_MANIFEST).json(done).collect()} if done else {}  # a row for each part


def part_of(parts: int):  # noqa: ANN201
    return F.pmod(F.xxhash64("unit"), F.lit(parts)).cast("int")


def resumed(units: DataFrame, work: Callable[[DataFrame], DataFrame], versions: dict[str, str], folder: str, parts: int = PARTS, most: int | None = None) -> DataFrame | None:
    """The rows that ``work`` makes of units (unit, fingerprint), from the folder's finished parts and from the rest, which are worked on and committed. With
    ``most``, no more than so many new parts are made, and null is returned if the run isn't finished. work's rows depend on the units it is given alone."""
    spark, told = units.sparkSession, json.dumps(versions, sort_keys=True)
    selection, found = digest(units.select("unit", "fingerprint")), _manifests(spark, folder)
    if any(m["selection"] != selection or m["versions"] != told for m in found.values()) or any(p >= parts for p in found):
        raise Mismatch("the folder belongs to another selection, other versions or another number of parts")
    dealt = units.withColumn("part", part_of(parts))
    for p, m in sorted(found.items()):
        if digest(spark.read.parquet(f"{folder}/rows/part={p}")) != m["outputs"] or digest(dealt.where(F.col("part") == p).select("unit", "fingerprint")) != m["inputs"]:
            raise Mismatch(f"part {p} is not what its manifest says")
    made = 0
    for p in range(parts):
        if p in found:
            continue
        if made == most:
            return None
        own = dealt.where(F.col("part") == p).drop("part")
        work(own).write.mode("overwrite").parquet(f"{folder}/rows/part={p}")
        manifest = (p, selection, told, digest(own.select("unit", "fingerprint")), digest(spark.read.parquet(f"{folder}/rows/part={p}")))
        spark.createDataFrame([manifest], _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{folder}/manifests/part={p}")
        made += 1
    return spark.read.parquet(*(f"{folder}/rows/part={p}" for p in range(parts)))


def receipt(packet: DataFrame, decisions: DataFrame, key: str) -> tuple[DataFrame, str]:
    """(accepted rows, packet digest): a review's decisions (key, packet_digest, accepted) on a packet of rows. Decisions on another packet, on rows it
    lacks, or twice on one row are refused."""
    own = digest(packet)
    wrong = decisions.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.bool_or(~F.col("packet_digest").eqNullSafe(F.lit(own))).alias("other")).where("n > 1 OR other")
    unknown = decisions.join(packet.select(key), key, "left_anti")
    if wrong.limit(1).count() or unknown.limit(1).count():
        raise Mismatch("a decision is not on a row of this packet")
    return packet.join(decisions.where("accepted").select(key), key, "left_semi"), own


def acknowledged(receipts: DataFrame, manifest: str) -> tuple[DataFrame, DataFrame]:
    """(finding ids, receipt ids): what receipts (receipt_id, manifest, finding_id, decision) acknowledge for a manifest's digest, and the receipts that are for
    another one. A finding is acknowledged if any valid receipt says "acknowledge" and none says "reject"."""
    valid = receipts.where(F.col("manifest") == manifest)
    told = valid.groupBy("finding_id").agg(F.bool_or(F.col("decision") == "acknowledge").alias("yes"), F.bool_or(F.col("decision") == "reject").alias("no"))
    return told.where("yes AND NOT no").select("finding_id"), receipts.where(~F.col("manifest").eqNullSafe(F.lit(manifest))).select("receipt_id").distinct()
