"""Ordered consumption of a delta log with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def pending(catalog: DataFrame, consumed: DataFrame) -> DataFrame:
    """Catalogue rows after the last consumed one. A consumed delta that vanished or changed is an error."""
    past = consumed.alias("d").join(catalog.alias("c"), "sequence", "left").where(~F.col("c.delta_sha256").eqNullSafe(F.col("d.delta_sha256")))
    if past.limit(1).count():
        raise ValueError("a consumed delta vanished or changed")
    last = consumed.agg(F.coalesce(F.max("sequence"), F.lit(0)).alias("last")).first()["last"]
    return catalog.where(F.col("sequence") > last).orderBy("sequence")


def consume(spark: SparkSession, path: str, schema: str, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Every new delta file once; ``apply`` must be idempotent, since a batch may come again after a failure."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(state: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The state after a batch (key, sequence, operation, ...). Deleted keys stay as tombstones with their sequence, so that older operations that
    come later never undo newer ones; ``live`` leaves them out. A state without ``operation`` holds no tombstones."""
    known = state if "operation" in state.columns else state.withColumn("operation", F.lit("upsert"))
    every = known.unionByName(batch, allowMissingColumns=True)
    # of operations with one sequence, a delete comes last
    last = F.max_by(F.struct(*(F.col(c) for c in every.columns if c != key)), F.struct("sequence", F.when(F.col("operation") == "delete", 1).otherwise(0)))
    return every.groupBy(key).agg(last.alias("last")).select(key, "last.*")


def live(state: DataFrame) -> DataFrame:
    """The rows of a merged state that aren't deleted."""
    return state.where("operation <> 'delete'").drop("operation")
