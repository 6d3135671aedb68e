"""Hierarchies: paths of a collection tree with missing parents and cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collection_paths(nodes: DataFrame, most: int = 64) -> DataFrame:
    """(key, path, fault) of (key, name, parent_key).

    Roots have their name, children their parent's path and name. An absent parent reads
    [missing:parent], a member of a cycle [cycle]/key/name; descendants go on from there, and an
    empty name reads [unnamed:key]. Pointers double in each round, so ``most`` rounds reach any
    depth; nodes that never reach a root hang on a cycle, whose members are those that reach
    themselves.
    """
    base = nodes.select("key", F.coalesce(F.nullif("name", F.lit("")), F.concat(F.lit("[unnamed:"), F.col("key"), F.lit("]"))).alias("label"), F.nullif("parent_key", F.lit("")).alias("parent"))
    keys = base.select(F.col("key").alias("there"))
    base = base.join(keys, F.col("parent") == F.col("there"), "left")
    absent = F.col("parent").isNotNull() & F.col("there").isNull()
    cycles = _cycle_members(base.select("key", F.col("there").alias("parent")))
    base = base.join(cycles, "key", "left")
    in_cycle = F.col("cyclic").isNotNull()
    start = F.when(in_cycle, F.concat(F.lit("[cycle]/"), "key", F.lit("/"), "label")).when(absent, F.concat(F.lit("[missing:"), "parent", F.lit("]/"), "label")).otherwise(F.col("label"))
    fault = F.when(in_cycle, "cycle").when(absent, "missing_parent")
    state = base.select("key", start.alias("path"), F.when(~in_cycle, F.col("there")).alias("up"), fault.alias("fault"))
    for _ in range(most):
        state = state.checkpoint(eager=True) if _has_dir(state) else state.persist()
        if not state.where("up IS NOT NULL").limit(1).count():
            break
        above = state.select(F.col("key").alias("a"), F.col("path").alias("above"), F.col("up").alias("next"))
        state = state.join(above, F.col("up") == F.col("a"), "left").select("key", F.coalesce(F.concat("above", F.lit("/"), "path"), "path").alias("path"), F.col("next").alias("up"), "fault")
    return state.select("key", "path", "fault")


def _has_dir(df: DataFrame) -> bool:
    return df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined()


def _cycle_members(edges: DataFrame) -> DataFrame:
    """(key, cyclic) of the nodes that reach themselves, by doubling jumps: after log2(n) rounds every
    node's jump lands in a cycle if it hangs on one, and the landing places' closure is the cycles."""
    jump = edges.where("parent IS NOT NULL")
    n, length = jump.count(), 1
    while length < n and jump.limit(1).count():
        jump = jump.alias("a").join(jump.alias("b"), F.col("a.parent") == F.col("b.key")).select(F.col("a.key").alias("key"), F.col("b.parent").alias("parent")).persist()
        length *= 2
    found = jump.select(F.col("parent").alias("key")).distinct()
    # the landing places of all nodes cover each cycle: every member is the landing place of some member
    return found.withColumn("cyclic", F.lit(True))


def components(links: DataFrame) -> DataFrame:
    """(node, name) of the nodes of links (a, b): the least node of their component. In each round, every node's name becomes the least name
    around it and then that name's own, so chains shorten fast."""
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    edges = links.select(both.alias("e")).select("e.*").distinct()
    edges = edges.checkpoint(eager=True) if _has_dir(edges) else edges.persist()
    names = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("name")).withColumnRenamed("a", "node")
    while True:
        around = edges.join(names, F.col("b") == F.col("node")).groupBy("a").agg(F.min("name").alias("least"))
        lower = names.join(around, F.col("node") == F.col("a")).select("node", F.col("name").alias("before"), F.least("name", "least").alias("name"))
        own = lower.select(F.col("node").alias("of"), F.col("name").alias("its"))
        moved = lower.join(own, F.col("name") == F.col("of"), "left").select("node", "before", F.least("name", F.coalesce("its", "name")).alias("name"))
        moved = moved.checkpoint(eager=True) if _has_dir(moved) else moved.persist()
        names = moved.select("node", "name")
        if not moved.where("before <> name").limit(1).count():
            return names
