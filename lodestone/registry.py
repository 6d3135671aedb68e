"""Where queries and their SQL are registered."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives its rows, if SQL can."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share, from spark.checkpoint.dir. Where that is unset, a local session gets one; on a cluster it is
    an error."""
    context = spark.sparkContext
    where = context.getConf().get("spark.checkpoint.dir")
    if not where:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = "/tmp/lodestone-checkpoint"
    return f"{where}/{name}-{uuid.uuid4().hex}"
