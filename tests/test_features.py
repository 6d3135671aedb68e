"""Rounded quotients against Python's own rounding."""

from pyspark.sql import functions as F

from lodestone.functions import features


def test_quotients_round_as_doubles_do(spark):
    pairs = spark.range(0, 700).withColumnRenamed("id", "w").join(spark.range(1, 100).withColumnRenamed("id", "c"), F.lit(True))
    pairs = pairs.unionByName(spark.createDataFrame([(k * 125, 1000) for k in range(0, 9000, 7)] + [(10**6 + 5, 200), (10**7 + 25, 1000)], "w long, c long"))
    rows = pairs.select("w", "c", features.hundredths(F.col("w"), F.col("c")).alias("r")).collect()
    wrong = [(r.w, r.c, r.r) for r in rows if r.r != round(r.w / r.c, 2)]
    assert not wrong and len(rows) > 69_000
