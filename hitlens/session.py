"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# runtime settings only: they can be applied to a session that already exists
SETTINGS = {
    # log times are kept as wall clock
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # wide projections generate methods the JIT refuses to compile; beyond this size Spark
    # falls back to split methods, which run several times faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession, parts: int = 0) -> SparkSession:
    """Apply the runtime settings; size-dependent ones (shuffle partitions) stay with the cluster.

    ``parts``: partitions that the input needs; shuffles that adaptive execution plans start with as many, if the
    cluster's number is smaller.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    initial = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial))
    return spark
