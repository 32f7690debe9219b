"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every end of the links (a, b); component is the smallest id that can be reached.

    Each round a node takes the smallest label among its neighbours and then that label's own label (pointer jumping),
    so the number of rounds grows with the logarithm of the longest path.  Every round is written to the shared folder:
    nothing depends on an executor that may be lost, and nothing but a row count comes to the driver.  Smallest labels
    are partial aggregates; both joins are plain shuffles of two tables, in which the engine splits a node or label
    that has very many rows.  Links with a null end, and from a node to itself, are ignored; an empty table gives an
    empty result.
    """
    spark = links.sparkSession
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    path = scratch_path(spark, "links")
    # a link that several regions have confirmed is walked once a round
    links.union(links.select("b", "a")).distinct().write.parquet(path)
    links = spark.read.parquet(path)
    path = scratch_path(spark, "labels0")
    (links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
     .select("id", F.least("id", "m").alias("label")).write.parquet(path))
    k = 0
    while True:
        labels = spark.read.parquet(path)
        near = (links.join(labels, links["b"] == labels["id"]).groupBy(F.col("a").alias("id"))
                .agg(F.min("label").alias("near")))
        step = labels.join(near, "id").select("id", F.least("label", "near").alias("to"), F.col("label").alias("old"))
        jump = labels.select(F.col("id").alias("to"), F.col("label").alias("far"))
        k += 1
        path = scratch_path(spark, f"labels{k}")
        (step.join(jump, "to").select("id", F.least("to", "far").alias("label"), F.col("old")).write.parquet(path))
        if not spark.read.parquet(path).filter("label <> old").limit(1).count():
            return spark.read.parquet(path).select("id", F.col("label").alias("component"))
