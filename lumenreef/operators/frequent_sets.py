"""Which elements of lists go together: frequent sets with their mean score, grown as a prefix tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreef.session import shared_path


def frequent_sets(rows: DataFrame, items: str, score: str, least: int) -> DataFrame:
    """``items, n, avg_score`` for every set of elements that at least ``least`` rows hold together: sorted, with their mean score.

    Rows with equal elements are one row with a count first. Then the tree grows by one level a pass: each node (a sorted
    prefix) holds what is left of the lists that contain it, equal rests as one with a count, and offers every element of a
    rest as the next one; the offers that enough rows make become the nodes of the next level. Rests and offers are counted
    in their tasks before they are shuffled. Null and repeated elements do not count, rows without any or without a score are
    left out. Ends with the largest set.
    """
    spark = rows.sparkSession

    def stored(df: DataFrame, tag: str) -> DataFrame:
        path = shared_path(spark, tag)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    kept = F.array_sort(F.array_distinct(F.filter(items, lambda x: x.isNotNull())))
    sums = F.sum("n").alias("n"), F.sum("total").alias("total")
    scored = rows.where(F.col(score).isNotNull()).select(F.array().cast("array<string>").alias("node"), kept.alias("rest"), F.lit(1).cast("bigint").alias("n"), F.col(score).alias("total"))
    rests, levels = scored, []
    while True:
        rests = stored(rests.where(F.size("rest") > 0).groupBy("node", "rest").agg(*sums), "rests")
        offers = rests.select("node", "rest", "n", "total", F.posexplode("rest").alias("_p", "_x"))
        offers = offers.select(F.concat("node", F.array("_x")).alias("node"), F.slice("rest", F.col("_p") + 2, F.size("rest")).alias("rest"), "n", "total")
        nodes = stored(offers.groupBy("node").agg(*sums).where(F.col("n") >= least), "nodes")
        levels.append(nodes)
        if nodes.isEmpty():
            break
        rests = offers.join(nodes.select("node"), "node", "left_semi")
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level)
    return whole.select(F.col("node").alias("items"), "n", (F.col("total") / F.col("n")).alias("avg_score"))
