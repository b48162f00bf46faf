"""Connected components of a table of links, without gathering a component anywhere."""

from pyspark.sql import DataFrame, functions as F

from dockflow.llm.common import release, settle


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that each linked node is connected to; links: x, y.

    In each round a node takes the smallest label among itself and its neighbours, then the label of that
    label, so chains shrink by halves. Only sums over keys are shuffled.
    """
    both = links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    edges = settle(both.distinct())
    settled = labels = settle(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")).select(
        F.col("x").alias("node"), "label"))
    while True:
        heard = edges.join(labels.withColumnRenamed("node", "y"), "y").groupBy("x").agg(F.min("label").alias("low"))
        lower = labels.join(heard.withColumnRenamed("x", "node"), "node").select(
            "node", "label", F.least("label", "low").alias("low"))
        of_label = labels.select(F.col("node").alias("low"), F.col("label").alias("jump"))
        before, moved = settled, settle(lower.join(of_label, "low").select("node", "label", F.least("low", "jump").alias("next")))
        release(before)
        settled, labels = moved, moved.select("node", F.col("next").alias("label"))
        if moved.filter("next <> label").isEmpty():
            release(edges)
            return labels
