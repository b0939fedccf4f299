"""Connected components of a link table, by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """Columns node, root: the smallest node reachable, for every node of a link (a, b).

    Nothing but one count per round reaches the driver. A round takes the smallest label
    among the neighbours and then jumps to the label of that label, so the number of
    rounds grows with the logarithm of the longest path. Hub nodes are ordinary skewed
    join keys (both sides of each join are read back from tables, so Spark may split
    them), and the minima combine before the shuffle.
    """
    edges = written(links.selectExpr("a", "b").union(links.selectExpr("b", "a")).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                     .select("node", F.least("node", "near").alias("root")), "labels")
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        lowered = written(labels.join(seen, F.col("node") == F.col("a"))
                          .select("node", "root", F.least("root", "near").alias("low")), "lowered")
        jump = lowered.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        after = written(lowered.join(jump, "low").select("node", "root", F.least("low", "lower").alias("next")), "labels")
        if after.filter("next < root").isEmpty():
            return after.select("node", F.col("next").alias("root"))
        labels = after.select("node", F.col("next").alias("root"))
