"""Connected components of an undirected graph by label propagation with
pointer jumping.  Labels, edges and results stay distributed; the number of
rounds grows with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): the smallest node of each node's component, for the nodes
    that occur in ``edges``.  Rows with a null end are ignored; repeated edges
    and loops change nothing; no edges give no rows.

    Each round takes, for every node, the least label among itself and its
    neighbours (a partially aggregated minimum, so a hub costs one row per map
    task), then replaces each label by its label's own label.  A join on a hub
    is split by adaptive execution.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    both = stored(e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                 .select("node", F.least("node", "m").alias("comp")))
    while True:
        near = (both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("comp").alias("m")))
        low = (labels.join(near, F.col("node") == F.col("u"), "left")
               .select("node", F.least("comp", "m").alias("comp"), F.col("comp").alias("was")))
        up = low.select(F.col("node").alias("p"), F.col("comp").alias("pc"))
        new = stored(low.join(up, F.col("comp") == F.col("p"), "left")
                  .select("node", F.least("comp", "pc").alias("comp"), "was"))
        done = new.where("comp <> was").limit(1).count() == 0
        discard(labels)
        if done:
            discard(both)
            return new.drop("was")
        labels = new
