"""Connected components of a large graph, by joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import discard, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` can reach.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label (pointer jumping), so long chains shorten by halves.
    Labels and edges stay in tables; the driver sees one count a round.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = written(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("root")), "graph-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("near")))
        hooked = labels.join(near, "node").select("node", F.least("root", "near").alias("next"), "root")
        # what the old root itself now points to, so that whole trees hook at once
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        moved = written(hooked.join(jump, "next", "left")
                        .select("node", F.least("next", "beyond").alias("root"), (F.least("next", "beyond") != F.col("root")).alias("moved")),
                        "graph-labels")
        discard(labels)
        labels = moved.select("node", "root")
        labels.written_at = moved.written_at
        if moved.where("moved").isEmpty():
            discard(both)
            return labels
