"""Connected components of a graph of links, by smallest label and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lake.workspace import Staged, stage


def components(links: DataFrame) -> Staged:
    """A written table of ``node`` and ``label``, the smallest node it can reach, for every node of ``links``
    (columns ``a`` and ``b``, longs).

    Every round takes the smallest label among neighbours, then the label of that
    label, so the rounds grow with the logarithm of the longest path. Labels and links are
    written tables: each join reads both sides plainly, so a node with very many
    links can be split over tasks.
    """
    both = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    written = stage(both, "links")
    both = written.rows
    labels = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.col("node")).alias("label")
    )
    staged = stage(labels, "labels")
    while True:
        known = staged.rows
        heard = both.join(known, both.a == known.node).select(F.col("b").alias("node"), "label")
        lower = heard.unionByName(known).groupBy("node").agg(F.min("label").alias("label"))
        spread = stage(lower, "labels")
        far = spread.rows.select(F.col("node").alias("at"), F.col("label").alias("far"))
        jumped = spread.rows.join(far, F.col("label") == F.col("at")).select(
            "node", F.least("label", "far").alias("label")
        )
        following = stage(jumped, "labels")
        before = known.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        after = following.rows.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        spread.discard()
        staged.discard()
        staged = following
        # Labels only ever fall, so an equal sum means that none has changed.
        if before == after:
            written.discard()
            return staged
