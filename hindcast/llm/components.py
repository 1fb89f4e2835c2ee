"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """node, class: the least node of its component, for every node of ``links`` (a, b).

    Each round a node takes the least label among its own and its neighbours', then the label of its label. Labels are
    written to the shared folder after each round; only the number of changes comes to the driver. Repeated and
    self links are harmless; null ends are dropped; an empty table gives no rows.
    """
    whole = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = settled(
        whole.select(F.col("a").alias("at"), F.col("b").alias("to"))
        .unionByName(whole.select(F.col("b").alias("at"), F.col("a").alias("to"))).distinct(),
        "links")
    labels = settled(both.groupBy("at").agg(F.least("at", F.min("to")).alias("class")).withColumnRenamed("at", "node"), "labels")
    while True:
        near = (
            both.join(labels, both["at"] == labels["node"]).groupBy("to").agg(F.min("class").alias("near")))
        closer = labels.join(near, labels["node"] == near["to"], "left").select(
            "node", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        above = labels.select(F.col("node").alias("up"), F.col("class").alias("top"))
        moved = settled(
            closer.join(above, closer["class"] == above["up"], "left")
            .select("node", "old", F.least("class", "top").alias("class")), "labels")
        labels = moved.select("node", "class")
        if not moved.where(F.col("class") != F.col("old")).take(1):
            return labels


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (node, class) joined further by ``links`` (a, b) among nodes in and out of them.

    Only links between different classes count, once for each two classes, so a round works on classes and not on nodes.
    """
    left = classes.select(F.col("node").alias("a"), F.col("class").alias("ca"))
    right = classes.select(F.col("node").alias("b"), F.col("class").alias("cb"))
    between = settled(
        links.join(left, "a", "left").join(right, "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where(F.col("a") != F.col("b")).distinct(),
        "between")
    if not between.take(1):
        return classes
    tops = components(between)
    above = tops.select(F.col("node").alias("class"), F.col("class").alias("top"))
    moved = classes.join(above, "class", "left").select("node", F.coalesce("top", "class").alias("class"))
    new = tops.join(classes.select("node"), "node", "left_anti").select("node", "class")
    return settled(moved.unionByName(new), "merged")
