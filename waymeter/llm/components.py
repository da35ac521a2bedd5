"""Connected components of a graph whose links are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymeter.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is named by its smallest node.

    Each round hooks a component to its smallest neighbour, follows the hooks twice and relabels the links, of
    which only those between different components remain. Rounds end when none does; every round is a written
    table, so a lost executor costs one round at most. Self-links and repeated links do no harm.
    """
    ends = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    nodes = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = materialize(nodes.select("node", F.col("node").alias("component")), "components")
    open_links = materialize(ends.where("a <> b").distinct(), "open-links")
    while not open_links.isEmpty():
        hooks = (
            open_links.select(F.greatest("a", "b").alias("root"), F.least("a", "b").alias("to"))
            .groupBy("root").agg(F.min("to").alias("to"))
        )
        further = hooks.select(F.col("root").alias("to"), F.col("to").alias("next"))
        hooks = hooks.join(further, "to", "left").select("root", F.coalesce("next", "to").alias("to"))
        further = hooks.select(F.col("root").alias("to"), F.col("to").alias("next"))
        hooks = materialize(hooks.join(further, "to", "left").select("root", F.coalesce("next", "to").alias("to")), "hooks")

        def moved(df: DataFrame, column: str, hooks: DataFrame = hooks) -> DataFrame:
            renamed = hooks.select(F.col("root").alias(column), F.col("to").alias("_to"))
            return df.join(renamed, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")

        labels = materialize(moved(labels, "component").select("node", "component"), "components")
        open_links = moved(moved(open_links, "a"), "b").where("a <> b").select("a", "b").distinct()
        open_links = materialize(open_links, "open-links")
    return labels
