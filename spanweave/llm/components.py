"""Connected components of a link table, without collecting links or nodes anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.operators.lineage import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes in ``links(src, dst)``; the component is its smallest node.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends by
    doubling, and replaces the ends of the links by where they arrive; links inside a component
    vanish and parallel ones become one. Nodes that remain shrink by a constant factor a round, so
    a few rounds do. Only minima are aggregated, so a node of any degree is no large group.
    Loops are allowed; an empty table gives an empty one.
    """
    left = materialize(
        links.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).where("a <> b").distinct(),
        "links",
    )
    label = None
    while not left.isEmpty():
        # Every node hooks to its smallest smaller neighbour; one without is an end.
        hooks = materialize(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")), "hooks")
        while True:
            further = hooks.select(F.col("node").alias("to"), F.col("to").alias("end"))
            jumped = materialize(
                hooks.join(further, "to", "left").select(
                    "node", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")
                ),
                "hooks",
            )
            hooks = jumped.select("node", "to")
            if jumped.where("moved").isEmpty():
                break
        if label is None:
            ends = left.select(F.col("a").alias("node")).union(left.select(F.col("b"))).distinct()
            label = ends.join(hooks, "node", "left").select("node", F.coalesce("to", "node").alias("component"))
        else:
            moved = hooks.withColumnRenamed("node", "component")
            label = label.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        label = materialize(label, "components")
        from_a = hooks.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        from_b = hooks.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = left.join(from_a, "a", "left").join(from_b, "b", "left").select(
            F.coalesce("to_a", "a").alias("u"), F.coalesce("to_b", "b").alias("v")
        )
        left = materialize(
            moved.where("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "links"
        )
    if label is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return label
