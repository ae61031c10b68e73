"""Connected components of a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise


def contracted(edges: DataFrame) -> DataFrame:
    """The ``(a, b)`` edges with those that a task's other edges imply left out, as ``(u, v)`` stars, ``u < v``.

    Every task joins the nodes of its own edges; no row leaves its task.
    """
    kind = edges.schema["a"].dataType.simpleString()
    edges = edges.select("a", "b")

    def work(batches):
        root: dict = {}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        arrow = None
        for batch in batches:
            arrow = batch.schema.field("a").type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root.setdefault(a, a)
                root.setdefault(b, b)
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        below = [x for x in root if find(x) != x]
        for at in range(0, len(below), 50_000):
            part = below[at:at + 50_000]
            yield pa.record_batch([pa.array([find(x) for x in part], arrow), pa.array(part, arrow)], ["u", "v"])

    return edges.mapInArrow(work, f"u {kind}, v {kind}")


def is_stars(links: DataFrame) -> bool:
    """Whether every node hangs below one root only, and no root below another."""
    ends = links.groupBy(F.col("v").alias("node")).agg(F.count("*").alias("times"))
    return ends.where("times > 1").isEmpty() and links.select(F.col("u").alias("node")).join(links.select(F.col("v").alias("node")), "node", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``(a, b)`` edges that is not the least of its component, and that least node.

    Edges are first contracted inside their tasks. Then large and small stars in turn: every node
    links its larger neighbours to the least node it knows, then its smaller ones. The number of
    rounds grows with the logarithm of the longest chain; each is written to the shared folder.
    No node's neighbours meet in one task: minima are aggregated before they are shuffled.
    """
    links = materialise(contracted(edges).distinct(), "links")
    while not is_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialise(both.where("v > u").join(around, "u").select(F.col("m").alias("u"), "v").distinct(), "links")
        below = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(below, "v").where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
        links = materialise(small.unionByName(below.select(F.col("m").alias("u"), "v")).distinct(), "links")
    return links.select(F.col("v").alias("node"), F.col("u").alias("root"))
