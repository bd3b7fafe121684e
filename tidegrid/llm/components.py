"""Connected components of a graph whose links lie in Spark.

Each task first joins its own links by union-find, which leaves a star for each group it has
seen. Then all groups are contracted at once, again and again: every node goes to the one with the
smallest hash among itself and its neighbours. As the hashes are as good as random, even long
chains shrink by a constant share a round. Nothing of the graph reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.sources.stage import stage


def union_find(pairs: Iterable[tuple[int, int]]) -> dict[int, int]:
    """The smallest node of its group for every node of the pairs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def links() -> Iterator[tuple[int, int]]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    stars = [(x, r) for x, r in union_find(links()).items() if x != r]
    yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in stars], pa.int64()),
                                      "b": pa.array([r for _, r in stars], pa.int64())})


def _order(node: str) -> Column:
    return F.struct(F.xxhash64(node).alias("hash"), F.col(node).alias("node"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked with, for all nodes of ``links`` (``a``, ``b``: long)."""
    edges = stage(links.select("a", "b").where("a <> b").mapInArrow(_stars, "a long, b long"), "stars")
    first = edges
    steps = []
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = F.least(F.min(_order("b")), _order("a"))["node"]
        to = both.groupBy("a").agg(lowest.alias("to")).withColumnRenamed("a", "node")
        to = stage(to, "contract")
        steps.append(to)
        up = edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(
            to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = stage(up.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    if not steps:
        return first.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = steps[0].select("node", F.col("to").alias("root"))
    for to in steps[1:]:
        root = root.join(to.select(F.col("node").alias("root"), "to"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root"))
    root = stage(root, "roots")
    smallest = stage(root.groupBy("root").agg(F.min("node").alias("component")), "components")
    return root.join(smallest, "root").select("node", "component")
