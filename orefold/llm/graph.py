"""Connected components of a link table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) of the links a-b."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    half = len(a)
    for x, y in zip(flat[:half].tolist(), flat[half:].tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.fromiter((root(i) for i in range(len(nodes))), np.int64, len(nodes))
    return nodes, nodes[roots]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the links of a batch by as few with the same components."""
    for batch in batches:
        node, low = union_find(batch["u"].to_numpy(), batch["v"].to_numpy())
        moved = node != low
        yield pa.record_batch({"u": node[moved], "v": low[moved]})


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (u, v), both long.

    Union-find shrinks the links batch by batch to a forest; then large-star and
    small-star rounds hang every node under the smallest one of its component.
    A node with very many links is met by partial minima and by a join whose hot
    side adaptive execution can split. Nulls and loops are ignored.
    """
    forest = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    edges = materialize(forest.mapInArrow(_forest, "u long, v long").distinct(), "links")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum("u"), F.sum("v"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), "low"), F.struct("u", "low"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.low").alias("v"))
        )
        edges = materialize(small.filter("u > v").distinct(), "links")
