"""Connected components of an edge table, without collecting links or components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webevents.llm.common import batch_of, stored

#: Links that a task joins at once, in memory (4 MB).
CHUNK = 1 << 18


def with_smallest(links: DataFrame, smallest: Column, label: str) -> DataFrame:
    """(a, b, root): the links with the aggregate ``smallest`` over the links of their node ``a``."""
    return links.join(stored(links.groupBy("a").agg(smallest.alias("root")), label), "a")


def stars_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes: every node but the smallest of its component to that one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        apart = np.flatnonzero(x != y)
        if not len(apart):
            break
        left, right, x, y = left[apart], right[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    others = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[others], nodes[root[others]]


def joined_within(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b), at most as many, that connect the same nodes: up to ``chunk`` of a task's links at a time become
    stars. The tasks follow the links' number, so that small files are read together."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        return batch_of(schema, *stars_of(*(np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= chunk:
                yield stars(held)
                held, size = [], 0
        if size:
            yield stars(held)

    tasks = max(1, -(-links.count() // chunk))
    return links.select(F.col("a").cast("long"), F.col("b").cast("long")).coalesce(tasks).mapInArrow(run, "a long, b long")


def are_stars(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones, so that the links name their components."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger"))
    )
    ends = ends.groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return ends.where("smaller > 1 OR (smaller = 1 AND larger = 1)").isEmpty()


def components(edges: DataFrame, label: str = "components", chunk: int = CHUNK) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; longs): root is the smallest node reachable.

    Tasks first join the links that they read among themselves, which leaves little to do if links are few or
    lie together. Then alternating stars: every larger neighbour of a node, then every smaller one, is
    linked to the smallest node of its neighbourhood. Both by turns, until all links are stars. A turn of stars
    is two aggregates and two joins on the node; minima are combined before their shuffle and
    stored, so that a node with very many links is one row of a table on one side of a plain join
    and adaptive execution can split the other. Only one row goes to the driver.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    while True:
        links = stored(joined_within(links, chunk), label)
        if are_stars(links):
            break
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            with_smallest(both, F.least(F.min("b"), F.col("a")), label)
            .where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
            .where("a <> b").distinct()
        )
        large = stored(large, label)
        small = (
            with_smallest(large, F.min("b"), label)
            .select(F.when(F.col("b") == F.col("root"), F.col("a")).otherwise(F.col("b")).alias("a"),
                    F.col("root").alias("b"))
            .where("a <> b").distinct()
        )
        links = stored(small, label)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
