"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import parts, rows_of, staged

#: Links that one task joins by itself.
TASK_LINKS = 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars: each key with the smallest one that the task's links connect it with."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
    star = [(x, find(x)) for x in root]
    star = [(x, top) for x, top in star if x != top]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in star], pa.int64()), pa.array([x for _, x in star], pa.int64())], names=["u", "v"])


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """key, component: the smallest key that each key of the written links (a, b) is connected with.

    Every task first turns its own links into stars; links that are one task's share are done then. Else large stars and
    small stars follow in turn: a node's larger, then its smaller neighbours are linked to the smallest neighbour, and
    each task makes stars of what it has, until every component is one star around its smallest key. Each round is
    written, so a lost executor costs one round. The smallest neighbour is found by a pre-aggregated minimum, and the
    join that follows is one that Spark can split where a node has very many links.
    """
    share = parts(rows_of(links), task_links)
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).coalesce(share)
    edges = staged(edges.mapInArrow(_forest, "u long, v long"))
    state = None
    while share > 1:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.inline(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        edges = staged(small.filter("u <> v").distinct().coalesce(share).mapInArrow(_forest, "u long, v long"))
        last, state = state, edges.distinct().agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
    roots = edges.select(F.col("v").alias("key")).distinct().select("key", F.col("key").alias("component"))
    return edges.select(F.col("u").alias("key"), F.col("v").alias("component")).distinct().unionByName(roots)
