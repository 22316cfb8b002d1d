"""Connected components: forests within tasks, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.columns import stored

#: Edges that a task holds at once.
LOCAL = 1 << 19
#: A node with more than this part of all ends of edges is heavy, so there are no more heavy nodes than this.
HEAVY = 4096
#: Rows of a batch that a task returns.
ROWS = 10_000


def star(u: pa.Array, v: pa.Array) -> tuple[pa.Array, pa.Array]:
    """An edge from each node of these edges, but for the smallest of its component, to that smallest one."""
    ends = pa.chunked_array([u, v]).combine_chunks().dictionary_encode()
    order = pc.array_sort_indices(ends.dictionary)
    nodes = ends.dictionary.take(order)
    rank = np.empty(len(nodes), np.int64)
    rank[order.to_numpy(zero_copy_only=False)] = np.arange(len(nodes))
    one, two = np.split(rank[ends.indices.to_numpy(zero_copy_only=False)], 2)
    label = np.arange(len(nodes))
    while len(one):
        # Roots take the smallest root next to them, then every node its root's root.
        a, b = label[one], label[two]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, label[label]):
            label = label[label]
        apart = label[one] != label[two]
        one, two = one[apart], two[apart]
    below = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes.take(pa.array(below)), nodes.take(pa.array(label[below]))


def forests(edges: DataFrame, limit: int) -> DataFrame:
    """Edges that connect the same nodes: each run of about `limit` edges of a task is replaced by its `star`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if held:
                whole = pa.Table.from_batches(held).combine_chunks()
                u, v = star(*(whole.column(name).combine_chunks() for name in ("u", "v")))
                yield from pa.Table.from_arrays([u, v], ["u", "v"]).to_batches(max_chunksize=ROWS)

        held, number = [], 0
        for batch in batches:
            held.append(batch)
            number += batch.num_rows
            if number >= limit:
                yield from flush(held)
                held, number = [], 0
        yield from flush(held)

    return edges.select("u", "v").mapInArrow(run, edges.select("u", "v").schema)


def _beside_least(edges: DataFrame, number: int, itself: bool) -> DataFrame:
    """Edges with `m`, the smallest neighbour of `u` (or `u` itself, if smaller and asked for).

    Heavy nodes, whose number is bounded, are sent to all tasks, so that the others' join has
    none of a large part of all edges.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    if itself:
        least = least.withColumn("m", F.least("u", "m"))
    least = stored(least, "least")
    heavy = F.broadcast(least.filter(F.col("degree") > number // HEAVY).select("u", "m"))
    light = least.filter(F.col("degree") <= number // HEAVY).select("u", "m")
    return edges.join(heavy, "u").unionByName(edges.join(heavy, "u", "left_anti").join(light, "u"))


def _settled(edges: DataFrame) -> DataFrame:
    """Large-star and small-star steps until every node has one edge, to the smallest of its component.

    Every step leaves no more edges than before; the number of steps grows with the logarithm
    of the number of nodes.
    """
    mark = None
    while True:
        now = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first()
        if now == mark:
            return edges
        mark = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _beside_least(both, 2 * now[0], itself=True).filter("v > u")
        edges = stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        # Here u > v on every edge.
        joined = _beside_least(edges, now[0], itself=False)
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(joined.select("u", F.col("m").alias("v"))).distinct(), "edges")


def components(edges: DataFrame, local: int = LOCAL) -> DataFrame:
    """`node` and `component`, its smallest reachable node, for all nodes of the edges (`u`, `v`).

    Each task first replaces its edges, `local` of them at a time, by forests of stars, and
    the edges left are dealt out anew for as long as that halves them. If one task can hold
    the rest, that is the result; else star steps settle it. Edges of a node with itself are left out.
    """
    edges = stored(forests(edges.filter("u <> v"), local), "edges")
    number = edges.count()
    while number > local:
        dealt = edges.repartition(-(-number // local), F.xxhash64("u", "v"))
        edges, before = stored(forests(dealt, local), "edges"), number
        number = edges.count()
        if 2 * number > before:
            edges = _settled(edges)
            break
    else:
        edges = stored(forests(edges.repartition(1), local + 1), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
