"""Merkle manifest of a dataset by slot pivots.

Rows are the leaves of a tree per group, and the groups' roots are the leaves of one more
tree. Every `FANOUT` consecutive nodes of a tree become one parent until one node remains; a
tree of one node is that node.

1. A leaf's digest is made where the row lies; texts aren't shuffled. Leaves are sorted by
   range, so that a large group lies in many partitions; a leaf's position in its group is
   its place in its partition and the group's leaves in the partitions before.
2. Upwards, conditional aggregates spread the children of each parent into `FANOUT` slot
   columns, whose concatenation is hashed. `TIER` levels are taken between two shuffles: rows
   are dealt by group and by the ancestor `TIER` levels above, which at most
   `FANOUT ** TIER` of them share.
3. Downwards, the same aggregates over windows put the slot columns beside each child.
   Without the child's own slot they are its siblings, left and right of it. A tier's rows are
   joined with the siblings of their ancestor, of which there is one for each of these groups.

No step gathers a group's rows, only sort and joins of balanced keys; the number of jobs
grows with the logarithm of the largest group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.llm.columns import stored

#: Children of a node, and levels that one shuffle serves.
FANOUT = 3
TIER = 6

#: Key of rows without a group, and what stands before the name of the others: it sorts after.
_NONE, _NAMED = "-", "="


def field(value: Column) -> Column:
    """A value as text that no other sequence of values has: `-`, or its bytes' number, `:` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts; a null is left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def _over(number: Column, power: int) -> Column:
    return F.floor(number / F.lit(FANOUT**power)).cast("long") if power else number


def _shrunk(size: Column, power: int) -> Column:
    """Nodes left of `size` after so many levels."""
    return F.floor((size + F.lit(FANOUT**power - 1)) / F.lit(FANOUT**power)).cast("long") if power else size


def _dealt(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("top", _over(F.col("pos"), TIER)).repartition("tree", "top")


def _slots(slot: Column, node: Column) -> list[Column]:
    return [F.max(F.when(slot == number, node)) for number in range(FANOUT)]


def _placed(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """`leaves` (`tree`, `digest`, ...) with `pos` in their tree, from 0, and its `size`."""
    keys = [F.col("tree"), *[F.asc_nulls_first(name) for name in order], F.col("uid")]
    numbered = stored(leaves.withColumn("uid", F.monotonically_increasing_id()), "leaves")
    sorted_ = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("uid")
    # The upper bits of this number are the partition's, the lower ones count its rows.
    placed = stored(sorted_.withColumn("at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("rows"))
    blocks = blocks.select(
        "tree",
        "part",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("low")).alias("shift"),
        F.sum("rows").over(whole).alias("size"),
    )
    return placed.join(blocks, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _raised(nodes: DataFrame) -> DataFrame:
    """The ancestors `TIER` levels above: `tree`, `size`, `pos`, `digest`."""
    nodes = _dealt(nodes.select("tree", "size", "pos", "digest"))
    for level in range(TIER):
        slots = [slot.alias(f"c{number}") for number, slot in enumerate(_slots(F.col("pos") % FANOUT, F.col("digest")))]
        nodes = nodes.groupBy("tree", "top", "size", _over(F.col("pos"), 1).alias("pos")).agg(*slots)
        children = [F.col(f"c{number}") for number in range(FANOUT)]
        several = _shrunk(F.col("size"), level) > 1
        nodes = nodes.select("tree", "top", "size", "pos", F.when(several, digest(*children)).otherwise(children[0]).alias("digest"))
    return nodes.select("tree", _shrunk(F.col("size"), TIER).alias("size"), "pos", "digest")


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    """Leaves, their ancestors `TIER` levels above, and so on up to one node for each tree."""
    tiers = [leaves]
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        tiers.append(stored(_raised(tiers[-1]), "nodes"))
        largest = -(-largest // FANOUT**TIER)
    return tiers


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """`steps`: for each level of the tier, the digests `left` and `right` of the node among its siblings."""
    nodes, node, steps = _dealt(nodes), F.col("digest"), []
    for level in range(TIER):
        slot, run = _over(F.col("pos"), level) % FANOUT, Window.partitionBy("tree", "top", "run")
        nodes = nodes.withColumn("run", _over(F.col("pos"), level + 1))
        names = [f"c{number}" for number in range(FANOUT)]
        nodes = nodes.select("*", *[spread.over(run).alias(name) for name, spread in zip(names, _slots(slot, node))])
        left = F.concat_ws("", *[F.when(slot > number, F.col(name)) for number, name in enumerate(names)])
        right = F.concat_ws("", *[F.when(slot < number, F.col(name)) for number, name in enumerate(names)])
        several = _shrunk(F.col("size"), level) > 1
        step, above = f"step{level}", f"above{level}"
        nodes = nodes.withColumns(
            {step: F.when(several, F.struct(left.alias("left"), right.alias("right"))), above: F.when(several, digest(*map(F.col, names))).otherwise(node)}
        ).drop("run", *names)
        node = F.col(above)
        steps.append(step)
    nodes = nodes.withColumn("steps", F.filter(F.array(*steps), lambda step: step.isNotNull()))
    return nodes.drop(*steps, *[f"above{level}" for level in range(TIER)])


def _paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with the `path` of siblings up to the last tree's root; `above` has a `path` for each tree."""
    above = above.withColumn("pos", F.lit(0).cast("long"))
    for nodes in reversed(tiers[:-1]):
        upper = above.select("tree", F.col("pos").alias("top"), F.col("path").alias("upper"), "subroot")
        joined = _with_siblings(nodes).join(upper, ["tree", "top"])
        above = joined.withColumn("path", F.concat("steps", "upper")).drop("steps", "upper", "top")
    if len(tiers) == 1:
        above = tiers[0].join(above.select("tree", "path", "subroot"), "tree")
    return above


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf's digest and its path of siblings give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(
    df: DataFrame, columns: Sequence[str], id: str = "doc_id", group: str = "source", altered: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per row of `df`: id, group, `leaf`, `altered_leaf`, `subroot`, `root`, `path`.

    Leaves are digests of the `columns`, sorted by id within their group, null ids first and
    equal ids by digest; groups are sorted by the bytes of their name, rows without one first.
    Repeated rows are leaves of their own. `path` lists the siblings (`left`, `right`) from the
    leaf to the root. `altered` gives columns other values, from which `altered_leaf` is made; without
    it both digests are equal. An empty table has no rows and no root. Other columns are not read.
    """
    altered = altered or {}
    name = F.col(group).cast("string")
    leaves = df.select(
        F.col(id).alias("id"),
        F.col(group).alias("name"),
        F.when(name.isNull(), F.lit(_NONE)).otherwise(F.concat(F.lit(_NAMED), name)).alias("tree"),
        digest(*[field(F.col(column)) for column in columns]).alias("digest"),
        digest(*[field(altered.get(column, F.col(column))) for column in columns]).alias("altered"),
    )
    tiers = _tiers(stored(_placed(leaves, ["id", "digest"]), "positions"))
    subroots = tiers[-1].select("tree", F.col("digest").alias("subroot"))
    names = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("subroot").alias("digest"))
    tops = _tiers(stored(_placed(names, ["of"]), "positions"))
    root = tops[-1].select("digest").first()
    empty = F.array().cast("array<struct<left: string, right: string>>")
    top = _paths(tops, tops[-1].select("tree", empty.alias("path"), F.col("digest").alias("subroot")))
    above = subroots.join(top.select(F.col("of").alias("tree"), "path"), "tree")
    found = _paths(tiers, stored(above, "above"))
    return found.select(
        F.col("id").alias(id),
        F.col("name").alias(group),
        F.col("digest").alias("leaf"),
        F.col("altered").alias("altered_leaf"),
        "subroot",
        F.lit(root[0] if root else None).cast("string").alias("root"),
        "path",
    )
