"""Running values per key that stay balanced when one key holds most rows.

A window partitioned by the key alone would sort a hot key in a single task.
Here the rows of a key are cut into segments of `2 ** bits` consecutive sequence
numbers. A sequence number occurs once per key, so no segment can hold more
rows than that, however the rows spread over keys. Where sequence numbers are
sparse, as those with a time in front are, wider segments hold as few rows. Each segment is summed up
with a partial aggregation, the sums are scanned over the segments in the same
way, and each segment starts from a carry row that holds what came before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 20
LEVELS = 2


def segment(seq: Column, bits: int) -> Column:
    """The first sequence number of the segment, exact for bigint and decimal ones."""
    width = F.lit(2**bits) if bits < 63 else F.lit(Decimal(2**bits))
    return seq - F.pmod(seq, width)


def levels_for(df: DataFrame, key: Sequence[str], rows: int = 2**BITS) -> int:
    """0, a plain window, where no key has more rows than one segment may hold; else all levels.

    Counting the keys reads them alone and is reduced before its shuffle, which costs less
    than the shuffles and sorts of the levels it saves.
    """
    most = df.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    return 0 if most <= rows else LEVELS


def _aggregate(kind: str, name: str, order: str) -> Column:
    value = F.col(name)
    if kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), F.col(order)))
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](value)


def _running(kind: str, name: str) -> Column:
    if kind == "last":
        return F.last(F.col(name), ignorenulls=True)
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](F.col(name))


def prefix_scan(
    df: DataFrame,
    key: Sequence[str],
    seq: str,
    states: dict[str, str],
    bits: int = BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """Add `<state>_before` and `<state>_after` for each row in `seq` order per key.

    `states` maps a column to `sum`, `min`, `max` or `last` (last value that is
    not null). `seq` is a bigint or decimal without fraction that occurs once per
    key. Segments of each further level hold 2^20 of the level before. Two levels
    bound every window group for any spread of a 63-bit sequence.
    """
    if levels == 0:
        return _window(df, list(key), [F.col(seq)], states)

    part = f"_segment{levels}"
    segments = df.withColumn(part, segment(F.col(seq), bits))
    sums = segments.groupBy(*key, part).agg(
        *[_aggregate(kind, name, seq).alias(name) for name, kind in states.items()]
    )
    scanned = prefix_scan(sums, key, part, states, bits + BITS, levels - 1)
    known = F.coalesce(*[F.when(F.col(f"{n}_before").isNotNull(), True) for n in states])
    carry = scanned.filter(known).select(
        *key, part, *[F.col(f"{n}_before").alias(n) for n in states], F.lit(0).alias("_row")
    )
    rows = segments.withColumn("_row", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    out = _window(rows, [*key, part], [F.col("_row"), F.col(seq)], states)
    return out.filter("_row = 1").drop("_row", part)


def _window(
    df: DataFrame, partition: list[str], order: list[Column], states: dict[str, str]
) -> DataFrame:
    window = Window.partitionBy(*partition).orderBy(*order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    after = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "*",
        *[_running(kind, n).over(before).alias(f"{n}_before") for n, kind in states.items()],
        *[_running(kind, n).over(after).alias(f"{n}_after") for n, kind in states.items()],
    )
