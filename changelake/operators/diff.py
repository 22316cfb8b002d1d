"""Changes between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.keys import row_id

ROW_ID = "_row_id"


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by `order`, then by the other columns.

    An aggregate rather than a window: each task reduces its own rows first, so
    a key that repeats often costs one row per task in the shuffle.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    greatest = F.max(F.struct(*order, *rest)).alias("_row")
    out = df.groupBy(*key).agg(greatest)
    return out.select([F.col(c) if c in key else F.col(f"_row.{c}") for c in df.columns])


def identified(
    df: DataFrame, key: str | None, order: Sequence[str] = (), unique: bool = False
) -> DataFrame:
    """Snapshot rows with their `_row_id`, one row for each.

    Where `unique` says the key repeats nowhere, the reduction is left out.
    """
    rows = df.withColumn(ROW_ID, row_id(df.columns, key))
    return rows if unique else last_wins(rows, [ROW_ID], order)


def _flat(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(
        ROW_ID,
        F.lit(True).alias(f"{prefix}present"),
        *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != ROW_ID],
    )


def _differs(columns: Sequence[str], left: str, right: str) -> Column:
    tests = [~F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}")) for c in columns]
    return reduce(or_, tests, F.lit(False))


def _common(prev: DataFrame, cur: DataFrame) -> list[str]:
    return [c for c in prev.columns if c in cur.columns]


def snapshot_diff(
    prev: DataFrame,
    cur: DataFrame,
    key: str | None = None,
    order: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """`_row_id, operation, before, after` of each row that differs.

    A row of both snapshots is an update if a column that both have differs;
    null equals null. Both sides are shuffled once, on the row id, which also
    serves to reduce repeated ids.
    """
    return compared_rows(identified(prev, key, order, unique), identified(cur, key, order, unique), prev, cur)


def compared_rows(old: DataFrame, new: DataFrame, prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Changes between rows with distinct ids, in the columns of the snapshots."""
    left, right = _flat(old, "p_"), _flat(new, "c_")
    operation = (
        F.when(F.col("p_present").isNull(), "INSERT")
        .when(F.col("c_present").isNull(), "DELETE")
        .when(_differs(_common(prev, cur), "p_", "c_"), "UPDATE")
    )

    def image(df: DataFrame, prefix: str) -> Column:
        columns = [F.col(f"{prefix}{c}").alias(c) for c in df.columns]
        return F.when(F.col(f"{prefix}present"), F.struct(*columns))

    return (
        left.join(right, ROW_ID, "full_outer")
        .withColumn("operation", operation)
        .filter("operation IS NOT NULL")
        .select(
            ROW_ID,
            "operation",
            image(prev, "p_").alias("before"),
            image(cur, "c_").alias("after"),
        )
    )


#: Hashes of a whole row, which choose between rows of one id, and of the columns compared.
_HASHES = ("_hash1", "_hash2")
_SAME = ("_same1", "_same2")


def _digest(df: DataFrame, columns: Sequence[str], names: Sequence[str] = _HASHES) -> DataFrame:
    """Add two independent 64-bit hashes of `columns`, which tell null from absent text."""
    flags = [F.col(c).isNull() for c in columns]
    values = [F.col(c) for c in columns]
    return df.withColumns({name: F.xxhash64(F.lit(seed), *values, *flags) for seed, name in enumerate(names, start=1)})


def _hashed(df: DataFrame, key: str | None) -> DataFrame:
    return _digest(df.withColumn(ROW_ID, row_id(df.columns, key)), df.columns)


def briefed(df: DataFrame, key: str | None, common: Sequence[str], order: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Ids, order columns and hashes of the rows, one for each id; no other column is shuffled."""
    if list(common) == df.columns:
        # The hashes that choose between rows of one id are those of the columns compared.
        rows = _hashed(df, key).select(ROW_ID, *order, *_HASHES)
        rows = rows if unique else last_wins(rows, [ROW_ID], [*order, *_HASHES])
        return rows.withColumns({same: F.col(chosen) for same, chosen in zip(_SAME, _HASHES)})
    rows = _digest(_hashed(df, key), common, _SAME).select(ROW_ID, *order, *_HASHES, *_SAME)
    return rows if unique else last_wins(rows, [ROW_ID], [*order, *_HASHES])


def last_by_hash(rows: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One row per `_row_id`: the one that `briefed` takes of several."""
    hashed = _digest(rows, [c for c in rows.columns if c != ROW_ID])
    return last_wins(hashed, [ROW_ID], [*order, *_HASHES]).drop(*_HASHES)


def snapshot_diff_narrow(
    prev: DataFrame, cur: DataFrame, key: str, folder: str, order: Sequence[str] = (), unique: bool = False
) -> DataFrame:
    """`snapshot_diff` for wide tables of which few rows change.

    The first pass shuffles only row ids, order columns and hashes, and stores the ids that
    differ in `folder`. The full rows of those ids come from a second scan. As the size of
    the stored ids is known, Spark broadcasts them while they are few, and then shuffles no
    unchanged row; else it joins by shuffle.

    Of rows with the same id, the greatest by `order` counts, then the one with the greatest
    hash, in both passes. A change goes unseen if the old and new row agree in 128 bits of
    hash, with odds of 2^-128 for a changed row.
    """
    common = _common(prev, cur)
    old, new = (briefed(df, key, common, order, unique) for df in (prev, cur))
    sides = [df.select(ROW_ID, F.struct(*_SAME).alias(side)) for df, side in ((old, "p"), (new, "c"))]
    differing = sides[0].join(sides[1], ROW_ID, "full_outer").filter(~F.col("p").eqNullSafe(F.col("c")))
    differing.select(ROW_ID).write.parquet(folder)
    changed = prev.sparkSession.read.parquet(folder)

    def only_changed(df: DataFrame) -> DataFrame:
        rows = _hashed(df, key).join(changed, ROW_ID, "left_semi")
        rows = rows if unique else last_wins(rows, [ROW_ID], [*order, *_HASHES])
        return rows.drop(*_HASHES)

    return compared_rows(only_changed(prev), only_changed(cur), prev, cur)


def snapshot_inserts(
    prev: DataFrame, cur: DataFrame, key: str | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Rows of `cur` whose id `prev` lacks."""
    ids = prev.select(row_id(prev.columns, key).alias(ROW_ID)).distinct()
    return identified(cur, key, order).join(ids, ROW_ID, "left_anti")


def snapshot_deletes(
    prev: DataFrame, cur: DataFrame, key: str | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Rows of `prev` whose id `cur` lacks."""
    return snapshot_inserts(cur, prev, key, order)


def snapshot_updates(
    prev: DataFrame, cur: DataFrame, key: str | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Rows of `cur` that differ from the row of `prev` with the same id."""
    left = _flat(identified(prev, key, order), "p_")
    right = _flat(identified(cur, key, order), "c_")
    return (
        left.join(right, ROW_ID)
        .filter(_differs(_common(prev, cur), "p_", "c_"))
        .select(ROW_ID, *[F.col(f"c_{c}").alias(c) for c in cur.columns])
    )
