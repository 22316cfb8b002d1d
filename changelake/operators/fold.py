"""Change events folded into current state, and the log of what they changed.

The state after any number of events follows from a few running values per key:
the first event that is not a delete, the last delete, the last insert, and the
last image. Each is a minimum, a maximum or a last value, so the fold combines
partial results in any order and a key with very many events stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.operators.scan import BITS, levels_for, prefix_scan

CHANGE_OPERATIONS = ("INITIAL_LOAD", "INSERT", "UPDATE", "DELETE")
BASE = "BASE"
STATE_COLUMNS = ("_operation", "_seq", "deleted")

_STATES = {
    "_first": "min",
    "_delete": "max",
    "_insert": "max",
    "_flag": "last",
    "_image": "last",
}


def _with_states(
    events: DataFrame,
    key: Sequence[str],
    seq: str,
    op: str,
    image: Sequence[str],
    base: DataFrame | None,
) -> DataFrame:
    """Events, and rows of the base state, as the values the fold works on."""
    # Smaller integers are widened, so that a stored base fits later events.
    wide = "bigint" if events.schema[seq].dataType.typeName() in ("byte", "short", "integer") else events.schema[seq].dataType
    operation, order = F.col(op), F.col(seq).cast(wide)
    none = F.lit(None).cast(wide)
    is_delete = operation == "DELETE"
    columns = F.struct(
        order.alias("seq"), operation.alias("operation"), *[F.col(c) for c in image]
    )
    rows = events.withColumns(
        {
            "_order": order,
            "_op": operation,
            "_first": F.when(~is_delete, order),
            "_delete": F.when(is_delete, order),
            "_insert": F.when(operation.isin("INSERT", "INITIAL_LOAD"), order),
            "_flag": F.lit(None).cast("boolean"),
            "_image": F.when(~is_delete, columns),
        }
    )
    if base is None:
        return rows
    kept = F.struct(
        F.col("_seq").alias("seq"),
        F.col("_operation").alias("operation"),
        *[F.col(c) for c in image],
    )
    stored = base.select(
        *key,
        F.col("_seq").alias("_order"),
        F.lit(BASE).alias("_op"),
        F.col("_seq").alias("_first"),
        none.alias("_delete"),
        none.alias("_insert"),
        F.col("deleted").alias("_flag"),
        kept.alias("_image"),
    )
    return rows.unionByName(stored, allowMissingColumns=True)


def _deleted(suffix: str = "") -> Column:
    """Whether the key is deleted, from its running values."""
    first, delete = F.col(f"_first{suffix}"), F.col(f"_delete{suffix}")
    insert, flag = F.col(f"_insert{suffix}"), F.col(f"_flag{suffix}")
    counts = (delete > first) & (insert.isNull() | (delete > insert))
    return (
        F.when(counts, True)
        .when(insert.isNotNull(), False)
        .otherwise(F.coalesce(flag, F.lit(False)))
    )


def fold_state(
    events: DataFrame,
    key: Sequence[str],
    seq: str,
    image: Sequence[str],
    op: str = "operation",
    base: DataFrame | None = None,
) -> DataFrame:
    """Current row per key with `_operation`, `_seq` and `deleted`.

    `INSERT` and `INITIAL_LOAD` put a live row, `UPDATE` replaces the row and
    leaves its flag, `DELETE` flags a row that exists and is ignored otherwise.
    `base` is an earlier result of this function; `events` must then be later.
    Also takes a streaming DataFrame, whose state Spark then keeps per key.
    """
    rows = _with_states(events, key, seq, op, image, base)
    state = rows.groupBy(*key).agg(
        F.min("_first").alias("_first"),
        F.max("_delete").alias("_delete"),
        F.max("_insert").alias("_insert"),
        F.max("_flag").alias("_flag"),
        F.max_by("_image", F.col("_first")).alias("_image"),
    )
    return finished(state, key, image)


def finished(state: DataFrame, key: Sequence[str], image: Sequence[str]) -> DataFrame:
    """Rows of the state from the running values `_first`, `_delete`, `_insert`, `_flag` and `_image`."""
    deleted_last = F.col("_delete") > F.col("_image.seq")
    return state.filter("_first IS NOT NULL").select(
        *key,
        *[F.col(f"_image.{c}").alias(c) for c in image],
        F.when(deleted_last, "DELETE").otherwise(F.col("_image.operation")).alias("_operation"),
        F.greatest("_image.seq", F.when(deleted_last, F.col("_delete"))).alias("_seq"),
        _deleted().alias("deleted"),
    )


def change_log(
    events: DataFrame,
    key: Sequence[str],
    seq: str,
    image: Sequence[str],
    op: str = "operation",
    base: DataFrame | None = None,
    keep: Sequence[str] = (),
    bits: int = BITS,
    levels: int | None = None,
) -> DataFrame:
    """`before` and `after` image of the row that each event meets.

    Without `levels`, the events of each key are counted first, which runs a job.

    An image holds the columns of the row and its `deleted` flag, and is null
    where the row does not exist. `keep` names further event columns to return.
    """
    rows = _with_states(events, key, seq, op, image, base)
    rows = rows.select(*key, "_order", "_op", *keep, *_STATES)
    levels = levels_for(events, key) if levels is None else levels
    scanned = prefix_scan(rows, key, "_order", _STATES, bits, levels)

    def image_at(side: str) -> Column:
        values = [F.col(f"_image_{side}.{c}").alias(c) for c in image]
        row = F.struct(*values, _deleted(f"_{side}").alias("deleted"))
        return F.when(F.col(f"_first_{side}").isNotNull(), row)

    return scanned.filter(F.col("_op") != BASE).select(
        *key,
        F.col("_order").alias(seq),
        F.col("_op").alias(op),
        *keep,
        image_at("before").alias("before"),
        image_at("after").alias("after"),
    )


def compact(
    base: DataFrame | None,
    events: DataFrame,
    key: Sequence[str],
    seq: str,
    image: Sequence[str],
    op: str = "operation",
) -> DataFrame:
    """Base state with later events folded in; serves as the next base."""
    return fold_state(events, key, seq, image, op, base)
