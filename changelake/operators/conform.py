"""Sources brought to one target schema and put together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions import cleaners
from changelake.operators.evolve import SUFFIX
from changelake.session import small_methods

CLEANERS = {
    "raw": lambda c: c,
    "ws": cleaners.clean_whitespace,
    "code": cleaners.clean_code,
    "number": cleaners.clean_number,
    "date": cleaners.clean_date,
    "int": lambda c: c.try_cast("int"),
}


@dataclass(frozen=True)
class Target:
    """A target column: its source column and cleaner, or null where it has none."""

    name: str
    kind: str = "string"
    source: str | None = None
    cleaner: str = "raw"


def conform(df: DataFrame, spec: Sequence[Target]) -> DataFrame:
    """The target columns of `spec`, each cast to its declared type."""
    small_methods(df.sparkSession)

    def column(target: Target) -> Column:
        if target.source is None:
            value = F.lit(None)
        else:
            value = F.col(f"`{target.source}`")
            typed = df.schema[target.source].dataType
            if target.cleaner == "date" and isinstance(
                typed, (T.DateType, T.TimestampType, T.TimestampNTZType)
            ):
                value = F.date_format(value, "dd-MM-yyyy")
            else:
                value = CLEANERS[target.cleaner](value)
        return value.cast(target.kind).alias(target.name)

    return df.select([column(t) for t in spec])


def union_conformed(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """All rows by column name; the inputs must already have equal types."""
    kinds = {f.name: f.dataType for f in first.schema.fields}
    for df in rest:
        if {f.name: f.dataType for f in df.schema.fields} != kinds:
            raise ValueError("conform the inputs to one schema before their union")
        first = first.unionByName(df)
    return first


def append_evolve(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows over the union of the columns, in name order; absent ones are null."""
    out = existing.unionByName(incoming, allowMissingColumns=True)
    return out.select([F.col(f"`{c}`") for c in sorted(out.columns)])


def deletion_flag(column: Column) -> Column:
    """A soft-delete flag as boolean, from boolean or text; unknown text is null."""
    text = F.lower(cleaners.strip(column.cast("string")))
    return F.when(text == "true", True).when(text == "false", False)


def filter_soft_deleted(df: DataFrame, flag: str = "deleted") -> DataFrame:
    if flag not in df.columns:
        return df
    return df.filter(~F.coalesce(deletion_flag(F.col(flag)), F.lit(False)))


def prune_soft_dropped(df: DataFrame, flag: str = "deleted") -> DataFrame:
    """Without the flag and the columns that a schema event dropped."""
    kept = [c for c in df.columns if c.lower() != flag and not c.lower().endswith(SUFFIX)]
    return df.select([F.col(f"`{c}`") for c in kept])


def drop_soft_deleted(df: DataFrame) -> DataFrame:
    """Live rows first, then live columns: the flag must still be there to test."""
    return prune_soft_dropped(filter_soft_deleted(df))
