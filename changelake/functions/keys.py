"""Names and identities of tables and rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.cleaners import strip


#: Nulls are written, and times whole; by default JSON cuts them to milliseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def normalize_table_name(table: Column) -> Column:
    """Last dotted part of a table name, stripped, in lower case."""
    return F.lower(strip(F.element_at(F.split(table, r"\."), -1)))


def normalize_database(database: Column) -> Column:
    return strip(database)


def row_id(columns: Iterable[str], key: str | None = None) -> Column:
    """The key as text, or the MD5 of the whole row where there is no key.

    The row is hashed as JSON with its columns in name order, so the id does
    not depend on the column order of the source. Only a null or blank key
    counts as missing.
    """
    whole = F.struct(*[F.col(c) for c in sorted(columns)])
    digest = F.md5(F.to_json(whole, JSON_OPTIONS))
    if key is None:
        return digest
    text = F.col(key).cast("string")
    return F.coalesce(F.when(strip(text) != "", text), digest)


def record_id(database: Column, table: Column, identity: Column) -> Column:
    """Database, table and row as one text; names that hold `_` can make two of them alike."""
    return F.concat_ws("_", database, table, identity)


def stringify(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Every column as text; nested values as JSON, null stays null."""
    kept = set(keep)

    def as_text(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if field.name in kept:
            return column
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(column, {**JSON_OPTIONS, "ignoreNullFields": "true"}).alias(field.name)
        return column.cast("string").alias(field.name)

    return df.select([as_text(f) for f in df.schema.fields])
