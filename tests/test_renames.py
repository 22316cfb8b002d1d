"""Renamed tables are confirmed on their columns."""

from pyspark.sql import functions as F

from changelake.operators import drift

CATALOG = "table_full string, column string, ordinal int, data_type string, column_default string"


def catalog(spark, **tables):
    rows = [(name, column, i, kind, default) for name, columns in tables.items() for i, (column, kind, default) in enumerate(columns)]
    return spark.createDataFrame(rows, CATALOG)


def changes(spark, old, new):
    return {tuple(row) for row in drift.table_changes(catalog(spark, **old), catalog(spark, **new)).collect()}


A, B, C = [("id", "int", None), ("x", "text", None)], [("id", "int", None), ("y", "text", None)], [("id", "int", "0"), ("x", "text", None)]


def test_equal_fingerprints_of_other_columns_pair_nothing(spark, monkeypatch):
    monkeypatch.setattr(drift, "_fingerprint", lambda seed: F.lit(1).cast("decimal(20,0)"))
    assert changes(spark, {"a": A}, {"b": B}) == {("a", None), (None, "b")}
    assert changes(spark, {"a": A}, {"c": C}) == {("a", None), (None, "c")}
    assert changes(spark, {"a": A}, {"a2": A}) == {("a", "a2")}
    assert changes(spark, {"a": A, "k": B}, {"k": B}) == {("a", None)}


def test_equal_columns_are_a_rename(spark):
    assert changes(spark, {"a": A, "b": B, "gone": A + B}, {"a2": A, "b2": B, "new": C}) == {("a", "a2"), ("b", "b2"), ("gone", None), (None, "new")}
    # Of several alike each goes with one.
    found = changes(spark, {"a": A, "b": A, "c": A}, {"d": A, "e": A})
    assert len(found) == 3 and {new for _, new in found} == {"d", "e", None} and {old for old, _ in found} == {"a", "b", "c"}
