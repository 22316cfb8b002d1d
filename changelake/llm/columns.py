"""Helpers that the operators share: input columns, stored intermediate tables, batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.session import scratch_dir


#: Rows of an Arrow batch. Spark's default of 10,000 makes tens of megabytes of texts, which
#: the JVM and a Python worker each hold more than once.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared scratch folder and read again, which ends its lineage."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and each row's offsets in them; a null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about `limit` bytes of text at most, or one longer row."""
    for batch in batches:
        data, offsets = bytes_of(batch.column(text))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
            yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_hash(text: str = "text") -> Column:
    """With an id, tells rows apart that share it."""
    return F.xxhash64(F.col(text))


#: Keys of rows to leave out that are sent to all tasks; one takes 17 bytes.
NAMED = 200_000


def chosen(df: DataFrame, decisions: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df`, all columns, that are kept by `decisions` (`id`, `text_hash`, `kept`: one row for each of `df`).

    Of rows alike in id and text all are returned, or none, or one if only some are kept.
    Null ids match null ids. Where few rows go, their keys are sent to all tasks and no text is
    shuffled; else both sides are joined by shuffle.
    """
    number, kept = F.count(F.lit(1)), F.count_if("kept")
    gone = decisions.groupBy("id", "text_hash").agg(number.alias("number"), kept.alias("kept")).filter("kept < number")
    gone = stored(gone, "gone")
    many, partly = gone.agg(F.count(F.lit(1)), F.count_if(F.col("kept") > 0)).first()
    rows = df.select(F.col(id).alias("_id"), text_hash(text).alias("_hash"), F.struct(*[df[name] for name in df.columns]).alias("_row"))

    def joined(keys: DataFrame, how: str) -> DataFrame:
        same = rows["_id"].eqNullSafe(keys["id"]) & (rows["_hash"] == keys["text_hash"])
        return rows.join(F.broadcast(keys) if many <= NAMED else keys, same, how)

    out = joined(gone, "left_anti")
    if partly:
        out = out.unionByName(joined(gone.filter("kept > 0"), "left_semi").dropDuplicates(["_id", "_hash"]))
    return out.select("_row.*")
