"""Where data comes from: relational tables, topics and files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

# Schemas of the databases' own tables, in lower case.
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema", "sys")

TABLES_QUERY = "SELECT table_schema, table_name, table_type FROM information_schema.tables"
COLUMNS_QUERY = (
    "SELECT table_schema, table_name, column_name, ordinal_position, data_type, column_default"
    " FROM information_schema.columns"
)


@dataclass(frozen=True)
class Split:
    """A numeric column and bounds that cut a table scan into parallel reads."""

    column: str
    lower: int
    upper: int
    parts: int


def read_jdbc(
    spark: SparkSession, options: Mapping[str, str], table: str, split: Split | None = None
) -> DataFrame:
    """A table over JDBC; `options` holds the URL and the caller's credentials."""
    chosen = {**options, "dbtable": table}
    if split:
        chosen |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
    return spark.read.format("jdbc").options(**chosen).load()


def read_jdbc_query(spark: SparkSession, options: Mapping[str, str], query: str) -> DataFrame:
    out = spark.read.format("jdbc").options(**{**options, "query": query}).load()
    return out.withColumnsRenamed({c: c.lower() for c in out.columns})


def user_schemas_only(df: DataFrame, column: str = "table_schema") -> DataFrame:
    return df.filter(~F.lower(column).isin(*SYSTEM_SCHEMAS))


def base_tables(tables: DataFrame) -> DataFrame:
    """Base tables outside the system schemas, as `table_full`."""
    user = user_schemas_only(tables).filter("table_type = 'BASE TABLE'")
    return user.select(F.concat_ws(".", "table_schema", "table_name").alias("table_full"))


def catalog_from_columns(columns: DataFrame, tables: DataFrame) -> DataFrame:
    """Catalog state of the listed tables from `information_schema.columns` rows."""
    state = columns.select(
        F.concat_ws(".", "table_schema", "table_name").alias("table_full"),
        F.col("column_name").alias("column"),
        F.col("ordinal_position").cast("int").alias("ordinal"),
        "data_type",
        F.col("column_default").cast("string").alias("column_default"),
    )
    return state.join(base_tables(tables), "table_full", "left_semi")


def jdbc_catalog(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return catalog_from_columns(
        read_jdbc_query(spark, options, COLUMNS_QUERY),
        read_jdbc_query(spark, options, TABLES_QUERY),
    )


def catalog_of(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Catalog state of DataFrames, read from their schemas alone."""
    rows = [
        (name, field.name, ordinal, field.dataType.simpleString(), None)
        for name, df in tables.items()
        for ordinal, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_full string, column string, ordinal int, data_type string, column_default string",
    )


def kafka_options(servers: str, pattern: str = ".*", **options: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribePattern": pattern,
        "startingOffsets": "earliest",
        **options,
    }


#: Kafka's number for times set by the broker on append.
LOG_APPEND_TIME = 1
#: The type of a sequence number that holds a time and an offset whole.
SEQUENCE = "decimal(38,0)"
OFFSET_BITS = 63


def topic_sequence(timestamp: Column, offset: Column) -> Column:
    """Milliseconds since 1970 before the whole offset, as one number."""
    milliseconds = F.unix_millis(timestamp).cast("decimal(19,0)")
    return (milliseconds * F.lit(Decimal(2**OFFSET_BITS)) + offset.cast("decimal(19,0)")).cast(SEQUENCE)


def read_topics_stream(
    spark: SparkSession, options: Mapping[str, str], across_topics: bool = False
) -> DataFrame:
    """Envelopes of all matching topics as `value, topic, seq`.

    By default `seq` is the offset, the exact order within a partition; the
    producer has to key its messages by record. Where schema events come on a
    topic of their own, `across_topics` puts the record's time first, so that rows
    before and after a schema event can be told apart to the millisecond; such a
    `seq` is a `SEQUENCE`, which the bronze area has to be told. That time is only
    an order if the topics set it on append (`message.timestamp.type` is
    `LogAppendTime`). Else it is the producer's, and producers' clocks may differ:
    such records are refused when they are read.
    """
    raw = spark.readStream.format("kafka").options(**options).load()
    refused = F.raise_error(F.lit("a record has its producer's time; set message.timestamp.type to LogAppendTime"))
    appended = F.when(F.col("timestampType") == LOG_APPEND_TIME, F.col("timestamp")).otherwise(refused)
    time_first = topic_sequence(appended, F.col("offset"))
    return raw.select(
        F.col("value").cast("string").alias("value"),
        "topic",
        (time_first if across_topics else F.col("offset")).alias("seq"),
    )


def read_lines_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """Envelopes from a folder of JSON lines `{value, seq}` that is still growing."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_table_stream(
    spark: SparkSession, folder: str, file_pattern: str, schema: T.StructType
) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", file_pattern).parquet(folder)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet dataset, or no rows where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_sources(
    spark: SparkSession, paths: Mapping[str, str]
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Each source by name, and the reason for each that cannot be read."""
    found: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for name, path in paths.items():
        try:
            found[name] = spark.read.parquet(path)
        except AnalysisException as error:
            failed[name] = error.getCondition() or "UNREADABLE"
    return found, failed
