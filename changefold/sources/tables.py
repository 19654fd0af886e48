"""Tables as streams. A target is a catalog table name, or a path where it contains a slash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


#: A file's greatest age for a stream to read it: beyond any.
NO_AGE = "36500d"


def is_path(target: str) -> bool:
    return "/" in target


def read_table_stream(spark: SparkSession, target: str, schema: str, **options: object) -> DataFrame:
    reader = spark.readStream.options(**{"maxFileAge": NO_AGE, **options})
    return reader.schema(schema).parquet(target) if is_path(target) else reader.table(target)


def read_table(spark: SparkSession, target: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(target) if is_path(target) else spark.read.table(target)


def start_append(writer: DataStreamWriter, target: str) -> StreamingQuery:
    writer = writer.format("parquet").outputMode("append")
    return writer.start(target) if is_path(target) else writer.toTable(target)
