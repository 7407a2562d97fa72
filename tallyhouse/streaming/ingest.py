"""Streaming ingest: every new file exactly once into a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    fmt: str = "parquet",
    name_filter: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """New files of a folder as a stream with a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(folder)


def ingest_files(stream: DataFrame, target: str, checkpoint: str, time_column: str) -> StreamingQuery:
    """Append a stream to a table partitioned by load day; the checkpoint makes re-runs exact."""
    dated = stream.withColumn("load_date", F.to_date(time_column))
    return (
        dated.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .partitionBy("load_date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
