"""Message-bus sources (A-3..A-6, A-8, A-9).

``kafka_stream`` / ``kafka_batch`` use Spark's public Kafka source options;
the connector jar must be on the classpath (it is not in this repository's
test environment). ``record_file_stream`` reads files already in the record
shape ``key, value, topic, partition, offset, timestamp`` and stands in for
the bus in tests: everything after the source is the same code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlake.schemas import RECORD


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Subscribe to ``topic`` (A-3, A-4, A-5). ``max_offsets_per_trigger`` bounds a
    micro-batch; ``min_partitions`` splits large topic partitions over more tasks."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def kafka_batch(spark: SparkSession, servers: str, topic: str,
                starting_offsets: str = "earliest", ending_offsets: str = "latest") -> DataFrame:
    """Bounded read of a topic (for peeks and offset counts)."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("endingOffsets", ending_offsets)
            .load())


def record_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files in the record shape, read as a stream."""
    reader = spark.readStream.schema(RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def table_file_stream(spark: SparkSession, directory: str, file_glob: str, schema,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the Parquet files of ``directory`` matching ``file_glob``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(directory)
