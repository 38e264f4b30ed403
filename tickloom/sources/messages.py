"""Where messages come from: a Kafka topic, or files in the same row shape."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickloom.schemas import MESSAGE_SCHEMA


@dataclass(frozen=True)
class MessageSource:
    """A format with its options, readable as a stream or as a batch."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    batch_options: dict[str, str] = field(default_factory=dict)
    #: Where a batch read starts if given a time: the option's name for this format.
    start_option: str | None = None
    schema: T.StructType | None = None

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.format(self.format).options(**self.options)
        return (reader.schema(self.schema) if self.schema else reader).load()

    def batch(self, spark: SparkSession, since_ms: int | None = None) -> DataFrame:
        """All messages, or where the source can tell those from a time on."""
        options = self.options | self.batch_options
        if since_ms is not None and self.start_option:
            options = {k: v for k, v in options.items() if k != "startingOffsets"} | {self.start_option: str(since_ms)}
        reader = spark.read.format(self.format).options(**options)
        return (reader.schema(self.schema) if self.schema else reader).load()


def kafka_messages(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **options: str,
) -> MessageSource:
    """A topic, by default from its end and tolerating expired offsets.

    A batch read starts from the earliest offset, since "latest" would be
    empty, or from a time. ``minPartitions`` or ``maxOffsetsPerTrigger`` go in ``options``.
    """
    return MessageSource(
        format="kafka",
        options={
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower(),
            **options,
        },
        batch_options={"startingOffsets": "earliest"},
        start_option="startingTimestamp",
    )


def file_messages(path: str, format: str = "parquet", schema: T.StructType = MESSAGE_SCHEMA, **options: str) -> MessageSource:
    """Files holding messages; ``maxFilesPerTrigger`` sets the batch size of a stream."""
    return MessageSource(format=format, options={"path": path, **options}, schema=schema)

