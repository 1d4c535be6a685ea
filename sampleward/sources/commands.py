"""Command messages: base64 JSON payloads with an ISO publish time, from a stream or a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleward.functions.text import iso_to_epoch

MESSAGE = "data string, publish_time string"


def read_messages(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of messages from a folder of JSON lines."""
    return (
        spark.readStream.schema(MESSAGE)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )


def command_stream(
    messages: DataFrame, data: str = "data", publish_time: str = "publish_time"
) -> DataFrame:
    """Add `payload` (text), `document` (parsed) and `timestamp` (epoch seconds).

    Works on a stream and on a table alike. Bad base64, bad UTF-8 and bad JSON give nulls.
    """
    text = F.try_validate_utf8(F.try_to_binary(F.col(data), F.lit("base64")).cast("string"))
    return (
        messages.withColumn("payload", text)
        .withColumn("document", F.try_parse_json(F.col("payload")))
        .withColumn("timestamp", iso_to_epoch(F.col(publish_time)))
    )
