"""The row-wise stages on streams: the same expressions, no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom.functions import signals, text
from qaloom.operators import filters


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    """A stream of the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def filter_stream(stream: DataFrame, question: str = "question", answer: str = "answer") -> DataFrame:
    """Stage 1 on a stream: normalised questions that stay."""
    return filters.keep(filters.clean(stream, question, answer))


def signal_stream(stream: DataFrame, answer: str = "answer") -> DataFrame:
    """The answer's signals on a stream."""
    return stream.withColumn("signals", signals.signals(text.normalize(F.col(answer))))


def run_once(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes all that is there, exactly once across restarts, and stops."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
