"""Files as they arrive, each once, to the same batch functions; counts in event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def ingest(spark: SparkSession, folder: str, schema: StructType, batch: Callable[[DataFrame, int], None], checkpoint: str, file_format: str = "parquet") -> StreamingQuery:
    """What is there now, in micro-batches; the checkpoint remembers files taken."""
    stream = spark.readStream.format(file_format).schema(schema).load(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, kind: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events by window and kind; what is later than `late` is dropped."""
    stamped = events.withColumn("_time", F.col(time).cast("timestamp"))
    return stamped.withWatermark("_time", late).groupBy(F.window("_time", width), F.col(kind)).agg(F.count("*").alias("n"))
