"""The incremental load as a stream over the landing folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstar.plans.warehouse import Warehouse
from sensorstar.sources.landing import LANDING_SCHEMA


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint folder belongs to, kept beside it."""
    path = f"{checkpoint.rstrip('/')}-id"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        spark.range(1).select(F.lit(uuid.uuid4().hex).alias("stream")).write.parquet(path)
    return spark.read.parquet(path).first()["stream"]


def stream_load(
    spark: SparkSession,
    landing_path: str,
    warehouse: Warehouse,
    topic_pattern: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Load every landing file that was not loaded yet, then stop.

    The file source remembers its files in ``checkpoint``; a micro-batch that is
    repeated after a failure has the same number in the same stream, and is skipped
    if its load was finished. Other loads and streams may feed the warehouse before
    and after it. A new checkpoint begins a new stream, which reads all files again.
    """
    source = spark.readStream.schema(LANDING_SCHEMA)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    messages = source.parquet(landing_path).where(F.col("topic").like(topic_pattern))

    stream = stream_id(spark, checkpoint)

    def load(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            warehouse.load_batch(batch, topic_pattern, stream, number)

    query = (
        messages.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
