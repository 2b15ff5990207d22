"""Reports kept up to date while snapshot files arrive.

The row-wise operators and the joins against a static table work on a stream of snapshot
files as they do on a directory. Sorted or aggregated reports are made per batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def snapshot_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Response bodies as they arrive, one row per file in the column ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path, wholetext=True)


def batch_reports(stream: DataFrame, report: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> DataStreamWriter:
    """Writes ``report`` of every batch as one partition of a Parquet table.

    A batch that is repeated after a failure overwrites its own partition, so that each
    snapshot counts once. ``checkpoint`` must lie in storage that all executors share.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        report(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
