"""Index snapshots as a file stream: every new snapshot brings the store up to date (optional part of §2.12)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def follow_index(spark: SparkSession, folder: str, schema: str, checkpoint: str, update: Callable[[int, DataFrame], None], year: str = "rok"):
    """Run ``update(year, sheets)`` for each year of each new snapshot below ``folder``; ends when all are read.

    One snapshot is one batch, so a batch is a whole sheet list; updates are idempotent, as a batch may come twice.
    """

    def apply(batch: DataFrame, _: int) -> None:
        for row in batch.select(year).distinct().orderBy(year).collect():
            update(row[0], batch.where(batch[year] == row[0]))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
