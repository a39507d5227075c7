"""Incremental loading: new files are merged into the catalogue as they land.

The stream only watches the folder; each micro-batch is merged by the same
snapshot operators as a full load, and a batch that is run twice changes
nothing, so at-least-once delivery is enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.store import Store


def merge_stream(source: DataFrame, store: Store, name: str, keys: Sequence[str], checkpoint: str, replace: bool = True):
    """Starts a query that merges ``source`` into a table of the store; ``replace`` says whether new rows replace old ones."""
    return source.writeStream.foreachBatch(lambda batch, _: store.merge(name, batch, keys, replace) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def watch_parquet(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def distinct_stream(source: DataFrame, key: str, at: str, late: str = "1 hour") -> DataFrame:
    """Rows whose key was not seen before, within a watermark that bounds the state."""
    return source.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(source: DataFrame, at: str, by: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    return source.withWatermark(at, late).groupBy(F.window(at, window), by).agg(F.count("*").alias("n_rows"))
