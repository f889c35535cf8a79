"""The current book over a stream of trades: Structured Streaming keeps one state row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators.book import KEYS, priced


def trade_stream(spark: SparkSession, folder: str, schema, per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def live_positions(tape: DataFrame, terms: DataFrame) -> DataFrame:
    """Running sums per key; write it in update or complete mode."""
    return priced(tape, terms).groupBy(*KEYS).agg(F.sum("qty").alias("position"), F.round(F.sum("pv"), 2).alias("pv"))
