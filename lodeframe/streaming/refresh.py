"""Optional streaming use: feeds refreshed as files arrive, weekly sums with late data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodeframe.sources.sinks import refresh


def refresh_stream(stream: DataFrame, adapt: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of raw rows replaces its sources' partitions; a repeated batch changes nothing."""
    return stream.writeStream.foreachBatch(lambda df, _: refresh(adapt(df), path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def weekly_sums(stream: DataFrame, at: str, value: str, kind: str, late: str = "7 days") -> DataFrame:
    """Sums per week and kind; rows later than the watermark are left out. Weeks begin on Monday."""
    week = F.window(at, "7 days", "7 days", "4 days")
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(week.alias("week"), kind).agg(F.sum(value).alias("total")).select(F.col("week.start").cast("date").alias("week"), kind, "total")


def latest_sums(sums: DataFrame, path: str, checkpoint: str, keys: Sequence[str]) -> StreamingQuery:
    """Writes the sums that each micro-batch changed, with its number; a repeated batch replaces what it wrote."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return sums.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last state of each key that latest_sums() wrote."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in (*keys, "batch")]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("s")).select(*keys, "s.*")
