"""Monthly counts kept up to date as new harmonised files arrive.

Raw files are large and come one release at a time. The monthly counts are sums,
so each file can be counted when it lands and only the small totals are merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def count_new_files(
    spark: SparkSession, source: str, schema: StructType, count: Callable[[DataFrame], DataFrame], output: str,
    checkpoint: str,
) -> StreamingQuery:
    """Count each new file once and write its totals under its own batch folder.

    A batch that is retried after a lost driver overwrites its own folder, so no
    file counts twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        count(batch).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(source)
    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def merged_counts(spark: SparkSession, output: str, keys: list[str], values: list[str]) -> DataFrame:
    """Totals over every batch counted so far."""
    return spark.read.parquet(output).groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
