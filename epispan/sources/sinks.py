"""Writers: columnar tables, CSV and JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DOWNLOAD_FIELDS

BOM = "﻿"


def write_table(
    df: DataFrame, path: str, partitions: list[str], mode: str = "overwrite", rebalance: bool = True
) -> DataFrame:
    """Zstandard Parquet partitioned by ``partitions``; only partitions present in ``df`` are replaced.

    Rebalancing gathers each partition's rows into files of even size and splits a
    partition that holds most of them. Turn it off for input that already comes
    one file per partition, such as a scan of yearly raw files.
    """
    even = df.hint("rebalance", *partitions) if rebalance else df
    (
        even.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str, fields: list[str], public: bool = False) -> None:
    """CSV in a fixed field order; public files start with a byte-order mark for spreadsheets."""
    chosen = df.select(*fields)
    if public:
        chosen = chosen.withColumnRenamed(fields[0], BOM + fields[0])
    chosen.write.mode("overwrite").csv(path, header=True, encoding="UTF-8")


def write_public_download(observations: DataFrame, path: str) -> None:
    write_csv(observations, path, DOWNLOAD_FIELDS, public=True)


def write_json_per_key(df: DataFrame, path: str, key: str, order: list[str]) -> None:
    """One folder of JSON lines per key, in a stable order; no document is built in memory."""
    df.hint("rebalance", key).sortWithinPartitions(key, *order).write.mode("overwrite").partitionBy(key).json(path)


def write_documents(df: DataFrame, path: str, key: str) -> DataFrame:
    """One JSON document per row, each alone in the folder of its key: ``key=value/part-….json``."""
    df.repartition(key).write.mode("overwrite").partitionBy(key).json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def nested_documents(df: DataFrame, keys: list[str], order: list[str], name: str = "observations") -> DataFrame:
    """One nested record per key. Choose keys that bound the list, such as indicator and period."""
    fields = [c for c in df.columns if c not in keys]
    ordered = F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order])))
    return df.groupBy(*keys).agg(ordered.alias(name))
