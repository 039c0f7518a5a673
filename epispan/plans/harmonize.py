"""Whole folders of yearly raw files, whatever their layouts, to one harmonised table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import DEATH_OPTIONAL, DEATH_REQUIRED, Territory
from ..functions.text import year_in_name
from ..session import dimension, materialize
from ..sources.files import csv_headers, list_files, scan_archives
from ..sources.microdata import harmonize_deaths, scan_death_csv
from ..sources.provenance import upsert_manifest
from ..sources.sinks import write_table


def _chosen(files: DataFrame, years: list[int] | None) -> DataFrame:
    return files if years is None else files.where(year_in_name(F.element_at(F.split("path", "/"), -1)).isin(years))


def files_by_layout(files: DataFrame) -> list[list[str]]:
    """Paths of listed text files, grouped by their header line; a reader takes each group as one scan."""
    groups = csv_headers(files).groupBy("header").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    return [r["paths"] for r in groups.orderBy("paths").collect()]


def harmonize_death_files(
    spark: SparkSession, path: str | list[str], territory: Territory, year: Column | None = None, years: list[int] | None = None,
    numbered: bool = False,
) -> DataFrame:
    """All CSV files and zip archives at ``path``, harmonised and put together; with ``years``, only files named after one.

    CSV files of one layout are one scan, archives another, so the plan grows with the layouts and not
    with the files. Optional fields a layout lacks are empty; a file without a required field raises.
    """
    files = _chosen(list_files(spark, path), years)
    zipped = F.lower("path").endswith(".zip")
    tables = [
        harmonize_deaths(scan_death_csv(spark, paths, numbered), territory, year) for paths in files_by_layout(files.where(~zipped))
    ]
    archives = [r["path"] for r in files.where(zipped).orderBy("path").collect()]
    if archives:
        tables.append(harmonize_deaths(scan_archives(spark, archives, DEATH_REQUIRED + DEATH_OPTIONAL, DEATH_REQUIRED), territory, year))
    if not tables:
        raise FileNotFoundError(f"no death file to read at {path}")
    return reduce(lambda a, b: a.unionByName(b), tables)


def run_years(harmonized: DataFrame, target: str, manifest: DataFrame | None) -> DataFrame:
    """Write harmonised years, replacing only those present, and return the manifest with their new entries.

    The write itself observes which years it holds, so the raw files are read once; the entries (files,
    rows and residents of the selected city) are counted from the table just written, from three of
    its columns and those years alone.
    """
    seen = Observation("years")
    years = F.collect_set(F.struct("source", F.col("source_year").cast("int").alias("source_year")))
    written = write_table(harmonized.observe(seen, years.alias("years")), target, ["source", "source_year"])
    keys = dimension(harmonized.sparkSession, [tuple(y) for y in seen.get["years"]], "source string, source_year int")
    entries = written.join(keys, ["source", "source_year"], "left_semi").groupBy("source", "source_year").agg(
        F.array_sort(F.collect_set("source_file")).alias("source_files"), F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("residence_is_vr"), F.lit(1))).alias("city_rows"),
    )
    entries = materialize(entries, "harmonized-entries")
    return entries if manifest is None else upsert_manifest(manifest, entries, ["source", "source_year"])


def harmonize_folder(
    spark: SparkSession, path: str | list[str], territory: Territory, target: str, manifest_path: str, years: list[int] | None = None,
) -> DataFrame:
    """Harmonise the files at ``path`` into the table ``target`` and keep its manifest at ``manifest_path``.

    Both are partitioned by source and year, and a run replaces the partitions of the years it read:
    entries and rows of other years stay as they are. Returns the whole manifest.
    """
    entries = run_years(harmonize_death_files(spark, path, territory, years=years), target, None)
    return write_table(entries, manifest_path, ["source", "source_year"], rebalance=False)
