"""Checksums, manifests, extraction logs and raw-file checks."""

from __future__ import annotations

import gzip
import io
import json
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import DEATH_REQUIRED, EXTRACTION_LOG_FIELDS, PAGE_MARKS, REGISTRY_FIELD
from .files import (
    HEADER_BYTES, UNREADABLE, archive_format, columnar_format, csv_headers, csv_members, document_format, file_digests, file_verdicts,
    header_format, json_format, line_fields, list_files, open_file, page_format, parquet_footers, per_file, shape_format,
)


def checksum_manifest(files: DataFrame) -> DataFrame:
    """Size and SHA-256 of (path, content) rows."""
    return files.select(
        "path", F.length("content").cast("long").alias("bytes"), F.sha2(F.col("content").cast("binary"), 256).alias("sha256")
    )


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def scan_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Declared digests from ``name.ext.sha256`` files, keyed by the path they describe."""
    first = F.element_at(F.split(F.trim("value"), r"\s+"), 1)
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.regexp_replace(F.col("_metadata.file_path"), r"\.sha256\z", "").alias("path"), first.alias("declared")
    )


def sidecar_status(manifest: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Whether each file's digest equals its sidecar; files without one are named."""
    same = F.col("declared") == F.col("sha256")
    state = F.when(F.col("declared").isNull(), F.lit("missing_sha256_sidecar")).when(same, F.lit("ok"))
    joined = manifest.join(sidecars, "path", "left")
    return joined.withColumn("hash_ok", F.coalesce(same, F.lit(False))).withColumn(
        "hash_status", state.otherwise(F.lit("sha256_mismatch"))
    )


def append_extraction_log(entries: DataFrame, path: str) -> None:
    """Append provenance rows in the fixed field order; absent values are empty text."""
    row = [
        (F.coalesce(F.col(f).cast("string"), F.lit("")) if f in entries.columns else F.lit("")).alias(f)
        for f in EXTRACTION_LOG_FIELDS
    ]
    entries.select(*row).write.mode("append").csv(path, header=True)


def status_histogram(log: DataFrame) -> DataFrame:
    state = F.when(F.coalesce(F.col("status"), F.lit("")) == "", F.lit("empty")).otherwise(F.col("status"))
    return log.groupBy(state.alias("status")).agg(F.count(F.lit(1)).alias("entries"))


def upsert_manifest(existing: DataFrame, updates: DataFrame, key: str | list[str]) -> DataFrame:
    """Entries of a re-run replace their old ones; every other entry stays."""
    keys = [key] if isinstance(key, str) else key
    return existing.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def header_fields(heads: DataFrame, separator: str = ";") -> DataFrame:
    """(source_file, header line) to one row per field name."""
    names = F.transform(F.split(F.col("header"), separator), lambda n: F.trim(F.translate(n, '"', "")))
    return heads.select("source_file", F.explode(names).alias("field"))


def scan_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source_file, header) of every text file, in one scan however many they are."""
    return csv_headers(list_files(spark, path)).withColumnRenamed("path", "source_file")


def layout_audit(spark: SparkSession, path: str, required: list[str], separator: str = ";") -> DataFrame:
    """Per CSV file: number of columns, required fields it lacks (sorted) and rows below the header."""
    named = header_fields(scan_headers(spark, path), separator)
    columns = named.groupBy("source_file").agg(F.count(F.lit(1)).cast("int").alias("columns"), F.collect_set("field").alias("_fields"))
    missing = F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), "_fields"))
    lines = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count(F.lit(1)).alias("_lines"))
    plain = F.regexp_replace(F.col("source_file"), r"\A\w+:/*", "/")
    joined = columns.withColumn("_key", plain).join(lines.select(F.regexp_replace("_path", r"\A\w+:/*", "/").alias("_key"), "_lines"), "_key", "left")
    return joined.select("source_file", "columns", missing.alias("missing"), (F.coalesce("_lines", F.lit(1)) - 1).alias("rows"))


def archive_layout(files: DataFrame, required: list[str], separator: str = ";") -> DataFrame:
    """Header audit of listed zip archives: one row per CSV member, only its first line is read.

    Columns: path, member, columns, missing (sorted), error. An archive without a CSV member, or one
    that cannot be opened, is one row that says so.
    """
    def describe(path: str, _: int) -> Iterator[dict]:
        try:
            with open_file(path) as handle, zipfile.ZipFile(handle) as archive:
                members = csv_members(archive)
                if not members:
                    yield {"path": path, "error": "no_csv_member"}
                for member in members:
                    with archive.open(member) as opened:
                        fields = set(line_fields(opened.readline(HEADER_BYTES).decode("latin1"), separator))
                    lacking = sorted(set(required) - fields)
                    error = f"{member}:missing:{','.join(lacking)}" if lacking else None
                    yield {"path": path, "member": member, "columns": len(fields), "missing": lacking, "error": error}
        except UNREADABLE as error:
            yield {"path": path, "error": type(error).__name__}

    return per_file(files, describe, "path string, member string, columns int, missing array<string>, error string")


def parquet_layout(spark: SparkSession, path: str | list[str], required: list[str], optional: list[str]) -> DataFrame:
    """Per Parquet file: columns, required and optional fields it lacks, rows and error, all from footers."""
    names = F.transform("fields", lambda f: f["name"])

    def lacking(wanted: list[str]) -> Column:
        return F.array_sort(F.array_except(F.array(*[F.lit(w) for w in wanted]), names))

    footers = parquet_footers(list_files(spark, path))
    return footers.select(
        F.col("path").alias("source_file"), F.size(names).alias("columns"), lacking(required).alias("missing"),
        lacking(optional).alias("missing_optional"), "rows", "error",
    )


# --- Raw-file formats: each suffix has one test, most of them plain expressions over the bytes.

def _latin1(content: Column) -> Column:
    return F.decode(content, "ISO-8859-1")


def _csv_problem(content: Column) -> Column:
    header = F.element_at(F.split(_latin1(content), "\n"), 1)
    fields = F.transform(F.split(header, ";"), lambda f: F.trim(F.translate(F.trim(f, F.lit("\r ")), '"', "")))
    lacking = F.array_sort(F.array_except(F.array(*[F.lit(r) for r in DEATH_REQUIRED]), fields))
    registry = (F.size(fields) == 2) & F.array_contains(fields, REGISTRY_FIELD)
    return F.when(~registry & (F.size(lacking) > 0), F.concat(F.lit("header lacks "), F.array_join(lacking, ",")))


def _page_problem(content: Column) -> Column:
    page = _latin1(content)
    shown = [F.contains(page, F.lit(mark)) for mark in PAGE_MARKS]
    return F.when(~reduce(lambda a, b: a & b, shown), F.lit("no result table on the page"))


def _pdf_problem(content: Column) -> Column:
    return F.when(F.substring(content, 1, 5) != F.lit(b"%PDF-"), F.lit("no PDF signature"))


def _json_problem(content: bytes) -> tuple[str | None, str]:
    value = json.loads(content)
    if not isinstance(value, list | dict):
        return "neither a list nor an object", ""
    return None, f"{type(value).__name__} of {len(value)}"


def _shape_problem(content: bytes) -> tuple[str | None, str]:
    packed = content.startswith(b"\x1f\x8b")
    value = json.loads(gzip.decompress(content) if packed else content)
    features = value.get("features") if isinstance(value, dict) and value.get("type") == "FeatureCollection" else None
    return (None, f"{len(features)} features") if isinstance(features, list) else ("no feature collection", "")


def _archive_problem(content: bytes) -> tuple[str | None, str]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names, broken = archive.namelist(), archive.testzip()
    return (f"damaged member {broken}" if broken else None), ",".join(names)


def _columnar_problem(content: bytes) -> tuple[str | None, str]:
    footer = pq.ParquetFile(io.BytesIO(content)).metadata
    return None, f"{footer.num_rows} rows, {footer.num_columns} columns"


#: Formats only a parser can judge; the rest are expressions.
_PARSED = {"json": _json_problem, "geojson": _shape_problem, "zip": _archive_problem, "parquet": _columnar_problem}
_EXPRESSED = {"csv": _csv_problem, "pdf": _pdf_problem, "html": _page_problem, "htm": _page_problem}


def file_format_check(files: DataFrame) -> DataFrame:
    """Format verdict of (path, content) rows: problem, details and format_ok.

    Only JSON, zip and Parquet contents go through Python.
    """
    suffix = F.lower(F.element_at(F.split("path", r"\."), -1))
    known = files.select("path", "content", suffix.alias("_suffix"))
    expressed = F.lit(None).cast("string")
    for name, problem in _EXPRESSED.items():
        expressed = F.when(F.col("_suffix") == name, problem(F.col("content"))).otherwise(expressed)
    unknown = ~F.col("_suffix").isin([*_EXPRESSED, *_PARSED])
    plain = known.where(~F.col("_suffix").isin(list(_PARSED))).select(
        "path", F.when(unknown, F.concat(F.lit("no test for files named ."), "_suffix")).otherwise(expressed).alias("problem"),
        F.concat(F.length("content").cast("string"), F.lit(" bytes")).alias("format_details"),
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for kind, content in zip(batch["_suffix"], batch["content"], strict=True):
                try:
                    found.append(_PARSED[kind](bytes(content)))
                except (ValueError, OSError, zipfile.BadZipFile, EOFError) as error:
                    found.append((f"unreadable: {type(error).__name__}", ""))
            yield pd.DataFrame({"path": batch["path"].to_numpy(), "problem": [p for p, _ in found], "format_details": [d for _, d in found]})

    parsed = known.where(F.col("_suffix").isin(list(_PARSED))).mapInPandas(parse, "path string, problem string, format_details string")
    return plain.unionByName(parsed).withColumn("format_ok", F.col("problem").isNull())


RAW_FORMATS = {
    "json": json_format, "geojson": shape_format, "zip": archive_format, "parquet": columnar_format, "pdf": document_format,
    "csv": header_format(DEATH_REQUIRED, REGISTRY_FIELD), "html": page_format(PAGE_MARKS), "htm": page_format(PAGE_MARKS),
}


def raw_file_verdict(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Checksum and format of each listed file together, with details and all errors; ``ok`` needs both.

    Each file is streamed once by one task; its size does not matter.
    """
    judged = sidecar_status(file_verdicts(files, RAW_FORMATS), sidecars)
    failed = F.when(~F.col("hash_ok"), F.array("hash_status")).otherwise(F.array().cast("array<string>"))
    errors = F.concat(failed, "format_errors")
    return judged.withColumn("errors", errors).withColumn("ok", (F.size("errors") == 0) & F.col("format_ok")).drop("format_errors")


def artifact_manifest(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Checksums of every file below named folders, for the results manifest."""
    parts = [file_digests(list_files(spark, path, recursive=True)).withColumn("group", F.lit(name)) for name, path in folders.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
