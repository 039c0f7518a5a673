"""Death and notification microdata: raw files to harmonised tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fixed_values import DEATH_REQUIRED, NOTIFICATION_OPTIONAL, NOTIFICATION_REQUIRED, Territory
from ..functions.dates import compact_date, lenient_timestamp
from ..functions.territory import residence_code_valid
from ..functions.text import optional_text, year_in_name
from ..session import materialize
from .files import list_files, parquet_footers, scan_archives


def require_fields(available: list[str], required: list[str], what: str) -> None:
    missing = sorted(set(required) - set(available))
    if missing:
        raise ValueError(f"{what}: missing fields {missing}")


def scan_death_csv(spark: SparkSession, path: str | list[str], numbered: bool = False, multi_line: bool = False) -> DataFrame:
    """Semicolon-separated Latin-1 files, every field as text, with their file name.

    Files of one call share a layout; ``plans.harmonize`` takes folders with several. A row with
    more or fewer fields than the header raises, so a quoted line break cannot pass as two rows;
    ``multi_line`` reads such files whole, one task a file. Row numbers cost a second scan and
    a shuffle and come only when asked for.
    """
    # Without pruning the parser sees every field of a row and can count them.
    raw = spark.read.option("columnPruning", "false").csv(
        path, sep=";", encoding="ISO-8859-1", header=True, inferSchema=False, enforceSchema=False, multiLine=multi_line, mode="FAILFAST",
    )
    require_fields(raw.columns, DEATH_REQUIRED, "death file")
    if numbered:
        return number_rows(raw)
    return raw.withColumns({"source_file": F.col("_metadata.file_path"), "source_row_number": F.lit(None).cast("long")})


def number_rows(raw: DataFrame) -> DataFrame:
    """One-based row numbers within each source file, without sorting the file.

    A split knows its rows' order. The first identifier of every (file, split) and
    the rows of the splits before it give each row's number; only those split
    totals, one row per split, are grouped and joined back.
    """
    placed = raw.withColumns({
        "source_file": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"),
        "_position": F.monotonically_increasing_id(),
    })
    blocks = placed.groupBy("source_file", "_block").agg(
        F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    number = F.col("_position") - F.col("_first") + F.col("_before") + 1
    return (
        placed.join(offsets, ["source_file", "_block"])
        .withColumn("source_row_number", number)
        .drop("_block", "_position", "_first", "_before")
    )


def scan_zipped_csv(spark: SparkSession, path: str | list[str], fields: list[str]) -> DataFrame:
    """Rows of zipped CSV files, each archive with exactly one CSV member.

    A zip cannot be split, so one task streams one archive, whatever its size. Fields a file lacks
    come back as empty text; a row with more or fewer fields than its header raises.
    """
    return scan_archives(spark, [r["path"] for r in list_files(spark, path).select("path").collect()], fields, DEATH_REQUIRED)


def _as_text(raw: DataFrame, name: str) -> Column:
    """A field as text; whole numbers have no exponent, and what is no number is null."""
    kind = dict(raw.dtypes)[name]
    if kind not in ("float", "double"):
        return F.col(name).cast("string").alias(name)
    whole = F.col(name) == F.col(name).try_cast("long")
    text = F.when(whole, F.col(name).try_cast("long").cast("string")).otherwise(F.col(name).cast("string"))
    return F.when(~F.isnan(name), text).alias(name)


def notification_layouts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(layout, paths): files with the same known fields of the same types, found from their footers.

    A file without a required field, or without a footer, raises and is named.
    """
    footers = materialize(parquet_footers(list_files(spark, path)), "notification-footers")
    names = F.transform("fields", lambda f: f["name"])
    lacking = F.array_sort(F.array_except(F.array(*[F.lit(f) for f in NOTIFICATION_REQUIRED]), F.coalesce(names, F.array().cast("array<string>"))))
    for bad in footers.select("path", "error", lacking.alias("missing")).where("error IS NOT NULL OR size(missing) > 0").orderBy("path").limit(1).collect():
        what = f"cannot be read ({bad['error']})" if bad["error"] else f"missing fields {bad['missing']}"
        raise ValueError(f"{bad['path']}: {what}")
    known = F.array_sort(F.filter("fields", lambda f: f["name"].isin([*NOTIFICATION_REQUIRED, *NOTIFICATION_OPTIONAL])))
    return footers.groupBy(known.alias("layout")).agg(F.array_sort(F.collect_list("path")).alias("paths"))


def scan_notification_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Required and available optional fields only, as text; other columns are never read.

    Files of a folder or glob may differ in fields and types: those of one layout are one scan, with
    their own schema. A field that any file has is read, and is null for the others. The required
    fields are checked file by file.
    """
    layouts = notification_layouts(spark, path).orderBy("paths").collect()
    if not layouts:
        raise FileNotFoundError(f"no notification file to read at {path}")
    have = {f["name"] for group in layouts for f in group["layout"]}
    wanted = NOTIFICATION_REQUIRED + [f for f in NOTIFICATION_OPTIONAL if f in have]
    scans = []
    for group in layouts:
        own = {f["name"] for f in group["layout"]}
        raw = spark.read.parquet(*group["paths"])
        scans.append(raw.select(
            *[_as_text(raw, f) if f in own else F.lit(None).cast("string").alias(f) for f in wanted],
            F.col("_metadata.file_path").alias("source_file"),
            (F.col("_metadata.row_index") + 1).alias("source_row_number"),
        ))
    return reduce(lambda a, b: a.unionAll(b), scans)


def _header(source: str, year: Column | None, territory: Territory) -> dict[str, Column]:
    file_year = year_in_name(F.element_at(F.split(F.col("source_file"), "/"), -1))
    failure = F.raise_error(F.concat(F.lit("cannot infer the year of "), F.col("source_file")))
    residence = F.col("municipality_code_datasus")
    return {
        "source": F.lit(source),
        "source_year": F.coalesce(file_year if year is None else F.col("_year"), failure).cast("short"),
        "source_file": F.col("source_file"),
        "source_row_number": F.col("source_row_number").cast("long"),
        "municipality_code_datasus": residence,
        "residence_code_valid": residence_code_valid(residence),
        "residence_is_vr": residence == territory.selected_code6,
    }


def _cleaned(raw: DataFrame, fields: dict[str, str], extra: dict[str, Column], year: Column | None) -> DataFrame:
    """First projection: every raw text cleaned once, under its common name."""
    texts = {name: optional_text(raw.columns, field) for name, field in fields.items()}
    kept = {"source_file": F.col("source_file"), "source_row_number": F.col("source_row_number")}
    if year is not None:
        kept["_year"] = year
    return raw.select(*[expr.alias(name) for name, expr in (kept | texts | extra).items()])


def _named(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[expr.alias(name) for name, expr in columns.items()])


def harmonize_deaths(raw: DataFrame, territory: Territory, year: Column | None = None) -> DataFrame:
    """Raw death fields to the common table. Residence never falls back to occurrence."""
    cleaned = _cleaned(raw, {
        "municipality_code_datasus": "CODMUNRES", "municipality_code_occurrence": "CODMUNOCOR", "sex_raw": "SEXO",
        "age_raw": "IDADE", "underlying_cause": "CAUSABAS", "multiple_cause_raw": "CAUSAMAT", "death_date_raw": "DTOBITO",
        "birth_date_raw": "DTNASC", "death_type_raw": "TIPOBITO", "status_raw": "STDOEPIDEM",
    }, {}, year)
    return _named(cleaned, _header("SIM", year, territory) | {
        "municipality_code_occurrence": F.col("municipality_code_occurrence"),
        "sex_raw": F.col("sex_raw"),
        "age_raw": F.col("age_raw"),
        "underlying_cause": F.col("underlying_cause"),
        "multiple_cause_raw": F.col("multiple_cause_raw"),
        "death_date_raw": F.col("death_date_raw"),
        "death_date": compact_date("death_date_raw"),
        "birth_date_raw": F.col("birth_date_raw"),
        "birth_date": compact_date("birth_date_raw"),
        "death_type_raw": F.col("death_type_raw"),
        "status_raw": F.col("status_raw"),
    })


def harmonize_notifications(raw: DataFrame, territory: Territory, year: Column | None = None) -> DataFrame:
    """Raw notification fields to the common table; notification place stays apart from residence."""
    def moment(name: str) -> Column:
        return lenient_timestamp(name) if name in raw.columns else F.lit(None).cast("timestamp")

    moments = {
        "symptom_onset_date": moment("DT_SIN_PRI"),
        "notification_date": moment("DT_NOTIFIC"),
        "outcome_date": moment("DT_EVOLUCA"),
    }
    texts = {
        "municipality_code_notification": "CO_MUN_NOT", "sex_raw": "CS_SEXO", "age_raw": "NU_IDADE_N",
        "age_unit_raw": "TP_IDADE", "final_classification_raw": "CLASSI_FIN", "outcome_raw": "EVOLUCAO",
        "race_raw": "CS_RACA", "gestation_raw": "CS_GESTANT",
    }
    cleaned = _cleaned(raw, {"municipality_code_datasus": "CO_MUN_RES"} | texts, moments, year)
    order = [
        "municipality_code_notification", "sex_raw", "age_raw", "age_unit_raw", *moments, "final_classification_raw",
        "outcome_raw", "race_raw", "gestation_raw",
    ]
    return _named(cleaned, _header("SIVEP-SRAG", year, territory) | {name: F.col(name) for name in order})


def scan_harmonized(spark: SparkSession, path: str, years: list[int]) -> DataFrame:
    """Harmonised tables are partitioned by year, so this reads only the years asked for."""
    return spark.read.parquet(path).where(F.col("source_year").isin(years))
