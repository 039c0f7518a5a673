"""Census and estimate payloads published as JSON lists whose first element is a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import CENSUS_AGE, CENSUS_AGE_DECLARATION, CENSUS_SEX, CENSUS_VARIABLE, CENSUS_YEAR
from ..functions.demographics import lookup
from ..functions.text import pad_code7
from ..operators.checks import at_key, require

_MUNICIPAL = "D1C string, D1N string, D2C string, V string"
_AGE_SEX = "D1C string, D1N string, D2C string, D3C string, D4C string, D5C string, D6C string, V string"


def scan_population_json(spark: SparkSession, path: str) -> DataFrame:
    """Municipal population; the header element and non-numeric figures drop out."""
    raw = spark.read.schema(_MUNICIPAL).json(path, multiLine=True)
    people = F.col("V").try_cast("double")
    return raw.where(people.isNotNull()).select(
        F.col("D2C").try_cast("int").alias("year"),
        pad_code7("D1C").alias("municipality_code_ibge"),
        F.col("D1N").alias("municipality_name"),
        people.cast("long").alias("population"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def scan_population_age_sex_json(spark: SparkSession, path: str, year: str = CENSUS_YEAR) -> DataFrame:
    """Population per municipality, sex and broad age group; a dash is a counted zero."""
    raw = spark.read.schema(_AGE_SEX).json(path, multiLine=True)
    dash = F.col("V") == "-"
    figure = F.when(dash, F.lit(0.0)).otherwise(F.col("V").try_cast("double"))
    kept = raw.where(
        (F.col("D2C") == year)
        & (F.col("D3C") == CENSUS_VARIABLE)
        & (F.col("D5C") == CENSUS_AGE_DECLARATION)
        & F.col("D4C").isin(list(CENSUS_SEX))
        & F.col("D6C").isin(list(CENSUS_AGE))
    )
    return (
        require(kept, figure >= 0, at_key("no population figure at", ["D1C", "D4C", "D6C"])).groupBy(
            pad_code7("D1C").alias("municipality_code_ibge"), F.col("D1N").alias("municipality_name"),
            lookup(CENSUS_SEX, F.col("D4C")).alias("sex"), lookup(CENSUS_AGE, F.col("D6C")).alias("age_group"),
        )
        .agg(
            F.sum(figure.cast("long")).alias("population"),
            F.sum(dash.cast("long")).alias("sidra_zero_marker_count"),
            F.min("_metadata.file_path").alias("source_file"),
        )
    )
