"""Direct age-sex standardisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import AGE_GROUPS, RATE_MULTIPLIER, SEXES, Z_975
from .checks import at_key, require
from .joins import rest_of_state_cells, unique_rows

CELL = ["age_group", "sex"]


def known_cells(df: DataFrame) -> DataFrame:
    return df.where(F.col("age_group").isin(AGE_GROUPS) & F.col("sex").isin(SEXES))


def standard_weights(standard: DataFrame) -> DataFrame:
    """Share of each age-sex cell in the standard population, at most sixteen rows."""
    cells = known_cells(standard).groupBy(*CELL).agg(F.sum("population").alias("standard_cell"))
    whole = Window.partitionBy(F.lit(1))
    filled = require(cells, F.col("standard_cell") > 0, at_key("standard population has no people in cell", CELL))
    return filled.select(
        *CELL,
        (F.col("standard_cell") / F.sum("standard_cell").over(whole)).alias("weight"),
        F.sum("standard_cell").over(whole).alias("standard_population_total"),
        F.count(F.lit(1)).over(whole).alias("standard_cells"),
    )


def coverage_gaps(rates: DataFrame, standard: DataFrame, area: list[str]) -> DataFrame:
    """Areas whose cells are not exactly the standard's, with how many are missing or extra."""
    weights = standard_weights(standard)
    marked = known_cells(rates).select(*area, *CELL).distinct().join(weights, CELL, "left")
    return (
        marked.groupBy(*area)
        .agg(
            F.count("weight").alias("matched"),
            F.count(F.when(F.col("weight").isNull(), F.lit(1))).alias("extra_cells"),
            F.max("standard_cells").alias("_cells"),
        )
        .withColumn("missing_cells", F.coalesce(F.col("_cells"), F.lit(0)) - F.col("matched"))
        .select(*area, "missing_cells", "extra_cells")
    )


def direct_standardized_rate(rates: DataFrame, standard: DataFrame, area: list[str]) -> DataFrame:
    """Standardised rate per area with normal limits clipped at zero.

    Every area must cover exactly the standard's cells. A missing cell would lose
    its weight without a trace, so it raises instead.
    """
    cells = unique_rows(known_cells(rates).select(*area, *CELL, "count", "population"), [*area, *CELL], "age-sex cell")
    joined = cells.join(standard_weights(standard), CELL, "left")
    n = F.col("count").cast("double")
    joined = require(joined, F.col("population") > 0, at_key("no people in age-sex cell of", area))
    people = F.col("population").cast("double")
    grouped = joined.groupBy(*area).agg(
        F.sum(F.col("weight") * n / people * RATE_MULTIPLIER).alias("_rate"),
        F.sum(F.col("weight") ** 2 * n / people**2 * RATE_MULTIPLIER**2).alias("_variance"),
        F.sum("count").alias("count"),
        F.sum("population").alias("denominator"),
        F.max("standard_population_total").alias("standard_population_total"),
        (F.count("weight") == F.max("standard_cells")).alias("_covered"),
        (F.count("weight") == F.count(F.lit(1))).alias("_known"),
    )
    spread = Z_975 * F.sqrt("_variance")
    covered = require(grouped, F.col("_covered") & F.col("_known"), at_key("standard cells not all covered by", area))
    return covered.withColumnRenamed("_rate", "standardized_rate_per_100k").select(
        *area,
        "standardized_rate_per_100k",
        F.greatest(F.lit(0.0), F.col("standardized_rate_per_100k") - spread).alias("standardized_ci_low_per_100k"),
        (F.col("standardized_rate_per_100k") + spread).alias("standardized_ci_high_per_100k"),
        "count", "denominator", "standard_population_total",
    )


def standardized_rest_of_state(rates: DataFrame, standard: DataFrame, city: str, keys: list[str]) -> DataFrame:
    """For every city, the standardised rate of the state without it."""
    rest = rest_of_state_cells(known_cells(rates), [*keys, *CELL], ["count", "population"])
    return direct_standardized_rate(
        rest.select(*keys, city, *CELL, F.col("rest_count").alias("count"), F.col("rest_population").alias("population")),
        standard, [*keys, city],
    )
