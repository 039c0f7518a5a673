"""Operators over yearly and monthly series of aggregates.

Windows here partition by series (indicator and area), so a group holds one row
per period and never the underlying events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import INTERRUPTION_ORIGIN_YEAR, PANDEMIC_START, RATE_MULTIPLIER
from ..functions.dates import month_from_text, months_between
from ..functions.labels import percent_change


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row of each key in an explicit order.

    An aggregate rather than a window: it combines on the map side, so a key that
    holds a third of all rows never lands in one task whole.
    """
    values = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.`{v}`").alias(v) for v in values])


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows repeat a key that came before."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def month_spine(first: Column, last: Column, base: DataFrame) -> DataFrame:
    return base.withColumn("period", F.explode(months_between(first, last)))


def latest_period(df: DataFrame, keys: list[str], preferred_metric: str) -> DataFrame:
    """Latest observation of each key, the preferred metric before any other."""
    window = Window.partitionBy(*keys).orderBy(
        (F.col("metricKind") == preferred_metric).cast("int").desc(), F.col("year").desc()
    )
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def competition_rank(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rank from the highest published value down; equal values share a rank."""
    shown = df.where(F.col(value).isNotNull() & ~F.col("suppressed"))
    return shown.withColumn("rank", F.rank().over(Window.partitionBy(*keys).orderBy(F.col(value).desc())))


def leave_one_out(df: DataFrame, keys: list[str], count: str = "count", population: str = "population") -> DataFrame:
    """Events, people and rate of everyone in the key except the row's own area.

    The rate is null where the row itself is suppressed or the rest is not a valid population.
    """
    window = Window.partitionBy(*keys)
    rest_count = F.sum(count).over(window) - F.col(count)
    rest_population = F.sum(population).over(window) - F.col(population)
    valid = (F.col("rest_population") > 0) & (F.col("rest_count") >= 0)
    if "suppressed" in df.columns:
        valid = valid & ~F.col("suppressed")
    ratio = F.col("rest_count").cast("double") / F.col("rest_population") * RATE_MULTIPLIER
    return (
        df.withColumn("rest_count", rest_count)
        .withColumn("rest_population", rest_population)
        .withColumn("rest_rate_per_100k", F.when(valid, ratio))
    )


def comparison_rows(df: DataFrame) -> DataFrame:
    """Three rows per city and period: the city, the rest of its state and the country.

    Expects ``leave_one_out`` columns and the country's own figures. A hidden city
    hides the rest of the state too; a period without a country figure has no such row.
    """
    def row(place: str, value: str | None, count: str | None, population: Column, suppressed: Column) -> Column:
        none = F.lit(None)
        return F.struct(
            F.lit(place).alias("comparisonId"),
            (F.col(value) if value else none).cast("double").alias("value"),
            (F.col(count) if count else none).cast("long").alias("count"),
            population.cast("long").alias("denominator"),
            suppressed.alias("suppressed"),
        )

    hidden = F.col("rest_rate_per_100k").isNull()
    rest_population = F.when(hidden, F.col("rest_population") + F.col("population")).otherwise(F.col("rest_population"))
    shown = df.withColumn("_rest_count", F.when(~hidden, F.col("rest_count")))
    rows = F.array_compact(F.array(
        row("selected_municipality", "value", "shown_count", F.col("population"), F.col("suppressed")),
        row("rest_of_rj_excluding_selected", "rest_rate_per_100k", "_rest_count", rest_population, hidden),
        F.when(
            F.col("country_value").isNotNull(),
            row("brazil_total", "country_value", "country_count", F.col("country_population"), F.lit(False)),
        ),
    ))
    keys = ["municipality_code_ibge", "outcome_id", "year"]
    return shown.select(*keys, F.explode(rows).alias("_row")).select(*keys, "_row.*")


def series_summary(df: DataFrame, keys: list[str], value: str, rest: str, country: str) -> DataFrame:
    """First, previous and latest published value with their changes; needs two periods."""
    window = Window.partitionBy(*keys).orderBy("year")
    steps = df.where(F.col(value).isNotNull()).withColumn("_previous", F.lag(value).over(window))
    latest = F.max_by(F.struct(value, "_previous", rest, country, "year"), "year").alias("_latest")
    grouped = steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("periods"), F.min("year").alias("first_year"),
        F.min_by(value, "year").alias("first_value"), latest,
    )

    def difference(name: str) -> Column:
        reference = F.col(f"_latest.{name}")
        return F.when(reference != 0, percent_change(F.col(f"_latest.{value}"), reference))

    return grouped.where("periods >= 2").select(
        *keys, "periods", "first_year", "first_value",
        F.col("_latest.year").alias("latest_year"), F.col(f"_latest.{value}").alias("latest_value"),
        F.col("_latest._previous").alias("previous_value"),
        percent_change(F.col(f"_latest.{value}"), F.col("_latest._previous")).alias("period_change"),
        difference(rest).alias("rest_difference"), difference(country).alias("country_difference"),
    )


def series_insight(
    df: DataFrame, keys: list[str], value: str, baseline: list[int], pandemic: list[int], rest: str, country: str
) -> DataFrame:
    """Baseline and disruption means, the latest definitive value and the changes between them.

    Nothing is returned for a series that misses a baseline or disruption year.
    """
    shown = df.where(F.col(value).isNotNull())
    final = F.col("dataStatus") != "provisional"
    in_base, in_pandemic = F.col("year").isin(baseline), F.col("year").isin(pandemic)
    facts = F.struct(value, rest, country, "year")
    grouped = shown.groupBy(*keys).agg(
        F.avg(F.when(in_base, F.col(value))).alias("baseline"),
        F.avg(F.when(in_pandemic, F.col(value))).alias("pandemic"),
        F.count(F.when(in_base, F.lit(1))).alias("_base"),
        F.count(F.when(in_pandemic, F.lit(1))).alias("_pandemic"),
        F.max_by(facts, F.when(final, F.col("year"))).alias("_latest"),
        F.min_by(F.col(value), F.when(final, F.col("year"))).alias("first_value"),
        F.count(F.when(final, F.lit(1))).alias("_final"),
        F.min(F.when(~final, F.col("year"))).alias("provisional_year"),
    )
    complete = (F.col("_base") == len(baseline)) & (F.col("_pandemic") == len(pandemic)) & (F.col("_final") > 0)
    latest = F.col(f"_latest.{value}")

    def difference(name: str) -> Column:
        reference = F.col(f"_latest.{name}")
        return F.when(reference != 0, percent_change(latest, reference))

    return grouped.where(complete).select(
        *keys, "baseline", "pandemic", F.col("_latest.year").alias("latest_year"), latest.alias("latest_value"),
        "first_value",
        percent_change("pandemic", "baseline").alias("pandemic_change"),
        percent_change(latest, F.col("pandemic")).alias("recovery_change"),
        percent_change(latest, F.col("first_value")).alias("long_term_change"),
        difference(rest).alias("rest_difference"), difference(country).alias("country_difference"),
        "provisional_year",
    )


def contiguous_segments(df: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Number the unbroken runs of years within each series, from zero."""
    window = Window.partitionBy(*keys).orderBy(year)
    gap = F.coalesce((F.col(year) - F.lag(year).over(window) > 1).cast("int"), F.lit(0))
    running = window.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_gap", gap).withColumn("segment", F.sum("_gap").over(running)).drop("_gap")


def missing_years(df: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Years absent between the first and last observed one."""
    y = F.col(year).cast("int")
    absent = F.array_except(F.sequence(F.min(y), F.max(y)), F.collect_set(y))
    return df.groupBy(*keys).agg(absent.alias("_absent")).select(*keys, F.explode("_absent").alias("missing_year"))


def missing_months(df: DataFrame, keys: list[str], period: str = "period") -> DataFrame:
    """Months absent between the first and last observed ``YYYY-MM``."""
    month = month_from_text(period)
    absent = F.array_except(months_between(F.min(month), F.max(month)), F.collect_set(month))
    texts = F.transform(absent, lambda m: F.date_format(m, "yyyy-MM"))
    return df.groupBy(*keys).agg(texts.alias("_absent")).select(*keys, F.explode("_absent").alias("missing_period"))


def annual_totals(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Yearly sums of a monthly series with the months missing from the observed range and the repeats."""
    month = F.col("month").cast("int")
    return df.groupBy(*keys, "year").agg(
        *[F.sum(v).alias(v) for v in values],
        F.countDistinct(month).alias("months"),
        (F.count(month) - F.countDistinct(month)).alias("duplicate_periods"),
    )


def interruption_variables(df: DataFrame, origin_year: int = INTERRUPTION_ORIGIN_YEAR, start: str = PANDEMIC_START) -> DataFrame:
    """Time index, step and slope of an interruption, and the monthly population offset.

    The slope counts months since the interruption and is zero at the interruption itself.
    """
    break_year, break_month = int(start[:4]), int(start[5:7])
    break_index = (break_year - origin_year) * 12 + break_month - 1
    return (
        df.withColumn("time_index", ((F.year("period") - origin_year) * 12 + F.month("period") - 1).cast("int"))
        .withColumn("pandemic_step", (F.col("time_index") >= break_index).cast("int"))
        .withColumn("post_pandemic_time", F.greatest(F.col("time_index") - break_index, F.lit(0)))
        .withColumn("monthly_population", F.col("population") / 12)
        .withColumn("offset_log_population", F.log("monthly_population"))
    )


def min_max_intensity(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Position of each value between the smallest and largest of its map; one half on a flat map."""
    window = Window.partitionBy(*keys)
    low, high = F.min(value).over(window), F.max(value).over(window)
    scaled = F.when(high > low, (F.col(value) - low) / F.when(high > low, high - low)).otherwise(F.lit(0.5))
    return df.withColumn("intensity", F.when(F.col(value).isNotNull(), scaled))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
