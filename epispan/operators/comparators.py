"""Comparator sets as data: overlapping groups of areas that any area can be held against.

A set names area codes, whole or by prefix. A bridge from area to set, one row for each pair
however often a set names the area, joins the counts of areas; each set is summed once for
all areas that are compared with it, and an area's own share is taken off afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import ComparatorSet
from ..functions.rates import crude_rate, log_ratio_interval, rate_difference, rate_ratio
from ..session import dimension
from .joins import dense_grid, fill_grid
from .rates import add_rates
from .rollup import sums


def set_dimension(spark, sets: list[ComparatorSet]) -> DataFrame:
    """(comparator_id, key, own_included): one row per code or prefix a set names."""
    rows = [(s.id, key, s.own_included) for s in sets for key in dict.fromkeys([*s.prefixes, *s.codes])]
    return dimension(spark, rows, "comparator_id string, key string, own_included boolean")


def membership(areas: DataFrame, sets: list[ComparatorSet], code: str = "code") -> DataFrame:
    """(code, comparator_id, own_included) for every area of ``areas`` and every set that names it.

    An area's prefixes of the lengths that sets use are its keys, so the bridge is an equi-join.
    """
    lengths = sorted({len(key) for s in sets for key in [*s.prefixes, *s.codes]})
    keys = F.array_distinct(F.array(*[F.substring(code, 1, n) for n in lengths]))
    keyed = areas.select(code).distinct().select(code, F.explode(keys).alias("key"))
    return keyed.join(set_dimension(areas.sparkSession, sets), "key").select(F.col(code).alias("code"), "comparator_id", "own_included").distinct()


def set_totals(df: DataFrame, bridge: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sums of ``values`` per key and set. Rows are first added up by area, so facts never multiply."""
    per_area = df.groupBy(*keys, "code").agg(*sums(values))
    return per_area.join(bridge.select("code", "comparator_id"), "code").groupBy(*keys, "comparator_id").agg(*sums(values))


def compare_with_sets(
    counts: DataFrame, population: DataFrame, sets: list[ComparatorSet], chosen: list[str], labels: dict[str, list[str]],
) -> DataFrame:
    """Rates of chosen areas against every comparator set, one row per year, label, area and set.

    ``counts`` has year, code, the columns named by ``labels`` and count; ``population`` has year, code
    and population. Cells nobody reported are zero; years without population of an area give no row.
    A set leaves out the area compared unless it says otherwise; where nobody is left its figures
    are null. The ratio has log-normal limits, the area's rate exact ones.
    """
    keys = ["year", *labels]
    both = population.select("code").unionAll(counts.select("code"))
    bridge = membership(both, sets)
    events = set_totals(counts, bridge, keys, ["count"]).withColumnRenamed("count", "_events")
    people = set_totals(population, bridge, ["year"], ["population"]).withColumnRenamed("population", "_people")
    own = population.where(F.col("code").isin(chosen)).groupBy("year", "code").agg(*sums(["population"]))
    own = fill_grid(dense_grid(own, **labels), counts.groupBy(*keys, "code").agg(*sums(["count"])), [*keys, "code"], ["count"])
    against = dense_grid(add_rates(own), comparator_id=[s.id for s in sets])
    joined = against.join(people, ["year", "comparator_id"], "left").join(events, [*keys, "comparator_id"], "left").join(
        bridge, ["code", "comparator_id"], "left"
    )
    own_part = F.coalesce(~F.col("own_included"), F.lit(False)).cast("long")
    rest_people = F.coalesce("_people", F.lit(0)) - own_part * F.col("population")
    rest_events = F.coalesce("_events", F.lit(0)) - own_part * F.col("count")
    compared = joined.withColumn("comparator_population", F.when(rest_people > 0, rest_people)).withColumn(
        "comparator_count", F.when(rest_people > 0, rest_events)
    )
    compared = compared.withColumn("comparator_rate_per_100k", crude_rate("comparator_count", "comparator_population"))
    limits = log_ratio_interval(*[F.col(c) for c in ("count", "comparator_count", "population", "comparator_population")])
    return compared.withColumn("_ratio", limits).select(
        *keys, "code", "comparator_id", "count", "population", "rate_per_100k", "rate_ci_lower_per_100k", "rate_ci_upper_per_100k",
        "comparator_count", "comparator_population", "comparator_rate_per_100k",
        rate_ratio("rate_per_100k", "comparator_rate_per_100k").alias("rate_ratio"),
        rate_difference("rate_per_100k", "comparator_rate_per_100k").alias("rate_difference_per_100k"),
        F.col("_ratio")["lower"].alias("rate_ratio_ci_lower"), F.col("_ratio")["upper"].alias("rate_ratio_ci_upper"),
    )
