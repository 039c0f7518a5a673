"""Joins and grids with their key rules enforced inside the plan.

No operator here starts a job of its own: a broken rule raises when the result is
computed, so validation costs no second pass over the facts. Rules are filters: selecting
only some columns of a result does not drop them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.territory import residence_code_valid
from .checks import at_key, require


def _counted_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(v).alias(v) for v in values])


def unique_rows(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df`` with one row per key; a repeated key raises instead of multiplying matches."""
    return require(_counted_keys(df, keys), F.col("_n") == 1, at_key(f"{what}: repeated key", keys)).drop("_n")


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Left many-to-one join. The check reads the joined rows, so the join stays whatever is selected."""
    joined = left.join(_counted_keys(right, keys), keys, "left")
    return require(joined, F.coalesce("_n", F.lit(1)) == 1, at_key(f"{what}: repeated key", keys)).drop("_n")


def join_denominator(
    counts: DataFrame, population: DataFrame, keys: list[str], value: str = "population", strict: bool = False
) -> DataFrame:
    """Left many-to-one join of counts to population.

    Keys without population stay null, as gaps, unless ``strict`` asks to raise.
    """
    joined = join_unique(counts, population, keys, "population")
    return require(joined, F.col(value).isNotNull(), at_key("no population for", keys)) if strict else joined


def join_one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return join_unique(unique_rows(left, keys, "left side"), right, keys, "right side")


def dense_grid(base: DataFrame, **dimensions: list) -> DataFrame:
    """Every distinct row of ``base`` with every combination of the configured labels.

    The labels unroll from literal arrays, so the grid needs no join at all.
    """
    grid = base
    for name, labels in dimensions.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in labels])))
    return grid


def fill_grid(grid: DataFrame, counts: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Attach counts to the grid; cells nobody reported are true zeros."""
    return grid.join(counts.select(*keys, *values), keys, "left").fillna(0, subset=values)


def dense_counts(df: DataFrame, keys: list[str], dimension: str, labels: list[str], value: str = "count") -> DataFrame:
    """Sums of ``value`` for every key and every label, zero where nobody reported.

    One aggregation with a column per label, unrolled again: the input is read
    once, where a grid built from it and joined back would read it twice.
    """
    wide = df.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col(dimension) == label, F.col(value))), F.lit(0)).alias(f"_{i}")
        for i, label in enumerate(labels)
    ])
    cells = F.array(*[
        F.struct(F.lit(label).alias(dimension), F.col(f"_{i}").alias(value)) for i, label in enumerate(labels)
    ])
    return wide.select(*keys, F.explode(cells).alias("_cell")).select(*keys, "_cell.*")


def municipality_with_fallback(
    events: DataFrame, municipalities: DataFrame, code: str, year: str, fallback: str
) -> DataFrame:
    """Area of each event: its municipality, else ``fallback`` for any six-digit code.

    Codes that are neither are dropped.
    """
    areas = municipalities.select(year, code, "municipality_code_ibge")
    area = F.coalesce(
        F.col("municipality_code_ibge"), F.when(residence_code_valid(F.trim(F.col(code))), F.lit(fallback))
    )
    joined = join_unique(events, areas, [year, code], "municipality").withColumn("geography", area)
    return joined.where(F.col("geography").isNotNull()).drop("municipality_code_ibge")


def full_outer_series(series: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """One wide row per key from several one-row-per-key series."""
    renamed = [
        unique_rows(df.select(key, F.col(value).alias(f"{value}_{name}")), [key], name) for name, df in series.items()
    ]
    return reduce(lambda a, b: a.join(b, key, "full"), renamed)


def wide_comparators(
    df: DataFrame, keys: list[str], geographies: list[str], metrics: list[str], geography: str = "geography"
) -> DataFrame:
    """Put each comparator's figures beside every row of the same key.

    A conditional window needs one shuffle where pivot-and-join-back needs three;
    its group is one outcome and year, so it holds one row per published area.
    """
    window = Window.partitionBy(*keys)
    added = {
        f"{metric}_{place}": F.max(F.when(F.col(geography) == place, F.col(metric))).over(window)
        for metric in metrics
        for place in geographies
    }
    return df.withColumns(added)


def known_members(df: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    return df.join(valid.select(key).distinct(), key, "left_semi")


def unknown_member_tally(df: DataFrame, valid: DataFrame, key: str, by: list[str], value: str) -> DataFrame:
    """What the membership test leaves out, summed for the audit."""
    return df.join(valid.select(key).distinct(), key, "left_anti").groupBy(*by).agg(F.sum(value).alias(value))


def manifest_lookup(files: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Attach the manifest entry of every file; a file without one raises."""
    joined = join_unique(files, manifest.withColumn("_found", F.lit(True)), [key], "manifest")
    return require(joined, F.col("_found"), at_key("no manifest entry for", [key])).drop("_found")


def reference_values(
    df: DataFrame, reference: DataFrame, keys: list[str], places: dict[str, str], value: str = "value"
) -> DataFrame:
    """Attach the state's, the country's... value of the same indicator and period."""
    named = reference.where(F.col("geography").isin(list(places.values())))
    wide = named.groupBy(*keys).agg(
        *[F.max(F.when(F.col("geography") == place, F.col(value))).alias(name) for name, place in places.items()]
    )
    return df.join(wide, keys, "left")


def rest_of_state_cells(cells: DataFrame, cell_keys: list[str], values: list[str]) -> DataFrame:
    """State total minus each city, for every city and age-sex cell at once."""
    window = Window.partitionBy(*cell_keys)
    return cells.withColumns({f"rest_{v}": F.sum(v).over(window) - F.col(v) for v in values})


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``; for small keyed tables of aggregates."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
