"""Data-quality audits. Each is a table of findings, empty when all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.territory import in_state
from ..functions.text import strip_leading_zeros
from ..fixed_values import Territory


def column_profile(df: DataFrame, by: list[str], parsed: dict[str, str] | None = None) -> DataFrame:
    """Per column: null or empty values; per raw date: values that did not parse. One scan."""
    measured = [c for c in df.columns if c not in by]
    types = dict(df.dtypes)

    def missing(name: str) -> Column:
        value = F.col(name)
        empty = value.isNull() | (value == "") if types[name] == "string" else value.isNull()
        return F.count(F.when(empty, F.lit(1)))

    def failed(raw: str, date: str) -> Column:
        return F.count(F.when((F.coalesce(F.col(raw), F.lit("")) != "") & F.col(date).isNull(), F.lit(1)))

    checks = [("missing", c, missing(c)) for c in measured]
    checks += [("date_parse_failure", raw, failed(raw, date)) for raw, date in (parsed or {}).items()]
    if "residence_code_valid" in df.columns:
        bad = F.count(F.when(~F.coalesce(F.col("residence_code_valid"), F.lit(False)), F.lit(1)))
        checks.append(("invalid_residence", "residence_code_valid", bad))
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[expr.alias(f"_{i}") for i, (_, _, expr) in enumerate(checks)]
    )
    rows = F.array(*[
        F.struct(F.lit(kind).alias("check"), F.lit(name).alias("column"), F.col(f"_{i}").alias("failures"))
        for i, (kind, name, _) in enumerate(checks)
    ])
    return counted.select(*by, "rows", F.explode(rows).alias("_r")).select(*by, "rows", "_r.*")


def row_sequence_ok(df: DataFrame, by: list[str], number: str = "source_row_number") -> DataFrame:
    """Whether row numbers run 1..n without a gap or a repeat.

    Numbers between 1 and their count that are all different sum to n(n+1)/2, and so do their
    squares to theirs. One aggregate tests both; it needs no shuffle by row number.
    """
    wide = F.col(number).cast("decimal(38,0)")
    sums = df.groupBy(*by).agg(
        F.count(number).alias("_n"), F.count(F.lit(1)).alias("_rows"), F.min(number).alias("_low"), F.max(number).alias("_high"),
        F.sum(wide).alias("_sum"), F.sum((wide * wide).cast("decimal(38,0)")).alias("_squares"),
    )
    n = F.col("_n").cast("decimal(18,0)")
    triangle = (n * (n + 1)).cast("decimal(38,0)")
    return sums.select(*by, (
        (F.col("_n") == F.col("_rows")) & (F.col("_low") == 1) & (F.col("_high") == F.col("_n"))
        & (F.col("_sum") * 2 == triangle) & (F.col("_squares") * 6 == (triangle * (n * 2 + 1)).cast("decimal(38,0)"))
    ).alias("source_row_sequence_ok"))


def code_length_profile(df: DataFrame, by: list[str], code: str, target: str) -> DataFrame:
    """Rows per length of the zero-stripped code and how many are the target."""
    bare = strip_leading_zeros(code)
    return df.groupBy(*by, F.length(bare).alias("code_length")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(bare == target, F.lit(1))).alias("target_rows")
    )


def source_stats(df: DataFrame, by: list[str], code: str, onset: str, in_window: Column, territory: Territory) -> DataFrame:
    """Rows, state rows, state rows without onset, and state rows outside the window."""
    state = in_state(code, territory)
    known = F.col(onset).isNotNull()
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(state, F.lit(1))).alias("state_rows"),
        F.count(F.when(state & ~known, F.lit(1))).alias("missing_onset_state_rows"),
        F.count(F.when(state & known & ~in_window, F.lit(1))).alias("outside_window_state_rows"),
    )


def required_fields_missing(headers: DataFrame, required: list[str], file: str = "source_file", field: str = "field") -> DataFrame:
    """(file, field) pairs of required fields a file lacks; ``headers`` lists the fields present."""
    wanted = headers.select(file).distinct().withColumn(field, F.explode(F.array(*[F.lit(r) for r in required])))
    return wanted.join(headers, [file, field], "left_anti")


def negative_rows(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value) < 0)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def grid_gaps(df: DataFrame, area: str, cells: list[str], expected_cells: int) -> DataFrame:
    """Areas that do not hold exactly the expected number of distinct cells."""
    return (
        df.groupBy(area)
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*[F.col(c) for c in cells]).alias("cells"))
        .where((F.col("rows") != expected_cells) | (F.col("cells") != expected_cells))
    )


def set_mismatch(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Members of one set that the other lacks, either way."""
    only_left = left.select(key).distinct().exceptAll(right.select(key).distinct()).withColumn("side", F.lit("only_left"))
    only_right = right.select(key).distinct().exceptAll(left.select(key).distinct()).withColumn("side", F.lit("only_right"))
    return only_left.unionByName(only_right)


def reconcile(
    detail: DataFrame, totals: DataFrame, keys: list[str], value: str = "count", absent_totals_pass: bool = False
) -> DataFrame:
    """Keys whose detail sum differs from an independently built total, either side absent counting as zero.

    ``absent_totals_pass`` lets detail without any total go.
    """
    observed = detail.groupBy(*keys).agg(F.sum(value).alias("observed"))
    expected = totals.groupBy(*keys).agg(F.sum(value).alias("expected"))
    joined = observed.join(expected, keys, "full")
    lenient = F.col("expected").isNull() & F.lit(absent_totals_pass)
    filled = joined.select(*keys, F.coalesce("observed", F.lit(0)).alias("observed"), F.coalesce("expected", F.lit(0)).alias("expected"), lenient.alias("_pass"))
    return filled.where(~F.col("_pass") & (F.col("observed") != F.col("expected"))).drop("_pass")


def contract_violations(df: DataFrame, required: list[str], identity: list[str], nullable: list[str] | None = None) -> DataFrame:
    """Breaches of a record contract: a required field that is absent, or null where null is not allowed.

    ``nullable`` fields may be null, as protected figures are, but must be there.
    """
    allowed = set(nullable or ())
    absent = [F.struct(F.lit(f).alias("field"), F.lit("absent").alias("breach")) for f in required if f not in df.columns]
    empty = [
        F.when(F.col(f).isNull(), F.struct(F.lit(f).alias("field"), F.lit("null").alias("breach")))
        for f in required if f in df.columns and f not in allowed
    ]
    found = F.explode(F.array_compact(F.array(*absent, *empty))).alias("_b")
    return df.select(*identity, found).select(*identity, F.col("_b.field").alias("missing_field"), F.col("_b.breach").alias("breach"))


def unverified_sources(catalog: DataFrame) -> DataFrame:
    state = F.coalesce(F.col("status"), F.lit(""))
    return catalog.where(~state.isin("verified", "")).select("source_id", "status")


def series_structure(df: DataFrame, expected_rows: int, value: str = "value") -> DataFrame:
    """Row count against periods times outcomes times areas, and no negatives."""
    ok = (F.col("rows") == F.lit(expected_rows)) & (F.col("negatives") == 0)
    status = F.when(ok, F.lit("validated_structure_only_no_epidemiological_estimate"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(value) < 0, F.lit(1))).alias("negatives")
    ).withColumn("expected_rows", F.lit(expected_rows).cast("long")).withColumn(
        "status", status.otherwise(F.lit("incomplete_or_inconsistent_series"))
    )
