import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from epispan.functions.poisson import LISTED_COUNTS, poisson_limits, with_poisson_interval
from epispan.functions.rates import log_ratio_interval
from epispan.operators import its
from epispan.operators.series import interruption_variables
from epispan.operators.standardize import coverage_gaps, direct_standardized_rate, standardized_rest_of_state


def _tail(k: int, mean: float) -> float:
    """P(X <= k) summed term by term."""
    return math.fsum(math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(k + 1))


@settings(max_examples=60, deadline=None)
@given(st.integers(min_value=0, max_value=4000))
def test_limits_satisfy_their_defining_tails(count):
    lower, upper = (float(v[0]) for v in poisson_limits(np.array([count])))
    assert _tail(count, upper) == pytest.approx(0.025, abs=1e-9)
    if count == 0:
        assert lower == 0.0
    else:
        assert 1 - _tail(count - 1, lower) == pytest.approx(0.025, abs=1e-9)
        assert lower < count < upper


def test_known_limits_and_nulls(spark):
    frame = spark.createDataFrame([(0,), (10,), (None,)], "n long")
    got = [r["l"] for r in with_poisson_interval(frame, "n", "l").orderBy(F.col("n").asc_nulls_last()).collect()]
    assert got[0]["lower"] == 0 and got[0]["upper"] == pytest.approx(3.688879, abs=1e-6)
    assert (got[1]["lower"], got[1]["upper"]) == (pytest.approx(4.795389, abs=1e-6), pytest.approx(18.390356, abs=1e-6))
    assert got[2]["lower"] is None and got[2]["upper"] is None


def test_negative_count_is_refused(spark):
    with pytest.raises(ValueError):
        poisson_limits(np.array([-1]))
    with pytest.raises(Exception, match="from zero up"):
        with_poisson_interval(spark.createDataFrame([(-1,)], "n long"), "n", "l").collect()


def test_large_counts_follow_the_expansion(spark):
    counts = [LISTED_COUNTS - 1, LISTED_COUNTS, LISTED_COUNTS + 1, 123_456, 10**7, 3 * 10**9]
    got = {r["n"]: r["l"] for r in with_poisson_interval(spark.createDataFrame([(n,) for n in counts], "n long"), "n", "l").collect()}
    for n, lower, upper in zip(counts, *poisson_limits(np.array(counts)), strict=True):
        assert got[n]["lower"] == pytest.approx(lower, rel=1e-12) and got[n]["upper"] == pytest.approx(upper, rel=1e-12)


def test_limits_stay_in_the_jvm(spark):
    plan = with_poisson_interval(spark.range(5), "id", "l")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_ratio_interval_contains_the_published_ratio(rows):
    values = [(60, 2871, 279898, 16939781), (0, 5, 10, 10)]
    limits = rows(values, "a long, b long, p long, q long", log_ratio_interval(F.col("a"), F.col("b"), F.col("p"), F.col("q")))
    assert limits[0]["lower"] < 1.2648 < limits[0]["upper"]
    assert round(limits[0]["lower"], 2) == 0.98 and round(limits[0]["upper"], 2) == 1.63
    assert limits[1] is None


CELLS = [
    ("a", "65-74", "feminino", 10, 1000), ("a", "75+", "feminino", 20, 1000),
    ("b", "65-74", "feminino", 20, 1000), ("b", "75+", "feminino", 10, 1000),
]
STANDARD = [("65-74", "feminino", 3), ("75+", "feminino", 1)]
CELL_SCHEMA = "geography string, age_group string, sex string, count long, population long"


def test_direct_standardisation(spark):
    rates = spark.createDataFrame(CELLS, CELL_SCHEMA)
    standard = spark.createDataFrame(STANDARD, "age_group string, sex string, population long")
    got = {r["geography"]: r["standardized_rate_per_100k"] for r in direct_standardized_rate(rates, standard, ["geography"]).collect()}
    assert got == {"a": 1250.0, "b": 1750.0}


def test_an_area_that_misses_a_cell_raises_and_is_named(spark):
    rates = spark.createDataFrame(CELLS[:3], CELL_SCHEMA)
    standard = spark.createDataFrame(STANDARD, "age_group string, sex string, population long")
    gaps = {r["geography"]: r["missing_cells"] for r in coverage_gaps(rates, standard, ["geography"]).collect()}
    assert gaps == {"a": 0, "b": 1}
    with pytest.raises(Exception, match="not all covered"):
        direct_standardized_rate(rates, standard, ["geography"]).select("geography").collect()


def test_leave_one_out_standardisation_of_two_cities_swaps_them(spark):
    rates = spark.createDataFrame(CELLS, CELL_SCHEMA).withColumn("outcome_id", F.lit("x"))
    standard = spark.createDataFrame(STANDARD, "age_group string, sex string, population long")
    got = standardized_rest_of_state(rates, standard, "geography", ["outcome_id"]).collect()
    assert {r["geography"]: r["standardized_rate_per_100k"] for r in got} == {"a": 1750.0, "b": 1250.0}


def _monthly(months: int = 96, seed: int = 3, missing_year: int | None = 2014) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(months):
        year, month = 2012 + i // 12, i % 12 + 1
        if year == missing_year:
            continue
        step = year > 2016 or (year == 2016 and month >= 3)
        mean = 40 * math.exp(0.004 * i - 0.3 * step + 0.2 * math.sin(month / 2))
        rows.append(("o", "g", pd.Timestamp(year, month, 1).date(), year, month, int(rng.poisson(mean)), 120000 + 100 * i))
    return pd.DataFrame(rows, columns=["outcome_id", "geography", "period", "year", "month", "count", "population"]).assign(outcome_label="O")


def test_interruption_variables_do_not_shift_at_the_break(spark):
    frame = spark.createDataFrame(
        [("2020-02-01", 1000), ("2020-03-01", 1000), ("2020-04-01", 1000)], "p string, population long"
    ).withColumn("period", F.col("p").cast("date"))
    got = interruption_variables(frame).orderBy("p").collect()
    assert [r["pandemic_step"] for r in got] == [0, 1, 1]
    assert [r["post_pandemic_time"] for r in got] == [0, 0, 1]
    assert [r["monthly_population"] for r in got] == [1000 / 12] * 3


def test_interrupted_series_agrees_with_an_independent_fit(spark):
    data = spark.createDataFrame(_monthly())
    prepared = interruption_variables(data, 2012, "2016-03-01")
    row = its.fit_interrupted_series(prepared).collect()[0]
    dummies = [F.when(F.col("month") == m, 1.0).otherwise(0.0).alias(f"m{m}") for m in range(2, 13)]
    terms = ["time_index", "pandemic_step", "post_pandemic_time"]
    wide = prepared.select("count", "offset_log_population", *[F.col(t).cast("double").alias(t) for t in terms], *dummies)
    vectors = VectorAssembler(inputCols=terms + [f"m{m}" for m in range(2, 13)], outputCol="features").transform(wide)
    model = GeneralizedLinearRegression(
        family="poisson", link="log", labelCol="count", offsetCol="offset_log_population", maxIter=100, tol=1e-12
    ).fit(vectors)
    trend, step, slope = model.coefficients[:3]
    assert row["baseline_trend_rr_per_month"] == pytest.approx(math.exp(trend), rel=1e-7)
    assert row["immediate_level_rr"] == pytest.approx(math.exp(step), rel=1e-7)
    assert row["post_slope_change_rr_per_month"] == pytest.approx(math.exp(slope), rel=1e-7)
    assert row["post_trend_rr_per_month"] == pytest.approx(math.exp(trend + slope), rel=1e-7)
    assert row["aic"] == pytest.approx(model.summary.aic, rel=1e-7)
    assert row["model_status"] == "fitted_descriptive_its" and row["n_obs"] == 84


def test_robust_covariance_against_explicit_sums():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(30), rng.normal(size=30)])
    mean, residual = rng.uniform(1, 3, 30), rng.normal(size=30)
    meat = np.zeros((2, 2))
    for i in range(30):
        for j in range(30):
            weight = 1 - abs(i - j) / 5
            if weight > 0:
                meat += weight * residual[i] * residual[j] * np.outer(x[i], x[j])
    bread = np.linalg.inv(sum(mean[i] * np.outer(x[i], x[i]) for i in range(30)))
    assert its.robust_covariance(x, residual, mean, 4) == pytest.approx(bread @ meat @ bread)


def test_short_or_empty_series_are_marked_without_estimates(spark):
    short = interruption_variables(spark.createDataFrame(_monthly(20, missing_year=None)), 2012, "2016-03-01")
    row = its.fit_interrupted_series(short).collect()[0]
    assert row["model_status"] == "suppressed_insufficient_events" and row["immediate_level_rr"] is None


def test_a_fit_that_does_not_settle_says_so(spark, monkeypatch):
    prepared = interruption_variables(spark.createDataFrame(_monthly()), 2012, "2016-03-01").toPandas()
    assert its._fit_series(("o", "g"), prepared)["converged"][0]
    monkeypatch.setattr(its, "MAX_STEPS", 1)
    row = its._fit_series(("o", "g"), prepared).iloc[0]
    assert row["model_status"] == "not_converged" and not row["converged"] and row["immediate_level_rr"] is None


def test_level_change_and_moments(spark):
    prepared = interruption_variables(spark.createDataFrame(_monthly()), 2012, "2016-03-01")
    data = prepared.toPandas()
    after = data["pandemic_step"] == 1
    rate = [data.loc[m, "count"].sum() / data.loc[m, "monthly_population"].sum() for m in (after, ~after)]
    row = its.fit_level_change(prepared).collect()[0]
    assert row["immediate_level_rr"] == pytest.approx(rate[0] / rate[1], rel=1e-9)
    moments = {r["moment"]: r["fitted"] for r in its.fitted_moments(prepared).collect()}
    assert moments["time_index"] == pytest.approx((data["count"] * data["time_index"]).sum(), rel=1e-8)
    assert moments["month_4"] == pytest.approx(data.loc[data["month"] == 4, "count"].sum(), rel=1e-8)
