"""The driver's tables read as surveillance data, in Spark and as SQL.

lineitem rows stand for deaths, orders for notifications and admissions, nations
and their customers for municipalities and their population. The raw text
columns are deliberately untidy, as in administrative extracts.
"""

from __future__ import annotations

import re
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..fixed_values import (
    AGE_GROUPS, COUNTRY_TOTAL, NOTIFICATION_OUTCOMES, REST_OF_STATE, SECTION_PERIOD_STATUS, SELECTED, SEXES,
    STATE_TOTAL, Territory, outcome_definitions,
)
from ..functions.periods import death_period_status
from ..operators.joins import dense_grid
from ..operators.series import leave_one_out
from ..operators.suppression import is_small
from ..operators.rollup import national_denominators, state_denominators
from ..plans.products import (
    STATE_AREAS, death_outcome_counts, mortality_rates, municipal_map_rates, municipal_profiles,
    notification_outcome_counts, population_product,
)
from ..session import fresh_path, table
from ..sources.files import create_file
from ..sources.microdata import harmonize_deaths, harmonize_notifications

TERRITORY = Territory("33", "330000", "3300000")
MUNICIPALITIES = 10
POPULATION_YEARS = [1995, 1996, 1997, 1999, 2000, 2001]
STANDARD_YEAR = 2000
SIM = outcome_definitions("SIM")
PROFILE = outcome_definitions("SIM", exclude=("covid19",))
ADMISSION_OUTCOMES = {
    "1-URGENT": "resp_all", "2-HIGH": "pneumonia", "3-MEDIUM": "copd", "4-NOT SPECIFIED": "asthma",
    "5-LOW": "pneumoconiosis",
}


def code6(key: str) -> str:
    """Six-digit area of a key: two fifths in the state, two fifths elsewhere, one fifth abroad."""
    area = f"lpad(CAST({key} % 25 AS STRING), 4, '0')"
    return (
        f"CASE WHEN {key} % 5 IN (0, 1) THEN '33' || {area} WHEN {key} % 5 IN (2, 3) THEN '35' || {area} "
        f"ELSE 'EX' || {area} END"
    )


_CAUSE = (
    "substr('JICGFDU', CAST(l_partkey % 7 AS INT) + 1, 1) || lpad(CAST(l_partkey % 100 AS STRING), 2, '0')"
    " || CASE WHEN l_partkey % 3 = 0 THEN '.' ELSE '' END || CAST(l_partkey % 11 % 10 AS STRING)"
)
RAW_DEATH = {
    "CODMUNRES": f"CASE WHEN l_orderkey % 97 = 0 THEN '339999' ELSE {code6('l_suppkey')} END"
                 " || CASE WHEN l_linenumber = 3 THEN '.0' WHEN l_linenumber = 4 THEN ' ' ELSE '' END",
    "CODMUNOCOR": code6("l_partkey"),
    "SEXO": "CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN ' 2' ELSE CASE WHEN l_linenumber = 1 THEN '9' "
            "WHEN l_linenumber % 2 = 0 THEN '1' ELSE '2.' END END",
    "IDADE": "CAST(CASE WHEN l_linenumber = 7 THEN l_orderkey % 420 ELSE 400 + l_orderkey % 105 END AS STRING)",
    "CAUSABAS": f"CASE WHEN l_partkey % 4 = 0 THEN lower({_CAUSE}) ELSE {_CAUSE} END",
    "DTOBITO": "CASE WHEN l_orderkey % 53 = 0 THEN '99999999' ELSE lpad(CAST(day(l_shipdate) AS STRING), 2, '0') || "
               "lpad(CAST(month(l_shipdate) AS STRING), 2, '0') || CAST(year(l_shipdate) AS STRING) END",
    "year": "CAST(year(l_shipdate) AS INT)",
}
RAW_NOTIFICATION = {
    "CO_MUN_RES": code6("o_custkey"),
    "CS_SEXO": "CASE o_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'f' ELSE 'I' END",
    "NU_IDADE_N": "CAST(o_orderkey % 100 AS STRING)",
    "TP_IDADE": "CASE o_orderkey % 7 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '3' END",
    "DT_SIN_PRI": "CASE WHEN o_orderkey % 41 <> 0 THEN o_orderdate END",
    "CLASSI_FIN": "CASE o_orderpriority WHEN '1-URGENT' THEN '5.0' WHEN '2-HIGH' THEN '1' WHEN '3-MEDIUM' THEN ' 5 ' "
                  "WHEN '5-LOW' THEN '4' END",
    "EVOLUCAO": "CASE o_orderstatus WHEN 'F' THEN '2' WHEN 'O' THEN '1' ELSE CASE o_orderkey % 3 WHEN 0 THEN '3' "
                "WHEN 1 THEN '9' END END",
    "year": "CAST(year(o_orderdate) AS INT)",
}


#: Folders that many files are spread over: Spark lists more than 32 of them in parallel, one folder in one go.
FOLDERS = 128


def spread_folder(key: int | None) -> int:
    return (key or 0) % FOLDERS


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def raw_deaths(spark: SparkSession, folder: str) -> DataFrame:
    return _project(table(spark, folder, "lineitem"), RAW_DEATH)


def raw_notifications(spark: SparkSession, folder: str) -> DataFrame:
    return _project(table(spark, folder, "orders"), RAW_NOTIFICATION)


def write_year_files(rows: DataFrame, folder: str, year: str, members: Callable[[int], dict[str, list[str] | None]] | None = None) -> None:
    """Rows as semicolon-separated Latin-1 files named after their year, each task streaming its own.

    With ``members``, a zip archive a year instead: it names each member with the fields it holds
    (null: a note without fields).
    """
    fields = [c for c in rows.columns if c != year]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_year, target = TaskContext.get().partitionId(), None, None
        for batch in batches:
            frame = batch.to_pandas()
            for value in sorted(frame[year].unique()):
                chosen = frame[frame[year] == value]
                if value != open_year:
                    if target is not None:
                        target.close()
                    target, open_year = _YearFile(f"{folder}/sim_{value + YEAR_SHIFT}_part{part}", members and members(int(value)), fields), value
                target.append(chosen)
        if target is not None:
            target.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32())})

    rows.sortWithinPartitions(year).mapInArrow(write, "part int").agg(F.count("part")).collect()


#: The tables' years lie before 2000, and file names are read as of the years from 2000 on.
YEAR_SHIFT = 20


class _YearFile:
    def __init__(self, path: str, members: dict[str, list[str] | None] | None, fields: list[str]):
        self.members = members or {"": fields}
        self.plain = create_file(f"{path}.{'zip' if members else 'csv'}")
        self.spools = {name: tempfile.TemporaryFile() for name in self.members} if members else {"": self.plain}
        for name, own in self.members.items():
            self.spools[name].write((";".join(own) + "\n").encode("latin1") if own else b"a note\n")

    def append(self, rows: pd.DataFrame) -> None:
        for name, own in self.members.items():
            if own:
                self.spools[name].write(rows[own].to_csv(sep=";", index=False, header=False).encode("latin1"))

    def close(self) -> None:
        if "" not in self.members:
            with zipfile.ZipFile(self.plain, "w", zipfile.ZIP_DEFLATED) as archive:
                for name, spool in self.spools.items():
                    spool.seek(0)
                    with archive.open(name, "w") as member:
                        shutil.copyfileobj(spool, member)
        self.plain.close()


_STAGED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def _staged(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame], partitions: list[str] | None = None
) -> DataFrame:
    """Write a stage once per application and let every query read the written result.

    Stages hand over through files, as the published workflow does: facts are
    scanned once, and a lost executor costs a re-read, not a recomputation.
    Partitions are gathered by a shuffle first: a writer sorts its rows by partition, and
    would sort all that a task has scanned.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STAGED:
        path, frame = fresh_path(spark, name), build()
        even = frame.hint("rebalance", *partitions) if partitions else frame
        even.write.option("compression", "zstd").partitionBy(*partitions or []).parquet(path)
        _STAGED[key] = path, frame.schema
    path, schema = _STAGED[key]
    return spark.read.schema(schema).parquet(path)


def deaths(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        raw = raw_deaths(spark, folder)
        placed = raw.withColumns({"source_file": F.lit("lineitem"), "source_row_number": F.lit(0)})
        return harmonize_deaths(placed, TERRITORY, F.col("year"))

    return _staged(spark, folder, "harmonized-deaths", build, ["source_year"])


def notifications(spark: SparkSession, folder: str) -> DataFrame:
    def build() -> DataFrame:
        raw = raw_notifications(spark, folder)
        placed = raw.withColumns({"source_file": F.lit("orders"), "source_row_number": F.lit(0)})
        return harmonize_notifications(placed, TERRITORY, F.col("year"))

    return _staged(spark, folder, "harmonized-notifications", build, ["source_year"])


def municipal_population(spark: SparkSession, folder: str) -> DataFrame:
    """Population per municipality of the country and year; 1998 has none."""
    def build() -> DataFrame:
        people = table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
            F.count(F.lit(1)).alias("n")
        )
        areas = table(spark, folder, "nation").where("n_nationkey % 5 <> 4").join(people, "n_nationkey", "left")
        return dense_grid(areas, year=POPULATION_YEARS).selectExpr(
            "year",
            f"{code6('n_nationkey')} || CAST(n_nationkey % 10 AS STRING) AS municipality_code_ibge",
            "n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' - RJ' ELSE ' (RJ)' END AS municipality_name",
            "(coalesce(n, 0) + 1) * (1000 + (year - 1995) * 7) AS population",
            f"CASE WHEN year = {STANDARD_YEAR} THEN 'census' ELSE 'annual_estimate' END AS source_status",
            "'population_' || CAST(year AS STRING) AS source_file",
        )

    return _staged(spark, folder, "population-municipal", build)


def state_municipal_population(spark: SparkSession, folder: str) -> DataFrame:
    return municipal_population(spark, folder).where(F.col("municipality_code_ibge").startswith("33"))


def population(spark: SparkSession, folder: str) -> DataFrame:
    """Year by area denominators of the state areas and the country."""
    def build() -> DataFrame:
        municipal = municipal_population(spark, folder)
        state = state_denominators(state_municipal_population(spark, folder), TERRITORY, MUNICIPALITIES)
        return population_product(municipal, state, national_denominators(municipal))

    return _staged(spark, folder, "population-denominators", build)


def _age_case(value: str) -> str:
    limits = [250, 500, 1500, 3000, 5000, 7000, 8500]
    tests = " ".join(f"WHEN {value} < {limit} THEN '{group}'" for limit, group in zip(limits, AGE_GROUPS))
    return f"CASE {tests} ELSE '{AGE_GROUPS[-1]}' END"


AGE_EXPR = _age_case("c_acctbal")
SEX_EXPR = "CASE WHEN c_mktsegment < 'C' THEN 'masculino' ELSE 'feminino' END"


def population_age_sex(spark: SparkSession, folder: str) -> DataFrame:
    """Complete municipality by age by sex population of the country."""
    def build() -> DataFrame:
        cells = table(spark, folder, "customer").groupBy(
            F.col("c_nationkey").alias("n_nationkey"), F.expr(AGE_EXPR).alias("age_group"), F.expr(SEX_EXPR).alias("sex")
        ).agg(F.count(F.lit(1)).alias("n"))
        areas = table(spark, folder, "nation").where("n_nationkey % 5 <> 4")
        grid = dense_grid(areas, age_group=AGE_GROUPS, sex=SEXES)
        return grid.join(cells, ["n_nationkey", "age_group", "sex"], "left").selectExpr(
            f"{code6('n_nationkey')} || CAST(n_nationkey % 10 AS STRING) AS municipality_code_ibge",
            "n_name AS municipality_name", "age_group", "sex", "100 + coalesce(n, 0) * 1000 AS population",
        )

    return _staged(spark, folder, "population-age-sex", build)


def state_age_sex(spark: SparkSession, folder: str) -> DataFrame:
    return population_age_sex(spark, folder).where(F.col("municipality_code_ibge").startswith("33"))


def area_label(key: str) -> Column:
    return F.expr(
        f"CASE WHEN {key} % 25 = 0 THEN '{SELECTED}' WHEN {key} % 5 IN (0, 1) THEN '{REST_OF_STATE}' END"
    )


def monthly_admissions(spark: SparkSession, folder: str) -> DataFrame:
    """Admissions per month, outcome, state area and the state total."""
    outcome = F.create_map(*[F.lit(x) for pair in ADMISSION_OUTCOMES.items() for x in pair])
    label = area_label("o_custkey")
    counted = table(spark, folder, "orders").where(label.isNotNull()).groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), label.alias("geography"),
        outcome[F.col("o_orderpriority")].alias("outcome_id"),
    ).agg(F.count(F.lit(1)).alias("value"))
    areas = F.explode(F.array(F.col("geography"), F.lit(STATE_TOTAL)))
    return counted.withColumn("geography", areas).groupBy("year", "month", "geography", "outcome_id").agg(
        F.sum("value").alias("value")
    )


def admission_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Two overlapping admission windows; the later file revised 1998 upwards.

    Every third month is reported twice within a file: a larger first figure, then the right one.
    """
    monthly = monthly_admissions(spark, folder).withColumn("outcome_label", F.upper("outcome_id"))
    files = F.explode(F.array_compact(F.array(
        F.when(F.col("year") <= 1998, F.lit("window_1995_1998")), F.when(F.col("year") >= 1998, F.lit("window_1998_2001"))
    )))
    revised = F.when((F.col("year") == 1998) & (F.col("source_file") == "window_1998_2001"), 1).otherwise(0)
    rows = monthly.withColumn("source_file", files).withColumn("value", F.col("value") + revised)
    right = F.struct(F.lit(2).cast("long").alias("source_row_number"), F.col("value"))
    early = F.when(F.col("month") % 3 == 0, F.struct(F.lit(1).cast("long").alias("source_row_number"), (F.col("value") * 2 + 9).alias("value")))
    return rows.withColumn("_row", F.explode(F.array_compact(F.array(early, right)))).drop("value").select("*", "_row.*").drop("_row")


def death_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome counts, written once: every rate product starts from them, not from the facts."""
    return _staged(
        spark, folder, "death-counts", lambda: death_outcome_counts(deaths(spark, folder), TERRITORY, SIM)
    )


def notification_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _staged(
        spark, folder, "notification-counts",
        lambda: notification_outcome_counts(notifications(spark, folder), TERRITORY),
    )


def death_rates(spark: SparkSession, folder: str) -> DataFrame:
    return _staged(
        spark, folder, "death-rates",
        lambda: mortality_rates(death_counts(spark, folder), population(spark, folder)),
    )


def map_rates(spark: SparkSession, folder: str) -> DataFrame:
    return _staged(
        spark, folder, "map-rates",
        lambda: municipal_map_rates(deaths(spark, folder), state_municipal_population(spark, folder), TERRITORY, SIM),
    )


def profile_cells(spark: SparkSession, folder: str) -> DataFrame:
    return _staged(
        spark, folder, "profile-cells",
        lambda: municipal_profiles(
            deaths(spark, folder), state_age_sex(spark, folder), TERRITORY, PROFILE, STANDARD_YEAR
        ),
    )


def city_series(spark: SparkSession, folder: str) -> DataFrame:
    """Municipal rates with the rest of the state and the country beside them, small cells hidden."""
    base = map_rates(spark, folder).withColumns({
        "suppressed": is_small("count"),
        "value": F.when(~is_small("count"), F.col("rate_per_100k")),
        "shown_count": F.when(~is_small("count"), F.col("count")),
    })
    country = death_rates(spark, folder).where(F.col("geography") == COUNTRY_TOTAL).select(
        "year", "outcome_id", F.col("rate_per_100k").alias("country_value"), F.col("count").alias("country_count"),
        F.col("population").alias("country_population"),
    )
    status = F.when(F.col("year") >= 2001, F.lit("provisional")).otherwise(F.lit("source_observed"))
    joined = leave_one_out(base, ["year", "outcome_id"]).join(country, ["year", "outcome_id"], "left")
    return joined.withColumn("dataStatus", status)


#: Stages that queries hand over through, in dependency order.
STAGES = {
    "harmonized_deaths": deaths, "harmonized_notifications": notifications, "population_municipal": municipal_population,
    "population_denominators": population, "population_age_sex": population_age_sex, "death_counts": death_counts,
    "notification_counts": notification_totals, "death_rates": death_rates, "map_rates": map_rates, "profile_cells": profile_cells,
}


# --- The same data as SQL, for the checks ---------------------------------------------

def _values(rows: list[tuple], names: str) -> str:
    def literal(value: object) -> str:
        if value is None:
            return "NULL"
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


def _range_row(outcome_id: str, expression: str) -> tuple:
    text = expression.replace(".", "")
    if "-" in text:
        low, high = text.split("-")
        kind = "range3" if len(low) == 4 else "range2"
        return (outcome_id, kind, low[0], int(low[1:]), int(high[1:]), text)
    return (outcome_id, "prefix" if len(text) == 3 else "exact", text[0], 0, 0, text)


_DEFS = [_range_row(o.id, r) for o in SIM for r in o.ranges]
_STATUS = " ".join(
    f"WHEN section = '{s}' AND year BETWEEN {a} AND {b} THEN '{t}'" for s, a, b, t in SECTION_PERIOD_STATUS
)
_POP_YEARS = ", ".join(f"({y})" for y in POPULATION_YEARS)
_ADM = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ADMISSION_OUTCOMES.items())
_AGE_SQL = (
    "CASE WHEN years IS NULL THEN 'ignorado' WHEN years < 1 THEN '<1' WHEN years < 5 THEN '1-4' "
    "WHEN years < 15 THEN '5-14' WHEN years < 25 THEN '15-24' WHEN years < 45 THEN '25-44' "
    "WHEN years < 65 THEN '45-64' WHEN years < 75 THEN '65-74' ELSE '75+' END"
)


def _cols(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


_GEO_SQL = (
    "CASE WHEN code6 = '330000' THEN 'volta_redonda' WHEN regexp_full_match(code6, '33[0-9]{4}') THEN "
    "'rest_of_rj_excluding_vr' WHEN regexp_full_match(code6, '[0-9]{6}') THEN 'rest_of_brazil_excluding_rj' "
    "ELSE 'outside_brazil' END"
)

CTES: dict[str, str] = {
    "defs": _values(_DEFS, "outcome_id, kind, letter, lo, hi, txt"),
    "outcomes": _values([(o.section, o.id, o.label) for o in SIM], "section, outcome_id, outcome_label"),
    "notif_outcomes": _values(NOTIFICATION_OUTCOMES, "outcome_id, outcome_label, class_code"),
    "ages": _values([(i, g) for i, g in enumerate(AGE_GROUPS)], "age_order, age_group"),
    "sexes": _values([(s,) for s in SEXES], "sex"),
    "areas4": _values([(COUNTRY_TOTAL,), (STATE_TOTAL,), (SELECTED,), (REST_OF_STATE,)], "geography"),
    "areas3": _values([(g,) for g in STATE_AREAS], "geography"),
    "popyears": f"SELECT * FROM (VALUES {_POP_YEARS}) AS v(year)",
    "raw_d": f"SELECT {_cols(RAW_DEATH)} FROM lineitem",
    "raw_n": f"SELECT {_cols(RAW_NOTIFICATION)} FROM orders",
    "death": """
        SELECT year, regexp_replace(trim(CODMUNRES), '\\.0$', '') AS code6,
               regexp_replace(trim(SEXO), '\\.0$', '') AS sex_raw, IDADE AS age_raw, regexp_replace(trim(CAUSABAS), '\\.0$', '') AS cause_raw,
               trim(replace(upper(regexp_replace(trim(CAUSABAS), '\\.0$', '')), '.', '')) AS cause, DTOBITO AS date_raw,
               CASE trim(replace(SEXO, '.', '')) WHEN '1' THEN 'masculino' WHEN '2' THEN 'feminino' ELSE 'ignorado' END AS sex,
               CASE WHEN CAST(IDADE AS INT) BETWEEN 0 AND 399 THEN CAST(IDADE AS DOUBLE) / 365
                    WHEN CAST(IDADE AS INT) BETWEEN 400 AND 499 THEN CAST(IDADE AS DOUBLE) - 400 END AS years
        FROM raw_d""",
    "death_dim": f"SELECT *, {_GEO_SQL} AS geography, {_AGE_SQL} AS age_group FROM death",
    "causes": """
        SELECT DISTINCT c.cause, d.outcome_id FROM (SELECT DISTINCT cause FROM death) c JOIN defs d ON
          CASE d.kind WHEN 'prefix' THEN starts_with(c.cause, d.txt) WHEN 'exact' THEN c.cause = d.txt
            WHEN 'range2' THEN substr(c.cause, 1, 1) = d.letter AND TRY_CAST(substr(c.cause, 2, 2) AS INT) BETWEEN d.lo AND d.hi
            ELSE substr(c.cause, 1, 1) = d.letter AND length(c.cause) = 4
                 AND TRY_CAST(substr(c.cause, 2, 3) AS INT) BETWEEN d.lo AND d.hi END""",
    "death_base": """
        SELECT year, geography, sex, age_group, outcome_id, count(*) AS n
        FROM death_dim JOIN causes USING (cause) WHERE geography <> 'outside_brazil' GROUP BY ALL""",
    "death_counts": """
        SELECT year, geography, sex, age_group, outcome_id, n FROM death_base
        UNION ALL SELECT year, 'rj_total', sex, age_group, outcome_id, CAST(sum(n) AS BIGINT) FROM death_base
          WHERE geography IN ('volta_redonda', 'rest_of_rj_excluding_vr') GROUP BY ALL
        UNION ALL SELECT year, 'brazil_total', sex, age_group, outcome_id, CAST(sum(n) AS BIGINT) FROM death_base GROUP BY ALL""",
    "notif": """
        SELECT year, CO_MUN_RES AS code6, upper(CS_SEXO) AS sex_code, CAST(NU_IDADE_N AS DOUBLE) AS age, TP_IDADE AS unit,
               CAST(DT_SIN_PRI AS TIMESTAMP) AS onset, regexp_replace(trim(coalesce(CLASSI_FIN, '')), '\\.0$', '') AS class_code,
               coalesce(EVOLUCAO, '') AS outcome_code,
               CASE TP_IDADE WHEN '3' THEN CAST(NU_IDADE_N AS DOUBLE) WHEN '2' THEN CAST(NU_IDADE_N AS DOUBLE) / 12
                 WHEN '1' THEN CAST(NU_IDADE_N AS DOUBLE) / 365 END AS years
        FROM raw_n""",
    "notif_dim": f"""
        SELECT *, {_GEO_SQL} AS geography, {_AGE_SQL} AS age_group,
          CASE sex_code WHEN 'M' THEN 'masculino' WHEN 'F' THEN 'feminino' ELSE 'ignorado' END AS sex,
          CASE outcome_code WHEN '1' THEN 'recuperado' WHEN '2' THEN 'óbito por SRAG' WHEN '3' THEN 'óbito por outra causa'
            WHEN '9' THEN 'ignorado' ELSE 'sem informação' END AS outcome_status
        FROM notif""",
    "notif_base": """
        SELECT d.year, geography, sex, age_group, outcome_status, outcome_id, count(*) AS n
        FROM notif_dim d JOIN notif_outcomes o ON o.class_code IS NULL OR o.class_code = d.class_code
        WHERE geography IN ('volta_redonda', 'rest_of_rj_excluding_vr') GROUP BY ALL""",
    "notif_counts": """
        SELECT * FROM notif_base
        UNION ALL SELECT year, 'rj_total' AS geography, sex, age_group, outcome_status, outcome_id, CAST(sum(n) AS BIGINT)
        FROM notif_base GROUP BY ALL""",
    "munipop": f"""
        SELECT y.year, {code6('n_nationkey')} || CAST(n_nationkey % 10 AS STRING) AS code7,
               n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' - RJ' ELSE ' (RJ)' END AS municipality_name,
               CAST((coalesce(c.n, 0) + 1) * (1000 + (y.year - 1995) * 7) AS BIGINT) AS population,
               CASE WHEN y.year = {STANDARD_YEAR} THEN 'census' ELSE 'annual_estimate' END AS source_status,
               'population_' || CAST(y.year AS STRING) AS source_file
        FROM nation CROSS JOIN popyears y
        LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON c.c_nationkey = n_nationkey
        WHERE n_nationkey % 5 <> 4""",
    "statepop": "SELECT * FROM munipop WHERE starts_with(code7, '33')",
    "pop": """
        SELECT year, 'rj_total' AS geography, CAST(sum(population) AS BIGINT) AS population FROM statepop GROUP BY 1
        UNION ALL SELECT year, 'volta_redonda', population FROM statepop WHERE code7 = '3300000'
        UNION ALL SELECT year, 'rest_of_rj_excluding_vr', CAST(sum(population) AS BIGINT) FROM statepop WHERE code7 <> '3300000' GROUP BY 1
        UNION ALL SELECT year, 'brazil_total', CAST(sum(population) AS BIGINT) FROM munipop GROUP BY 1""",
    "agesex": f"""
        SELECT {code6('n_nationkey')} || CAST(n_nationkey % 10 AS STRING) AS code7, ages.age_group, sexes.sex,
               100 + coalesce(c.n, 0) * 1000 AS population
        FROM nation CROSS JOIN ages CROSS JOIN sexes
        LEFT JOIN (SELECT c_nationkey, {AGE_EXPR} AS age_group, {SEX_EXPR} AS sex, count(*) AS n FROM customer GROUP BY ALL) c
          ON c.c_nationkey = n_nationkey AND c.age_group = ages.age_group AND c.sex = sexes.sex
        WHERE n_nationkey % 5 <> 4""",
    "state_agesex": "SELECT * FROM agesex WHERE starts_with(code7, '33')",
    "adm_base": f"""
        SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
               CASE WHEN o_custkey % 25 = 0 THEN 'volta_redonda' ELSE 'rest_of_rj_excluding_vr' END AS geography,
               CASE o_orderpriority {_ADM} END AS outcome_id, count(*) AS value
        FROM orders WHERE o_custkey % 5 IN (0, 1) GROUP BY ALL""",
    "adm_monthly": """
        SELECT * FROM adm_base UNION ALL
        SELECT year, month, 'rj_total' AS geography, outcome_id, CAST(sum(value) AS BIGINT) FROM adm_base GROUP BY ALL""",
    "adm": "SELECT year, month, geography, outcome_id, value + CASE WHEN year = 1998 THEN 1 ELSE 0 END AS value FROM adm_monthly",
    "adm_years": """
        SELECT year FROM adm WHERE year IN (SELECT year FROM pop) GROUP BY year HAVING count(DISTINCT month) = 12""",
    "death_year": "SELECT year, geography, outcome_id, CAST(sum(n) AS BIGINT) AS n FROM death_counts GROUP BY ALL",
    "mort": """
        SELECT g.year, g.outcome_id, a.geography, coalesce(d.n, 0) AS n, p.population,
               coalesce(d.n, 0) / p.population * 100000.0 AS rate
        FROM (SELECT DISTINCT year, outcome_id FROM death_year) g CROSS JOIN areas4 a
        LEFT JOIN death_year d ON d.year = g.year AND d.outcome_id = g.outcome_id AND d.geography = a.geography
        JOIN pop p ON p.year = g.year AND p.geography = a.geography""",
    "death_status": f"""
        SELECT m.year, o.outcome_id, CASE {_STATUS} ELSE 'source_year_observed' END AS period_status
        FROM (SELECT DISTINCT year FROM death) m CROSS JOIN outcomes o""",
    "muni_year": """
        SELECT year, code6, outcome_id, count(*) AS n FROM death_dim JOIN causes USING (cause)
        WHERE regexp_full_match(code6, '33[0-9]{4}') GROUP BY ALL""",
    "munimap": """
        SELECT p.year, p.code7, o.outcome_id, o.section, coalesce(m.n, 0) AS n, p.population,
               coalesce(m.n, 0) / p.population * 100000.0 AS rate
        FROM statepop p CROSS JOIN outcomes o
        LEFT JOIN muni_year m ON m.year = p.year AND m.code6 = substr(p.code7, 1, 6) AND m.outcome_id = o.outcome_id""",
    "profile_base": f"""
        SELECT code6, outcome_id, age_group, sex, count(*) AS n FROM death_dim JOIN causes USING (cause)
        WHERE year = {STANDARD_YEAR} AND outcome_id <> 'covid19' AND regexp_full_match(code6, '33[0-9]{{4}}')
          AND code6 IN (SELECT substr(code7, 1, 6) FROM state_agesex) GROUP BY ALL""",
    "profile": """
        SELECT a.code7, a.age_group, a.sex, o.outcome_id, a.population, coalesce(b.n, 0) AS n,
               coalesce(b.n, 0) / a.population * 100000.0 AS rate
        FROM state_agesex a CROSS JOIN outcomes o
        LEFT JOIN profile_base b ON b.code6 = substr(a.code7, 1, 6) AND b.outcome_id = o.outcome_id
          AND b.age_group = a.age_group AND b.sex = a.sex
        WHERE o.outcome_id <> 'covid19'""",
    "profile_ranked": """
        SELECT *, count(*) FILTER (WHERE n < 5) OVER s AS n_small,
               row_number() OVER (PARTITION BY outcome_id, age_group, sex ORDER BY n < 5, n, code7) AS pos
        FROM profile WINDOW s AS (PARTITION BY outcome_id, age_group, sex)""",
    "profile_status": """
        SELECT *, CASE WHEN (outcome_id = 'cervix' AND sex = 'masculino') OR (outcome_id = 'prostate' AND sex = 'feminino')
              THEN 'not_applicable' WHEN n < 5 THEN 'suppressed'
              WHEN n_small = 1 AND pos = 1 THEN 'suppressed_complementary' ELSE 'published' END AS status
        FROM profile_ranked""",
    "cityseries": """
        SELECT m.year, m.code7, m.outcome_id, m.n, m.population, m.n < 5 AS suppressed, CASE WHEN m.n >= 5 THEN m.rate END AS value,
          CAST(sum(m.n) OVER w - m.n AS BIGINT) AS rest_count, CAST(sum(m.population) OVER w - m.population AS BIGINT) AS rest_population,
          CASE WHEN m.n >= 5 THEN CAST(sum(m.n) OVER w - m.n AS DOUBLE) / CAST(sum(m.population) OVER w - m.population AS DOUBLE) * 100000.0 END AS rest,
          b.rate AS country_value, b.n AS country_count, b.population AS country_population, m.year >= 2001 AS provisional
        FROM munimap m LEFT JOIN mort b ON b.year = m.year AND b.outcome_id = m.outcome_id AND b.geography = 'brazil_total'
        WINDOW w AS (PARTITION BY m.year, m.outcome_id)""",
    "standard": """
        SELECT age_group, sex, cell, CAST(cell AS DOUBLE) / sum(cell) OVER () AS weight FROM
          (SELECT age_group, sex, sum(population) AS cell FROM agesex GROUP BY age_group, sex)""",
}


def with_ctes(sql: str) -> str:
    """Prefix a statement with the named tables it uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"(?<![\w.']){name}\b(?!\s*AS\b)", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    prefix = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql, re.IGNORECASE)
    if own:
        return f"WITH {'RECURSIVE ' if own[1] else ''}{prefix},\n{sql[own.end():]}"
    return f"WITH {prefix}\n{sql}"
