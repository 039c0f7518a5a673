"""Time the stages, then the headline queries over them, and print one JSON line.

Every stage is written before the first query is built, so no query pays for another's input
and the order of queries does not matter. The value is the sum of stages and queries.
"""

from __future__ import annotations

import json
import os
import time

from epispan.queries import all_queries
from epispan.queries.standins import STAGES
from epispan.session import build_session

HEADLINE = [
    "entry_outcome_rate_vs_rest", "a01_classified_counts", "a02_territory_rollup", "a09_monthly_surveillance",
    "j05_classified_equi_join", "st05_annual_rates", "st06_mortality_rates", "st07_age_sex_specific_rates",
    "st08_municipal_specific_rates", "st09_municipal_map_rates", "st10_neurological_rates",
    "st11_direct_standardized_rate", "st12_standardized_leave_one_out", "st13_notification_rates",
    "st14_monthly_notification_rate", "st16_interrupted_time_series", "w01_dedup_keep_last",
    "w03_complementary_suppression", "w06_leave_one_out_rate", "s01_scan_death_csv", "p07_source_row_number",
    "pb07_municipality_summaries", "pb13_outcome_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name: str, run) -> None:
        begun = time.perf_counter()
        run()
        timings[name] = round(time.perf_counter() - begun, 3)

    for name, stage in STAGES.items():
        timed(f"stage_{name}", lambda: stage(spark, folder))
    queries = all_queries()
    for name in HEADLINE:
        timed(name, lambda: queries[name](spark, folder).write.format("noop").mode("overwrite").save())
    total = round(sum(timings.values()), 3)
    scale = folder.rsplit("/", 1)[-1].removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
