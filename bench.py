"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "b01_facilities", "b02_facility_history", "b03_facility_status_changes", "b04_production",
    "b08_confidential_wells", "b09_spud_activity", "b10_well_licences", "b12_wells",
    "b13_status_changes", "b14_drilling_activity", "b15_ownership_changes",
    "v03_well_summary", "v05_monthly_provincial", "v06_new_activity", "v07_operator_groups",
    "c01_top_oil_producers", "c05_spud_to_production", "c07_water_cut", "c10_provinces_by_month",
    "c12_monthly_decline", "c14_licences_on_same_legal", "c16_yearly_growth",
    "c17_without_recent_production", "c19_cumulative_leaders",
    "w04_status_transitions", "w06_amendment_dedupe", "w10_month_over_month",
    "p04_format_uwi", "p06_survey_position", "q10_report", "s03_volumetric", "s04_licence_blocks",
    "t06_activity_windows",
]


def main() -> None:
    from wellspring import registry
    from wellspring.session import build_session

    registry.load()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(registry.QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start-up of the JVM, Python and the Parquet reader is no query time
    registry.QUERIES["o01_top_k"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
