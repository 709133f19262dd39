"""Bronze to silver in one run."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from wellspring.plans import silver
from wellspring.plans.sinks import read_silver, write_production, write_silver

log = logging.getLogger(__name__)

# table -> (builder, {input name of the builder: dataset or silver table})
PLAN: dict[str, tuple[Callable[..., DataFrame], dict[str, str]]] = {
    "facilities": (
        silver.build_facilities,
        {
            "active": "ab_facilities_active",
            "inactive": "ab_facilities_inactive",
            "sk": "sk_facility_infrastructure",
            "geo": "ab_facility_positions",
        },
    ),
    "facility_history": (
        silver.build_facility_history,
        {
            "active": "ab_facilities_active",
            "inactive": "ab_facilities_inactive",
            "geo": "ab_facility_positions",
        },
    ),
    "facility_status_changes": (
        silver.build_facility_status_changes,
        {
            "active": "ab_facilities_active",
            "inactive": "ab_facilities_inactive",
            "geo": "ab_facility_positions",
        },
    ),
    "pipelines": (silver.build_pipelines, {"lines": "ab_pipelines"}),
    "pipeline_installations": (
        silver.build_pipeline_installations,
        {"points": "ab_pipeline_installations"},
    ),
    "sk_pipelines": (silver.build_sk_pipelines, {"segments": "sk_pipelines"}),
    "confidential_wells": (
        silver.build_confidential_wells,
        {"confidential": "ab_confidential_wells"},
    ),
    "wells": (
        silver.build_wells,
        {
            "ab": "ab_well_list",
            "sk": "sk_well_licence",
            "sk_bulletin": "sk_well_bulletin",
            "confidential": "silver:confidential_wells",
            "status": "ab_status_changes",
        },
    ),
    "well_attributes": (
        silver.build_well_attributes,
        {"ab": "ab_well_list", "sk": "sk_well_infrastructure"},
    ),
    "ownership_changes": (silver.build_ownership_changes, {"well_list": "ab_well_list"}),
    "status_changes": (
        silver.build_status_changes,
        {"weekly": "ab_status_changes", "wells": "silver:wells"},
    ),
    "drilling_activity": (
        silver.build_drilling_activity,
        {
            "weekly": "ab_weekly_drilling",
            "daily": "ab_spuds_daily",
            "archive": "ab_spuds_archive",
            "wells": "silver:wells",
        },
    ),
    "spud_activity": (
        silver.build_spud_activity,
        {"daily": "ab_spuds_daily", "archive": "ab_spuds_archive", "sk": "sk_daily_drilling"},
    ),
    "well_licences": (
        silver.build_well_licences,
        {
            "daily": "ab_licences_daily",
            "archive": "ab_licences_archive",
            "sk": "sk_well_bulletin",
        },
    ),
    "production": (silver.build_production, {"ab": "ab_production", "sk": "sk_production"}),
}


def build_all(
    spark: SparkSession, bronze: Mapping[str, DataFrame], root: str
) -> dict[str, str]:
    """Build every silver table its inputs allow; returns table -> path or error.

    Tables are written as they are built and later builders read the written
    table, so wells is computed once and nothing depends on executor memory.
    One failing table does not stop the others.
    """
    results: dict[str, str] = {}
    for name, (builder, wanted) in PLAN.items():
        inputs = {}
        for input_name, source in wanted.items():
            if source.startswith("silver:"):
                df = read_silver(spark, root, source.removeprefix("silver:"))
            else:
                df = bronze.get(source)
            if df is not None:
                inputs[input_name] = df
        optional = {"geo", "wells", "confidential", "status"} - (
            {"confidential"} if name == "confidential_wells" else set()
        )
        if not set(inputs) - optional:
            continue
        try:
            df = builder(inputs)
            write = write_production if name == "production" else write_silver
            results[name] = write(df, root) if name == "production" else write(df, name, root)
        except (PySparkException, KeyError) as e:
            log.error("could not build %s: %s", name, e)
            results[name] = f"error: {e}"
    return results
