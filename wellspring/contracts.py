"""Dataset contracts: keys, required columns, cadence and thresholds.

Columns are the canonical names the readers of this package produce.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

DAILY, WEEKLY, MONTHLY = "daily", "weekly", "monthly"


@dataclass(frozen=True)
class Contract:
    """What a dataset promises."""

    id: str
    province: str
    cadence: str
    keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    expected: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    min_rows: int = 0
    max_row_delta_pct: float = 50.0
    spatial: bool = False
    # columns that every load adds and that are never drift
    added: tuple[str, ...] = field(
        default=("snapshot_date", "source_id", "province", "file", "member", "line_no", "load")
    )


# --- fixed values: the published datasets and their promises ----------------
_FACILITY = ("facility_id", "facility_name", "operator_name", "facility_type", "status")
_WELL_LIST = (
    "uwi", "uwi_id", "well_name", "field_code", "licence_no", "licence_status",
    "licensee_code", "well_stat_code", "well_stat_date", "mode",
)
_VOLUMES = ("productionmonth", "activityid", "productid", "volume")
_SPUD = ("spud_date", "licence_number", "uwi")
_VOLUME_KEYS = ("from_to_id", "productionmonth", "activityid", "productid")

CONTRACTS = {
    c.id: c
    for c in [
        Contract(
            "ab_facilities_active", "AB", MONTHLY, ("facility_id",), _FACILITY,
            ("facility_id", "facility_name", "operator_name"), min_rows=50_000,
            max_row_delta_pct=20.0,
        ),
        Contract(
            "ab_facilities_inactive", "AB", MONTHLY, ("facility_id",), _FACILITY, min_rows=10_000
        ),
        Contract("ab_facility_positions", "AB", MONTHLY, ("facility_id",), spatial=True),
        Contract(
            "ab_pipelines", "AB", MONTHLY, ("pipeline_licence", "line_no"), min_rows=100_000,
            spatial=True,
        ),
        Contract("ab_confidential_wells", "AB", DAILY, ("uwi",), ("uwi", "release_date")),
        Contract("ab_production", "AB", MONTHLY, _VOLUME_KEYS, expected=_VOLUMES),
        Contract(
            "ab_well_list", "AB", MONTHLY, ("uwi",), _WELL_LIST,
            (*_WELL_LIST, "fluid", "type"),
            ("licence_issue_date", "fin_drl_date", "well_stat_date"),
        ),
        Contract(
            "ab_spuds_daily", "AB", DAILY, ("uwi", "spud_date"), (*_SPUD, "drilling_contractor"),
            _SPUD, ("spud_date",),
        ),
        Contract(
            "ab_licences_daily", "AB", DAILY, ("licence_number",),
            expected=("licence_number", "uwi", "well_name"), dates=("issue_date",),
        ),
        Contract(
            "ab_licences_archive", "AB", MONTHLY, ("licence_number",),
            ("licence_number", "issue_date"), dates=("issue_date",),
        ),
        Contract(
            "ab_spuds_archive", "AB", MONTHLY, ("uwi", "spud_date"), _SPUD, dates=("spud_date",)
        ),
        Contract(
            "ab_status_changes", "AB", WEEKLY, ("uwi", "event_date"),
            ("uwi", "event_date", "new_status"), ("uwi", "new_status", "event_date"),
            ("event_date",), min_rows=100,
        ),
        Contract(
            "ab_weekly_drilling", "AB", WEEKLY, ("uwi", "event_date"), ("uwi", "event_date"),
            dates=("event_date", "stat_date", "drill_date", "spud_date"),
        ),
        Contract(
            "ab_provincial_statistics", "AB", MONTHLY, ("product_type", "source_year"),
            ("product_type",),
        ),
        Contract(
            "ab_well_facility_link", "AB", MONTHLY, ("well_id",),
            ("well_id", "well_identifier", "linked_facility_id", "linked_facility_sub_type"),
            dates=("status_date", "link_start_date"), min_rows=500_000,
        ),
        Contract("ab_abandoned_wells", "AB", MONTHLY, ("uwi",), min_rows=50_000, spatial=True),
        Contract("ab_scheme_approvals", "AB", MONTHLY, ("scheme_id",), min_rows=1_000, spatial=True),
        Contract("sk_production", "SK", MONTHLY, _VOLUME_KEYS),
        Contract("sk_well_infrastructure", "SK", DAILY, ("well_id",)),
        Contract("sk_well_licence", "SK", DAILY, ("well_licence_id",)),
        Contract("sk_facility_licence", "SK", DAILY, ("facility_licence_id",)),
        Contract("sk_facility_infrastructure", "SK", DAILY, ("facility_id",)),
        Contract("sk_well_facility_link", "SK", DAILY, ("well_id",)),
        Contract("sk_business_associate", "SK", DAILY, ("ba_id",)),
        Contract("sk_daily_drilling", "SK", DAILY, ("cwi", "spud_date"), dates=("spud_date",)),
        Contract(
            "sk_well_bulletin", "SK", DAILY, ("cwi",),
            dates=("status_date", "issued_date", "cancelled_date"),
        ),
        Contract("sk_ref_ba_identifiers", "SK", DAILY, ("ba_id",)),
        Contract("sk_ref_facility_ids", "SK", DAILY, ("facility_id",)),
        Contract("sk_ref_activity_codes", "SK", DAILY, ("activity_code",)),
        Contract("sk_ref_pool_codes", "SK", DAILY, ("pool_code",)),
        Contract("sk_ref_product_codes", "SK", DAILY, ("product_code",)),
        Contract(
            "sk_pipelines", "SK", DAILY, ("licence_number", "segment_id"),
            ("licence_number", "licensee", "substance"), min_rows=4_000, spatial=True,
        ),
    ]
}


def contract_table(spark: SparkSession, contracts: Iterable[Contract] = ()) -> DataFrame:
    """The contracts as a table, to select datasets by cadence or kind."""
    rows = [
        (c.id, c.province, c.cadence, list(c.keys), list(c.required), c.min_rows, c.spatial)
        for c in (contracts or CONTRACTS.values())
    ]
    return spark.createDataFrame(
        rows,
        "dataset string, province string, cadence string, keys array<string>,"
        " required array<string>, min_rows bigint, spatial boolean",
    )


def due(cadence: str) -> list[Contract]:
    """Contracts to ingest at a cadence."""
    return [c for c in CONTRACTS.values() if c.cadence == cadence]


def spatial() -> list[Contract]:
    return [c for c in CONTRACTS.values() if c.spatial]
