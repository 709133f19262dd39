"""The silver tables.

Every builder takes its inputs by name, each a DataFrame of parsed records
with a ``snapshot_date`` where the source publishes snapshots, and returns the
table. Inputs that a deployment does not have may be left out. Keys are
cleaned before they are compared or joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.constants import (
    DRILLING_SOURCES,
    STATUS_CHANGE_ALIASES,
    VOLUMETRIC_ALIASES,
    VOLUMETRIC_KEYS,
    WELL_ATTRIBUTE_DATES,
    WELLS_DATES,
    WELLS_RENAMES,
)
from wellspring.functions.facility import classify
from wellspring.functions.identifiers import format_uwi
from wellspring.functions.names import canonicalize, drop_metadata, select_present
from wellspring.functions.survey import line_centroid, uwi_lat, uwi_lon
from wellspring.functions.text import first_word, status_label, trim_keys
from wellspring.functions.values import coerce_dates
from wellspring.operators.aggregates import pivot_products
from wellspring.operators.filters import activity, drop_html, max_of
from wellspring.operators.joins import (
    enrich_confidential,
    enrich_geo,
    enrich_status,
    enrich_wells,
)
from wellspring.operators.keyed import (
    first_events,
    last_nonnull,
    latest_by,
    seen_range,
    snapshot_changes,
    transitions,
)
from wellspring.operators.sets import union_all
from wellspring.sources.snapshots import latest_snapshot

Inputs = Mapping[str, DataFrame]
NOT_ATTRIBUTES = {"facility_id", "snapshot_date", "is_active"}


def _with_province(df: DataFrame, default: str) -> DataFrame:
    if "province" not in df.columns:
        return df.withColumn("province", F.lit(default))
    return df.withColumn("province", F.coalesce("province", F.lit(default)))


def _given(inputs: Inputs, **defaults: str) -> list[DataFrame]:
    """The inputs that exist, each with the province it is about."""
    found = [_with_province(inputs[n], p) for n, p in defaults.items() if n in inputs]
    if not found:
        raise ValueError(f"none of {sorted(defaults)} is given")
    return found


def _newest(df: DataFrame, tiebreak: Sequence[str]) -> list[Column]:
    """Newest snapshot first; then later lines of later files; then the rest."""
    order = [F.desc(c) for c in ("snapshot_date", "file", "line_no") if c in df.columns]
    return order + [F.desc(c) for c in tiebreak if c in df.columns]


# --- facilities -------------------------------------------------------------

FACILITY_KEYS = ["facility_id", "operator_ba_id", "licensee_code"]


def build_facilities(inputs: Inputs) -> DataFrame:
    """Current facilities of every list, located and classified."""
    status = {"active": True, "inactive": False, "sk": True, "sk_active": True, "sk_suspended": False}
    lists = [
        _with_province(
            latest_snapshot(inputs[n]).withColumn("is_active", F.lit(active)),
            "SK" if n.startswith("sk") else "AB",
        )
        for n, active in status.items()
        if n in inputs
    ]
    facilities = trim_keys(union_all(*lists), FACILITY_KEYS)
    return drop_metadata(classify(_located(facilities, inputs))).drop("snapshot_date")


def _located(df: DataFrame, inputs: Inputs) -> DataFrame:
    if "geo" in inputs:
        return enrich_geo(df, trim_keys(inputs["geo"], ["facility_id"]))
    blank = F.lit(None).cast("double")
    return df.withColumns({"centroid_lat": blank, "centroid_lon": blank})


def facility_snapshots(inputs: Inputs) -> DataFrame:
    """All snapshots of the active and inactive lists as one table.

    Rows without an id belong to no facility.
    """
    if "snapshots" in inputs:
        return trim_keys(inputs["snapshots"], FACILITY_KEYS).where("facility_id is not null")
    lists = [
        inputs[n].withColumn("is_active", F.lit(n == "active"))
        for n in ("active", "inactive")
        if n in inputs
    ]
    return trim_keys(union_all(*lists), FACILITY_KEYS).where("facility_id is not null")


def build_facility_history(inputs: Inputs) -> DataFrame:
    """Newest known attributes and the seen and active ranges per facility.

    Both lists can share a snapshot; the inactive row counts as the later one.
    """
    rows = drop_metadata(facility_snapshots(inputs))
    order = F.struct(F.col("snapshot_date"), (~F.col("is_active")).alias("inactive"))
    attributes = [c for c in rows.columns if c not in NOT_ATTRIBUTES]
    history = rows.groupBy("facility_id").agg(
        *[last_nonnull(c, order) for c in [*attributes, "is_active"]],
        *seen_range("snapshot_date", "is_active"),
    )
    history = history.withColumns(
        {
            "was_ever_active": F.col("first_active_date").isNotNull(),
            "is_currently_active": F.coalesce("is_active", F.lit(False)),
        }
    )
    return classify(_located(history, inputs))


STATUS_CHANGE_COLUMNS = [
    "facility_id", "facility_name", "operator_name", "facility_type", "sub_type",
    "event_date", "old_status", "new_status", "is_active",
    "facility_class", "facility_group", "facility_commodity", "centroid_lat", "centroid_lon",
]


def build_facility_status_changes(inputs: Inputs) -> DataFrame:
    """First sighting of every facility and each later change of status."""
    rows = facility_snapshots(inputs).withColumn("_inactive", ~F.col("is_active"))
    rows = select_present(rows, [*STATUS_CHANGE_COLUMNS, "snapshot_date", "_inactive"])
    order = F.struct("snapshot_date", "_inactive")
    columns = [c for c in rows.columns if c not in ("facility_id", "snapshot_date", "_inactive")]
    first = first_events(rows, "facility_id", "snapshot_date", columns, order).withColumns(
        {"old_status": F.lit(None).cast("string"), "new_status": status_label(F.col("is_active"))}
    )
    changed = transitions(
        rows, "facility_id", "snapshot_date", "is_active", ["snapshot_date", "_inactive"]
    ).withColumns(
        {
            "event_date": F.col("snapshot_date"),
            "old_status": status_label(F.col("prev_is_active")),
            "new_status": status_label(F.col("is_active")),
        }
    )
    kept = select_present(changed, first.columns)
    return select_present(
        classify(_located(union_all(first, kept), inputs)), STATUS_CHANGE_COLUMNS
    )


# --- production -------------------------------------------------------------


def _well(df: DataFrame) -> Column:
    """The well of a submission, whichever column names it: blank ids are no ids."""
    given = {c: F.nullif(F.trim(c), F.lit("")) for c in ("uwi", "from_to_id", "facility_id") if c in df.columns}
    ranked = [given.get("uwi")]
    if "from_to_id" in given:
        ranked += [format_uwi(given["from_to_id"]), given["from_to_id"]]
    ranked.append(given.get("facility_id"))
    return F.coalesce(*[c for c in ranked if c is not None])


def build_production(inputs: Inputs, tiebreak: Sequence[str] = ("volume",)) -> DataFrame:
    """Monthly volumes per well: newest submission of each amendment key, pivoted.

    Submissions are amended per well, not per spelling of its id. Those without
    any id can't amend each other, so all of them are kept.
    """
    parts = [
        canonicalize(df, VOLUMETRIC_ALIASES) for df in _given(inputs, ab="AB", sk="SK")
    ]
    produced = activity(union_all(*parts))
    # Only what the order and the sums read travels on.
    order = [c for c in ("snapshot_date", "file", "line_no", *tiebreak) if c in produced.columns]
    read = dict.fromkeys([*VOLUMETRIC_KEYS[1:], "volume", "province", *order])
    produced = produced.select(_well(produced).alias("uwi"), *[c for c in read if c != "uwi"])
    # A submission without an id is a group of its own: the input is read and its ids
    # are parsed once, where a union of both kinds would do so twice.
    alone = F.when(F.col("uwi").isNull(), F.monotonically_increasing_id())
    current = latest_by(
        produced.withColumn("_alone", alone),
        ["uwi", "_alone", *VOLUMETRIC_KEYS[1:]],
        _newest(produced, tiebreak),
    )
    return pivot_products(trim_keys(current, ["uwi"]))


# --- pipelines --------------------------------------------------------------


def build_pipelines(inputs: Inputs) -> DataFrame:
    """Pipeline lines of the newest feature file with centroid and length."""
    lines = latest_snapshot(inputs["lines"])
    if "coordinates" in lines.columns:
        at = line_centroid(F.col("coordinates"))
        lines = lines.withColumns(
            {
                "centroid_lon": F.round(at["lon"], 6),
                "centroid_lat": F.round(at["lat"], 6),
                "line_length": at["length"],
            }
        )
    return drop_metadata(lines).drop("snapshot_date")


def build_pipeline_installations(inputs: Inputs) -> DataFrame:
    """Pipeline installations (points) of the newest feature file."""
    points = latest_snapshot(inputs["points"])
    if "coordinates" in points.columns:
        points = points.withColumns(
            {
                "centroid_lon": F.get(F.col("coordinates"), F.lit(0)),
                "centroid_lat": F.get(F.col("coordinates"), F.lit(1)),
            }
        )
    return drop_metadata(points).drop("snapshot_date")


def build_sk_pipelines(inputs: Inputs) -> DataFrame:
    """Saskatchewan segments under the column names of the Alberta table."""
    segments = latest_snapshot(inputs["segments"])
    return (
        drop_metadata(segments)
        .drop("snapshot_date")
        .withColumnRenamed("licence_number", "licence_no")
        .withColumn("province", F.lit("SK"))
    )


# --- wells ------------------------------------------------------------------


def build_confidential_wells(inputs: Inputs) -> DataFrame:
    """Every well that was ever confidential, and whether it still is."""
    listed = trim_keys(inputs["confidential"], ["uwi"]).where("uwi is not null")
    if "release_date" not in listed.columns:
        listed = listed.withColumn("release_date", F.lit(None).cast("string"))
    order = F.col("snapshot_date")
    newest = max_of(listed, "snapshot_date")
    return (
        listed.groupBy("uwi")
        .agg(
            last_nonnull("op_name", order).alias("operator_name"),
            last_nonnull("release_date", order),
            *seen_range("snapshot_date"),
        )
        .withColumns(
            {
                "is_currently_confidential": F.col("last_seen") == newest,
                "was_ever_confidential": F.lit(True),
            }
        )
    )


def build_well_attributes(inputs: Inputs) -> DataFrame:
    """Newest well lists of both provinces, dates parsed, not deduplicated."""
    lists = [latest_snapshot(df) for df in _given(inputs, ab="AB", sk="SK")]
    keys = ["uwi", "uwi_id", "licence_no", "licensee_code", "field_code", "pool_code", "cwi"]
    wells = trim_keys(coerce_dates(union_all(*lists), WELL_ATTRIBUTE_DATES), keys)
    return drop_metadata(wells).drop("snapshot_date")


def build_wells(inputs: Inputs, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per well and province with confidentiality, position and status date.

    Inputs: ``ab`` (well list), ``sk`` (licences), ``sk_bulletin``, and for the
    enrichment ``confidential`` (the built table) and ``status`` (events).
    """
    lists = _given(inputs, ab="AB", sk="SK", sk_bulletin="SK")
    rows = trim_keys(union_all(*[latest_snapshot(df) for df in lists]), ["uwi"])
    rows = latest_by(
        rows, ["uwi", "province"], _newest(rows, tiebreak or sorted(rows.columns))
    )
    # sources under the published and under our names fill each other
    aliases = {
        new: [old, new]
        for old, new in WELLS_RENAMES.items()
        if old in rows.columns or new in rows.columns
    }
    wells = coerce_dates(canonicalize(rows, aliases), WELLS_DATES)
    if "confidential" in inputs:
        wells = enrich_confidential(wells, inputs["confidential"])
    else:
        never = F.lit(False)
        wells = wells.withColumns(
            {"was_ever_confidential": never, "is_currently_confidential": never}
        )
    wells = wells.withColumns(
        {"centroid_lat": uwi_lat(F.col("uwi")), "centroid_lon": uwi_lon(F.col("uwi"))}
    )
    if "status" in inputs:
        wells = enrich_status(wells, trim_keys(inputs["status"], ["uwi"]))
    elif "stat_date" not in wells.columns:
        wells = wells.withColumn("stat_date", F.lit(None).cast("date"))
    wells = trim_keys(wells, ["licence", "licensee", "field_code", "cwi"])
    return drop_metadata(wells).drop("snapshot_date")


def build_ownership_changes(inputs: Inputs) -> DataFrame:
    """Well renames between consecutive well lists, with both operators."""
    named = trim_keys(inputs["well_list"], ["uwi"]).where("uwi is not null")
    changes = snapshot_changes(named, "uwi", "snapshot_date", "well_name")
    return changes.withColumns(
        {
            "old_operator": first_word(F.col("old_well_name")),
            "new_operator": first_word(F.col("new_well_name")),
        }
    )


# --- activity ---------------------------------------------------------------


def build_spud_activity(inputs: Inputs, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Spuds of the daily reports, the archives and Saskatchewan, once each."""
    rows = union_all(*_given(inputs, daily="AB", archive="AB", sk="SK"))
    rows = trim_keys(rows, ["uwi", "licence_number", "licensee_code", "cwi"])
    order = _newest(rows, tiebreak or sorted(rows.columns))
    return drop_metadata(latest_by(rows, ["uwi", "spud_date", "province"], order))


def build_well_licences(inputs: Inputs, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Licences of the daily reports, the archives and Saskatchewan, once each.

    The bulletin calls the date ``issued_date``; it counts as the issue date.
    """
    rows = union_all(*_given(inputs, daily="AB", archive="AB", sk="SK"))
    dates = [F.col(c).cast("date") for c in ("issue_date", "issued_date") if c in rows.columns]
    if dates:
        rows = rows.withColumn("issue_date", F.coalesce(*dates))
    keys = ["licence_number", "uwi", "licensee_code", "licensee", "cwi"]
    rows = trim_keys(rows, keys)
    order = _newest(rows, tiebreak or sorted(rows.columns))
    return drop_metadata(latest_by(rows, ["licence_number", "province"], order))


EVENT_KEYS = ["uwi", "licence", "licensee", "licensee_code", "field_code"]


def status_events(inputs: Inputs, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Status change records, the last loaded one per well and day."""
    rows = canonicalize(union_all(*_given(inputs, weekly="AB", abandonment="AB")), STATUS_CHANGE_ALIASES)
    if "event_date" not in rows.columns:
        rows = rows.withColumn("event_date", F.col("status_change_date"))
    rows = trim_keys(drop_html(coerce_dates(rows, ["event_date"])), EVENT_KEYS)
    order = _newest(rows, tiebreak or sorted(rows.columns))
    return latest_by(rows, ["uwi", "event_date"], order)


def build_status_changes(inputs: Inputs, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Dated status changes with the position of the well (input ``wells``)."""
    events = status_events(inputs, tiebreak)
    if "wells" in inputs:
        events = enrich_wells(events, inputs["wells"])
    return drop_metadata(events).drop("snapshot_date")


def build_drilling_activity(inputs: Inputs, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Drilling and spud events of all sources, the preferred one per well and day."""

    def tagged(name: str, source: str) -> DataFrame:
        df = inputs[name]
        if "event_date" not in df.columns:
            df = df.withColumn("event_date", F.col("spud_date"))
        if name != "weekly":
            df = df.withColumn("event_type", F.lit("spud"))
        return coerce_dates(df, ["event_date"]).withColumn("source", F.lit(source))

    rows = union_all(*[tagged(n, s) for n, s in DRILLING_SOURCES.items() if n in inputs])
    rows = trim_keys(rows, EVENT_KEYS)
    order = [F.desc("source"), *_newest(rows, tiebreak or sorted(rows.columns))]
    events = latest_by(rows, ["uwi", "event_date"], order)
    if "wells" in inputs:
        events = enrich_wells(events, inputs["wells"])
    return drop_metadata(events).drop("snapshot_date")
