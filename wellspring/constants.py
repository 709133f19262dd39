"""Formats, word lists, column names and factors.

Everything in this module is a published format or a convention that results
depend on. There is no logic here.
"""

# --- identifiers -----------------------------------------------------------
UWI_DISPLAY = r"^\d{2}/\d{2}-\d{2}-\d{3}-\d{2}W\d/\d+$"
UWI_IN_SPUD_LINE = r"(\d{2}/\d{2}-\d{2}-\d{3}-\d{2}W\d/\d)"
UWI_IN_LICENCE_LINE = r"(\d{3}/\d{2}-\d{2}-\d{3}-\d{2}W\d/\d{2})"
LICENCE_IN_SPUD_LINE = r"(\d{7})"
LICENCE_START_LINE = r"\s(\d{7})\s+(ALBERTA CROWN|FREEHOLD|CROWN)"
LICENCE_LABEL_LINE = r"^\s*(UWI|WELL NAME|BOTTOMHOLE|LICENCE):"
LEGAL_IN_LICENCE_LINE = r"\d{2}-\d{2}-\d{3}-\d{2}W\d"
FACILITY_ID_TOKEN = r"[A-Z0-9]{5,}"
COMPACT_PREFIX = r"(?i)^(AB|SK)WI"

# --- Dominion Land Survey ---------------------------------------------------
SURVEY_UWI = (
    r"^(\d{2})[/\\]?(\d{2})-?(\d{2})-?(\d{3})-?(\d{2})([WE])(\d)[/\\]?(\d)$"
)
SURVEY_BASE_LATITUDE = 49.0
SURVEY_BASE_LONGITUDE = {2: -102.0, 3: -106.0, 4: -110.0, 5: -114.0, 6: -118.0}
DEGREES_PER_TOWNSHIP = 0.087
RANGE_WIDTH_KM = 9.656
KM_PER_DEGREE_AT_EQUATOR = 111.32

# --- units ------------------------------------------------------------------
BARRELS_PER_M3 = "6.29287"
MCF_PER_E3M3 = "35.3147"
FEET_PER_METRE = "3.28084"

# --- facility classes: the first row whose word sets all occur wins ---------
FACILITY_CLASSES = [
    ("bitumen_battery", [["battery"], ["bitumen", "sagd", "thermal", "oil sands"]]),
    ("gas_battery", [["battery"], ["gas", "ngl"]]),
    ("oil_battery", [["battery"]]),
    ("gas_plant", [["plant", "fractionation", "refinery", "sulphur"], ["gas"]]),
    ("plant", [["plant", "fractionation", "refinery", "sulphur"]]),
    ("compressor", [["compressor"]]),
    ("gathering", [["gathering"]]),
    ("meter", [["meter", "regulator"]]),
    ("terminal", [["terminal", "tank"]]),
    ("storage", [["storage"]]),
    ("disposal", [["disposal", "inject", "waste"]]),
    ("treating", [["treat"]]),
]
FACILITY_CLASS_DEFAULT = "other"
FACILITY_GROUPS = {
    "Battery": ["oil_battery", "gas_battery", "bitumen_battery"],
    "Plant": ["gas_plant", "plant", "compressor", "treating"],
    "Gathering/Meter": ["gathering", "meter"],
    "Storage/Terminal": ["terminal", "storage"],
    "Injection/Disposal": ["disposal"],
}
FACILITY_GROUP_DEFAULT = "Other"
FACILITY_COMMODITIES = [
    ("Crude", [["crude", "oil", "bitumen", "sagd", "thermal"]]),
    ("Gas", [["gas", "ngl"]]),
]
FACILITY_COMMODITY_DEFAULT = "Other"
FACILITY_TEXT_COLUMNS = ["sub_type", "facility_type", "facility_name"]

# --- operator names ---------------------------------------------------------
OPERATOR_SPELLINGS = [
    (r"\s+", " "),
    (r"(?i)\bCORPORATION\b", "CORP"),
    (r"(?i)\bCORP\.?\b", "CORP"),
    (r"(?i)\bINCORPORATED\b", "INC"),
    (r"(?i)\bINC\.?\b", "INC"),
]

# --- header names -----------------------------------------------------------
NAME_SEPARATORS = r"[\s\-/.()]+"
NAME_CAMEL = r"([a-z])([A-Z])"

# --- column layouts ---------------------------------------------------------
WELL_LIST_COLUMNS = [
    "uwi", "uwi_id", "update_flag", "well_name", "field_code", "pool_code",
    "os_area_code", "os_dep_code", "licence_no", "licence_status",
    "licence_issue_date", "licensee_code", "agent_code", "operator_code",
    "fin_drl_date", "well_total_depth", "well_stat_code", "well_stat_date",
    "fluid", "mode", "type", "structure",
]
WELL_LIST_HEADER_CELLS = ["UWI", "UWI_DISPLAY_FORMAT", "UWID"]

# name, first character (0-based), end
CONFIDENTIAL_FIELDS = [
    ("uwi", 0, 21),
    ("licence", 21, 31),
    ("op_code", 31, 38),
    ("op_name", 38, 74),
    ("conf_type", 74, 110),
    ("release_date", 110, 130),
]
CONFIDENTIAL_NOISE = ["---", "===", "UWI", "DIE", "Page", "Confidential"]
CONFIDENTIAL_NO_DATE = "no date avail"

VOLUMETRIC_ALIASES = {
    "productionmonth": ["productionmonth", "production_month"],
    "activityid": ["activityid", "activity_id"],
    "productid": ["productid", "product_id"],
    "volume": ["volume", "oil_prod_vol"],
    "energy": ["energy"],
    "heat": ["heat"],
    "hours_on": ["hours_on", "hours"],
    "from_to_id": [
        "fromtoididentifier", "from_to_id_identifier", "from_to_ididentifier",
        "fromtoidentifier", "from_to_identifier", "fromtoid", "from_to_id",
    ],
    "uwi": ["uwi", "well"],
    "facility_id": ["facility_id"],
    "operator_ba_id": ["operator_ba_id", "operator_baid"],
    "operator_name": ["operator_name"],
    "reporting_facility_id": ["reporting_facility_id"],
}
VOLUMETRIC_KEYS = ["from_to_id", "productionmonth", "activityid", "productid"]
PRODUCTS = {"OIL": "oil_prod_vol", "GAS": "gas_prod_vol", "WATER": "water_prod_vol"}

STATUS_CHANGE_ALIASES = {
    "uwi_unformatted": ["unformatted_uwi", "uwi_unformatted"],
    "uwi": ["formatted_uwi", "uwi"],
    "name": ["well_name", "name"],
    "licence": ["lic_no", "licence"],
    "licensee_code": ["licensee", "licensee_code"],
    "field_code": ["fld", "field_code"],
    "field_name": ["field_name"],
    "new_status_code": ["statcurr", "new_status_code"],
    "new_status": ["statcurrdesc", "new_status"],
    "old_status_code": ["statprev", "old_status_code"],
    "old_status": ["statprevdesc", "old_status"],
}
DRILLING_ALIASES = {
    "uwi_unformatted": ["unformatted_uwi", "uwi_unformatted"],
    "uwi": ["formatted_uwi", "uwi"],
    "name": ["well_name", "name"],
    "well_class": ["aer_classification", "well_class"],
    "stat_date": ["statdate", "stat_date"],
    "status_desc": ["statuscdesc", "status_desc"],
    "bottom_location": ["bottom_location"],
    "surface_location": ["surface_location"],
    "licence": ["lic_no", "lic", "licence"],
    "licensee_code": ["licenseebaid", "licensee_code"],
    "ground_elev": ["gr_elev", "ground_elev"],
    "kb_elev": ["kb_elev"],
    "field_code": ["field_id", "field_code"],
    "drill_date": ["fdd", "drill_date"],
    "total_depth": ["final_td", "total_depth"],
    "spud_date": ["spuddate", "spud_date"],
    "max_tvd": ["max_tvd"],
}
DRILLING_DATES = ["stat_date", "drill_date", "spud_date"]

# published header -> our column
WELL_FACILITY_LINK_COLUMNS = {
    "WellID": "well_id",
    "WellProvinceState": "province",
    "WellType": "well_type",
    "WellIdentifier": "well_identifier",
    "WellLocationException": "location_exception",
    "WellLegalSubdivision": "well_lsd",
    "WellSection": "well_sec",
    "WellTownship": "well_twp",
    "WellRange": "well_rng",
    "WellMeridian": "well_mer",
    "WellEventSequence": "event_sequence",
    "WellName": "well_name",
    "WellStatusFluid": "fluid",
    "WellStatusMode": "mode",
    "WellStatusType": "type",
    "WellStatusStructure": "structure",
    "WellStatusFluidCode": "fluid_code",
    "WellStatusModeCode": "mode_code",
    "WellStatusTypeCode": "type_code",
    "WellStatusStructureCode": "structure_code",
    "WellStatusStartDate": "status_date",
    "LinkedFacilityID": "linked_facility_id",
    "LinkedFacilityProvinceState": "facility_province",
    "LinkedFacilityType": "linked_facility_type",
    "LinkedFacilityIdentifier": "facility_identifier",
    "LinkedFacilityName": "facility_name",
    "LinkedFacilitySubType": "linked_facility_sub_type",
    "LinkedFacilitySubTypeDesc": "facility_sub_type_desc",
    "LinkedStartDate": "link_start_date",
    "LinkedFacilityOperatorBAID": "facility_operator_ba_id",
    "LinkedFacilityOperatorName": "facility_operator_name",
}
# the older catalogue layout of the same link
CATALOGUE_LINK_ALIASES = {
    "uwi": ["uwi", "well_id", "well_identifier"],
    "well_name": ["well_name"],
    "well_status": ["well_status"],
    "facility_id": ["facility_id", "linked_facility_id"],
    "facility_name": ["facility_name", "linked_facility_name"],
    "facility_subtype": ["facility_sub_type", "linked_facility_sub_type"],
    "operator_ba_id": ["operator_ba_id", "linked_facility_operator_ba_id"],
    "effective_date": ["effective_date"],
}
DISPOSAL_ALIASES = {
    "uwi": ["uwi", "well_id", "well_identifier"],
    "approval_number": ["approval_number", "approval_no"],
    "approval_holder": ["approval_holder", "operator"],
    "scheme_type": ["scheme_type"],
    "scheme_subtype": ["scheme_subtype", "scheme_sub_type"],
    "scheme_status": ["scheme_status", "status"],
}
SK_DRILLING_ALIASES = {
    "cwi": ["canadian_well_identifier", "cwi"],
    "uwi": ["uwi"],
    "spud_date": ["drilling_start_date", "spud_date"],
    "rig_release_date": ["rig_release_date"],
    "drilling_end_date": ["drilling_end_date"],
    "drilling_contractor": ["contractor_name", "drilling_contractor"],
    "licence_number": ["licence_number"],
    "licensee": ["licensee_name", "licensee"],
    "licensee_code": ["licensee_baid", "licensee_code"],
    "surface_legal_subdivision": ["surface_legal_subdivision"],
    "surface_section": ["surface_section"],
    "surface_township": ["surface_township"],
    "surface_range": ["surface_range"],
    "surface_meridian": ["surface_meridian"],
}
SK_DRILLING_DATES = ["spud_date", "rig_release_date", "drilling_end_date"]
SK_BULLETIN_ALIASES = {
    "licence_number": ["licence_number"],
    "licence_status": ["licence_status"],
    "status_date": ["status_date"],
    "issued_date": ["issued_date"],
    "cancelled_date": ["cancelled_date"],
    "licensee": ["licensee", "licensee_address"],
    "trajectory": ["trajectory"],
    "cwi": ["cwi"],
    "uwi": ["uwi"],
    "well_completion_type": ["well_completion_type"],
    "pool_name": ["target_pool_name", "pool_name"],
    "pool_code": ["target_pool_code", "pool_code"],
    "measured_depth": ["measured_depth"],
    "tvd": ["true_vertical_depth", "tvd"],
    "ground_elev": ["ground_elevation", "ground_elev"],
    "surface_location": ["surface_land_description", "surface_location"],
    "bottom_location": ["bottom_hole_land_description", "bottom_location"],
}
SK_BULLETIN_DATES = ["status_date", "issued_date", "cancelled_date"]

# GeoJSON property -> our column
LINE_FEATURE_PROPERTIES = {
    "LICENCENUMBER": "licence_number",
    "OWNERNAME": "licensee",
    "SUBSTANCE": "substance",
    "SEGMENTIDENTIFIER": "segment_id",
    "SEGMENTNUMBER": "segment_number",
    "SEGMENTSTATUS": "status",
    "LICENCETYPE": "licence_type",
    "PIPELINENAME": "pipeline_name",
    "SHAPE.LEN": "length_m",
}
STATISTICS_PRODUCTS = ["oil", "gas", "ngl", "butane", "ethane", "propane"]
STATISTICS_HEADER_WORDS = ["month", "year", "january"]

# --- silver renames ---------------------------------------------------------
WELLS_RENAMES = {
    "well_name": "name",
    "licensee_code": "licensee",
    "licence_status": "lic_status",
    "licence_no": "licence",
    "well_stat_date": "stat_date",
    "well_stat_code": "stat_code",
    "fin_drl_date": "drill_date",
    "well_total_depth": "total_depth",
}
WELLS_DATES = ["stat_date", "drill_date", "licence_issue_date"]
WELL_ATTRIBUTE_DATES = ["well_stat_date", "fin_drl_date", "licence_issue_date"]

# source tags of drilling events; the last in order wins for a well and day
DRILLING_SOURCES = {
    "weekly": "st2_drilling",
    "daily": "st49_spud",
    "archive": "st49_spud_archive",
}

# --- data quality -----------------------------------------------------------
MAX_NULL_SHARE = 0.5
MIN_UWI_SHARE = 0.5
FUTURE_DAYS_ALLOWED = 60
EARLIEST_DATE = "1900-01-01"
STALE_AFTER_DAYS = 90
