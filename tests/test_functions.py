import datetime as dt

import pytest
from pyspark.sql import functions as F

from wellspring.functions import facility, identifiers, survey, text, values
from wellspring.functions.names import (
    canonicalize,
    normalize_name,
    normalize_name_column,
    without_number_prefix,
)


@pytest.fixture
def apply(spark):
    """Value of a Column function over literal string arguments."""

    def run(fn, *args):
        df = spark.createDataFrame([args], ",".join(f"a{i} string" for i in range(len(args))))
        return df.select(fn(*[F.col(f"a{i}") for i in range(len(args))])).collect()[0][0]

    return run


NAMES = [
    ("Facility ID", "facility_id"),
    ("ProductionMonth", "production_month"),
    ("Well/Facility ID", "well_facility_id"),
    (" BA (Name) ", "ba_name"),
    ("UWI", "uwi"),
    ("_a..b-c_", "a_b_c"),
]


@pytest.mark.parametrize("raw, want", NAMES)
def test_normalize_name(raw, want, apply):
    assert normalize_name(raw) == want
    assert apply(normalize_name_column, raw) == want


def test_number_prefix():
    assert without_number_prefix("08.Lic#") == "lic_no"
    assert without_number_prefix("00.UnFormatted UWI") == "unformatted_uwi"


@pytest.mark.parametrize(
    "raw, want",
    [
        ("ABWI100010100308W402", "00/01-01-003-08W4/2"),
        ("SKWI100010100308W202", "00/01-01-003-08W2/2"),
        ("abwi102010100308W400", "02/01-01-003-08W4/0"),
        ("100010100308W412", "00/01-01-003-08W4/12"),
        ("short", "short"),
        ("ABWI100010100308W4XX", "00/01-01-003-08W4/XX"),
        (None, None),
    ],
)
def test_format_uwi(raw, want, apply):
    assert apply(identifiers.format_uwi, raw) == want


def test_normalized_uwi(apply):
    uwi = "00/01-01-003-08W2/2"
    assert apply(identifiers.normalized_uwi, "SK", uwi) == "100010100308W220"
    assert apply(identifiers.normalized_uwi, "AB", uwi) == uwi
    assert apply(identifiers.normalized_uwi, "SK", "plain") == "plain"


def test_dls_needs_every_part(apply):
    assert apply(identifiers.dls, "1", "2", "3", "4", "4") == "01-02-003-04W4"
    assert apply(identifiers.dls, "1", " ", "3", "4", "4") is None
    assert apply(identifiers.dls, "1", None, "3", "4", "4") is None


def test_sk_uwi(apply):
    assert apply(identifiers.sk_uwi, "1", "2", "3", "4", "W2") == "00/01-02-003-04W2/0"
    assert apply(identifiers.sk_uwi, "1", "2", "3", "4", "2") == "00/01-02-003-04W2/0"


def test_legal_location_with_both_exceptions(apply):
    assert apply(identifiers.legal_location, "00/01-02-003-04W5/0") == "01-02-003-04W5"
    assert apply(identifiers.legal_location, "100/01-02-003-04W5/00") == "01-02-003-04W5"


def brute_position(lsd, section, township, rng, meridian):
    """The survey grid counted square by square."""
    import math

    rows = [[(r * 6 + c + 1) for c in range(6)][:: (-1 if r % 2 else 1)] for r in range(6)]
    row = next(i for i, line in enumerate(rows) if section in line)
    column = rows[row].index(section)
    height = 0.087 / 6
    lat = 49 + 0.087 * (township - 1) + height * (row + 0.5)
    lat += height / 4 * ((lsd - 1) // 4 + 0.5)
    width = 9.656 / (111.32 * math.cos(math.radians(lat)))
    lon = {2: -102, 3: -106, 4: -110, 5: -114, 6: -118}[meridian] - width * (rng - 1)
    lon -= width / 6 * (column + 0.5) + width / 24 * ((lsd - 1) % 4 + 0.5)
    return lat, lon


@pytest.mark.parametrize("where", [(1, 1, 1, 1, 4), (16, 36, 126, 30, 6), (5, 7, 40, 3, 2), (6, 12, 8, 9, 5)])
def test_survey_position(where, apply):
    lsd, section, township, rng, meridian = where
    uwi = f"00/{lsd:02}-{section:02}-{township:03}-{rng:02}W{meridian}/0"
    lat, lon = brute_position(*where)
    assert apply(survey.uwi_lat, uwi) == pytest.approx(lat, abs=2e-6)
    assert apply(survey.uwi_lon, uwi) == pytest.approx(lon, abs=2e-6)


@pytest.mark.parametrize("uwi", ["00/01-01-001-01W7/0", "nonsense", None, "00/01-01-001-01W1/0"])
def test_survey_position_unknown(uwi, apply):
    assert apply(survey.uwi_lat, uwi) is None
    assert apply(survey.uwi_lon, uwi) is None


@pytest.mark.parametrize(
    "name, cls, group, commodity",
    [
        ("SAGD Bitumen Battery", "bitumen_battery", "Battery", "Crude"),
        ("Gas Multiwell Battery", "gas_battery", "Battery", "Gas"),
        ("Crude Oil Single-Well Battery", "gas_battery", "Battery", "Crude"),
        ("Battery", "oil_battery", "Battery", "Other"),
        ("Sulphur Plant", "plant", "Plant", "Other"),
        ("Gas Plant", "gas_plant", "Plant", "Gas"),
        ("Compressor", "compressor", "Plant", "Other"),
        ("Gas Gathering", "gathering", "Gathering/Meter", "Gas"),
        ("Regulator Station", "meter", "Gathering/Meter", "Other"),
        ("Cavern Storage", "storage", "Storage/Terminal", "Other"),
        ("Tank Storage", "terminal", "Storage/Terminal", "Other"),
        ("Water Injection", "disposal", "Injection/Disposal", "Other"),
        ("Treating", "treating", "Plant", "Other"),
        ("", "other", "Other", "Other"),
        (None, "other", "Other", "Other"),
    ],
)
def test_facility_labels(name, cls, group, commodity, apply):
    assert apply(facility.facility_class, name) == cls
    assert apply(lambda c: facility.facility_group(facility.facility_class(c)), name) == group
    assert apply(facility.facility_commodity, name) == commodity


@pytest.mark.parametrize(
    "raw, want",
    [
        ("  Acme   Corporation ", "ACME CORP"),
        ("Acme Corp Ltd", "ACME CORP LTD"),
        ("Acme Corp.", "ACME CORP."),
        ("Acme Incorporated", "ACME INC"),
        (None, ""),
    ],
)
def test_normalize_operator(raw, want, apply):
    assert apply(text.normalize_operator, raw) == want


def test_clean_key(apply):
    assert apply(text.clean_key, "  x ") == "x"
    assert [apply(text.clean_key, v) for v in ("", "  ", "nan", None)] == [None] * 4


@pytest.mark.parametrize(
    "raw, want",
    [
        ("20240131", dt.date(2024, 1, 31)),
        ("2024-01-31", dt.date(2024, 1, 31)),
        (" 01/31/2024", dt.date(2024, 1, 31)),
        ("31/01/2024", None),
        ("20240231", None),
        ("2024", None),
        ("nan", None),
        ("2024-1-31x", None),
        (None, None),
        ("2024-01-31 13:45:00", dt.date(2024, 1, 31)),
        ("2024-01-31T13:45:00.123Z", dt.date(2024, 1, 31)),
        ("2024/01/31", dt.date(2024, 1, 31)),
        ("1/5/2024", dt.date(2024, 1, 5)),
        ("2024-1-5", dt.date(2024, 1, 5)),
        ("Jan 31, 2024", dt.date(2024, 1, 31)),
        ("31-Jan-2024", dt.date(2024, 1, 31)),
        ("January 5 2024", dt.date(2024, 1, 5)),
        ("1/5/2024 3:04 PM", dt.date(2024, 1, 5)),
        ("Foo 5, 2024", None),
        ("13/13/2024", None),
    ],
)
def test_coerce_date(raw, want, apply):
    assert apply(values.coerce_date, raw) == want


def test_coerce_num(apply):
    assert [float(apply(values.coerce_num, v)) for v in ("1.5", " 2 ", "***", None)] == [
        1.5, 2.0, 0.0, 0.0,
    ]


def test_months_crossed_counts_boundaries(spark):
    df = spark.sql("select date'2024-01-31' a, date'2024-02-01' b, date'2025-01-01' c")
    months = values.months_crossed
    assert tuple(
        df.select(months(F.col("a"), F.col("b")), months(F.col("a"), F.col("c"))).first()
    ) == (1, 12)


def test_file_name_parts(apply):
    assert apply(text.file_date, "x/2026-02-21_Weekly.csv") == dt.date(2026, 2, 21)
    assert apply(text.file_period, "spud2024.zip") == "2024"
    assert apply(text.file_period, "dwll2025-03.zip") == "2025-03"
    assert apply(text.file_product, "ST3_Gas_prices.csv") == "gas_prices"
    assert apply(text.file_product, "x.csv") == "unknown"


def test_canonicalize_fills_from_later_alias(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    out = canonicalize(df, {"k": ["x", "y"], "z": ["nope"]})
    assert [tuple(r) for r in out.collect()] == [("a", None), ("b", None)]


@pytest.mark.parametrize(
    "data, want",
    [
        ("é".encode(), "é"),
        ("é".encode("latin-1"), "é"),
        ("€ and “é”".encode("cp1252"), "€ and “é”"),
        (b"\x81\xe9", "\x81é"),
    ],
)
def test_decode_text(data, want, spark):
    df = spark.createDataFrame([(bytearray(data),)], "b binary")
    raw = F.col("b").cast("string")
    assert df.select(text.decode_text(raw)).first()[0] == want


def test_line_centroid(spark):
    df = spark.sql(
        "select array(array(0D, 0D), array(4D, 0D), array(4D, 2D)) a, array(array(1D, 2D)) b"
    )
    at, point = df.select(survey.line_centroid(F.col("a")), survey.line_centroid(F.col("b"))).first()
    assert (at["lon"], at["lat"], at["length"]) == (pytest.approx(16 / 6), pytest.approx(2 / 6), 6.0)
    assert (point["lon"], point["lat"], point["length"]) == (1.0, 2.0, 0.0)
