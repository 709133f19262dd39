"""Delimited files: cells are found by the header of their own file.

Files of one dataset may differ in column order, spelling and number of
columns. The header of every file is looked up once (one small row per file,
holding the position of each canonical column) and joined to the data lines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.constants import (
    CATALOGUE_LINK_ALIASES,
    DISPOSAL_ALIASES,
    DRILLING_ALIASES,
    DRILLING_DATES,
    SK_BULLETIN_ALIASES,
    SK_BULLETIN_DATES,
    SK_DRILLING_ALIASES,
    SK_DRILLING_DATES,
    STATISTICS_HEADER_WORDS,
    STATUS_CHANGE_ALIASES,
    UWI_IN_SPUD_LINE,
    VOLUMETRIC_ALIASES,
    WELL_FACILITY_LINK_COLUMNS,
    WELL_LIST_COLUMNS,
    WELL_LIST_HEADER_CELLS,
)
from wellspring.functions.identifiers import dls, sk_uwi
from wellspring.functions.names import canonicalize, normalize_name, normalize_name_column
from wellspring.functions.text import (
    decode_text,
    file_date,
    file_product,
    file_year,
)
from wellspring.functions.values import coerce_dates
from wellspring.operators.joins import HEADER_ROWS, broadcast_up_to
from wellspring.sources.lines import file_count, file_encoding, read_lines

FILE = ["file", "member"]
QUOTED_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def cells_of(value: Column, sep: str = ",") -> Column:
    """Cells of a line; quotes are honoured for commas only."""
    if sep != ",":
        return F.split(value, f"\\Q{sep}\\E")
    quoted = F.transform(
        F.split(value, QUOTED_COMMA),
        lambda c: F.regexp_replace(F.regexp_replace(c, '^\\s*"|"\\s*$', ""), '""', '"'),
    )
    return F.when(value.contains('"'), quoted).otherwise(F.split(value, ","))


def numbered_name_column(name: Column) -> Column:
    """Header cells such as ``08.Lic#`` -> ``lic_no``."""
    bare = F.regexp_replace(F.trim(name), r"^\d{2}\.", "")
    return F.lower(F.replace(F.replace(F.trim(bare), F.lit("#"), F.lit("_no")), F.lit(" "), F.lit("_")))


def _positions(headers: DataFrame, aliases: Mapping[str, Sequence[str]], name_rule) -> DataFrame:
    """Per file: the position of every canonical column and the width."""
    names = headers.withColumn("_names", F.transform(F.col("_cells"), name_rule))

    def position(found: Sequence[str]) -> Column:
        return F.coalesce(
            *[F.nullif(F.array_position("_names", a), F.lit(0).cast("bigint")) for a in found]
        ).cast("int")

    return names.select(
        *FILE,
        F.size("_names").alias("_width"),
        *[position(found).alias(f"_at_{target}") for target, found in aliases.items()],
    )


def _pick(data: DataFrame, aliases: Mapping[str, Sequence[str]], keep: Sequence[str]) -> DataFrame:
    """Canonical columns of lines that carry ``_cells`` and their positions.

    Lines wider than their header are malformed and left out; short lines are
    padded with nulls.
    """
    return data.where(F.size("_cells") <= F.col("_width")).select(
        *keep,
        *[
            F.nullif(F.get("_cells", F.col(f"_at_{c}") - 1), F.lit("")).alias(c)
            for c in aliases
        ],
    )


def table_from_lines(
    lines: DataFrame,
    aliases: Mapping[str, Sequence[str]],
    sep: str = ",",
    name_rule=normalize_name_column,
    files: int | None = None,
) -> DataFrame:
    """Canonical columns from numbered lines whose line 0 is the header.

    ``files`` is the number of files, if the caller knows it.
    """
    split = lines.where(F.trim("value") != "").withColumn("_cells", cells_of(F.col("value"), sep))
    headers = _positions(split.where("line_no = 0"), aliases, name_rule)
    headers = broadcast_up_to(headers, files, HEADER_ROWS)
    data = split.where("line_no > 0").join(headers, FILE)
    return _pick(data, aliases, [*FILE, "line_no"])


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    aliases: Mapping[str, Sequence[str]] | None = None,
    sep: str = ",",
    name_rule=normalize_name_column,
    encoding: str | None = None,
) -> DataFrame:
    """Canonical columns from plain delimited files, every file by its header.

    Without ``aliases`` all columns of the first file are taken under their
    normalised names. Big files split into tasks: the header is recognised by
    its text, so no line numbers are needed.
    """
    if aliases is None:
        first = spark.read.csv(path, sep=sep, header=True).columns
        aliases = {normalize_name(c.lstrip("﻿")): [normalize_name(c.lstrip("﻿"))] for c in first}
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("member"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    at = F.when(F.col("_block") == 0, F.col("_id"))
    chosen = F.lit(encoding).alias("encoding") if encoding else file_encoding()
    headers = raw.groupBy(*FILE).agg(F.min_by("value", at).alias("_header"), chosen)
    headers = headers.withColumn(
        "_cells",
        cells_of(F.rtrim(decode_text(F.col("_header"), F.col("encoding"))), sep),
    )
    placed = headers.select(*FILE, "_header", "encoding").join(
        _positions(headers, aliases, name_rule), FILE
    )
    placed = broadcast_up_to(placed, len(raw.inputFiles()), HEADER_ROWS)
    data = (
        raw.join(placed, FILE)
        .where((F.col("value") != F.col("_header")) & (F.trim("value") != ""))
        .withColumn(
            "_cells",
            cells_of(
                F.regexp_replace(decode_text(F.col("value"), F.col("encoding")), "\r$", ""), sep
            ),
        )
    )
    return _pick(data, aliases, FILE)


def read_uniform_table(
    spark: SparkSession,
    path: str | Sequence[str],
    aliases: Mapping[str, Sequence[str]] | None = None,
    sep: str = ",",
    rename=normalize_name,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Canonical columns from files that all have the same header, in one pass.

    The built-in CSV source checks the header of every file; a file with another
    header fails the job instead of shifting its columns. Use ``read_table`` for
    files that differ.
    """
    options = {"sep": sep, "header": True, "encoding": encoding, "escape": '"'}
    if sep != ",":
        options["quote"] = ""
    names = spark.read.options(**options).csv(path).columns
    bad = "_malformed"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, bad]])
    raw = (
        spark.read.options(**options)
        .option("columnNameOfCorruptRecord", bad)
        .option("enforceSchema", False)
        # the width of a line is only seen when all its cells are parsed
        .option("columnPruning", False)
        .schema(schema)
        .csv(path)
    )
    too_wide = F.size(cells_of(F.col(bad), sep)) > len(names)
    kept = raw.where(F.col(bad).isNull() | ~too_wide).drop(bad)
    table = kept.toDF(*[rename(n.lstrip("﻿")) for n in names])
    return canonicalize(table, aliases) if aliases else table


# --- datasets ---------------------------------------------------------------


def shape_volumetric(table: DataFrame) -> DataFrame:
    """Volumes; a facility id that is a UWI stands in for the well."""
    as_well = F.when(F.col("facility_id").rlike(UWI_IN_SPUD_LINE), F.col("facility_id"))
    return table.withColumn("uwi", F.coalesce("uwi", as_well))


def read_volumetric(
    spark: SparkSession, path, province: str = "AB", uniform: bool = False
) -> DataFrame:
    """Monthly volumes; ``uniform`` promises one header for all files."""
    read = read_uniform_table if uniform else read_table
    table = read(spark, path, VOLUMETRIC_ALIASES)
    return shape_volumetric(table).withColumn("province", F.lit(province))


def _dated_event(table: DataFrame, kind: str) -> DataFrame:
    name = F.concat_ws("/", "file", "member")
    return table.withColumns({"event_type": F.lit(kind), "event_date": file_date(name)})


def shape_status_changes(table: DataFrame) -> DataFrame:
    return _dated_event(table, "status_change")


def read_status_changes(spark: SparkSession, path) -> DataFrame:
    return shape_status_changes(
        read_table(spark, path, STATUS_CHANGE_ALIASES, name_rule=numbered_name_column)
    )


def shape_drilling(table: DataFrame) -> DataFrame:
    return _dated_event(coerce_dates(table, DRILLING_DATES), "drilling")


def read_drilling(spark: SparkSession, path) -> DataFrame:
    return shape_drilling(
        read_table(spark, path, DRILLING_ALIASES, name_rule=numbered_name_column)
    )


LINK_ALIASES = {
    new: [normalize_name(old), old.lower()] for old, new in WELL_FACILITY_LINK_COLUMNS.items()
}


def shape_well_facility_link(table: DataFrame, province: str = "AB") -> DataFrame:
    parts = [F.col(f"well_{p}") for p in ("lsd", "sec", "twp", "rng", "mer")]
    return coerce_dates(table, ["status_date", "link_start_date"]).withColumns(
        {
            "well_dls": dls(*parts),
            "province": F.coalesce("province", F.lit(province)),
        }
    )


def read_well_facility_link(spark: SparkSession, path, province: str = "AB") -> DataFrame:
    return shape_well_facility_link(read_table(spark, path, LINK_ALIASES), province)


def read_catalogue_links(spark: SparkSession, path) -> DataFrame:
    """The older layout of the well to facility link."""
    return coerce_dates(read_table(spark, path, CATALOGUE_LINK_ALIASES), ["effective_date"])


def read_disposal(spark: SparkSession, path) -> DataFrame:
    return read_table(spark, path, DISPOSAL_ALIASES)


def shape_sk_drilling(table: DataFrame) -> DataFrame:
    """Spuds with a UWI built from the surface location where it is missing."""
    parts = ("legal_subdivision", "section", "township", "range", "meridian")
    built = sk_uwi(*[F.col(f"surface_{p}") for p in parts])
    return coerce_dates(table, SK_DRILLING_DATES).withColumns(
        {"uwi": F.coalesce("uwi", built), "province": F.lit("SK")}
    )


def read_sk_drilling(spark: SparkSession, path) -> DataFrame:
    return shape_sk_drilling(read_table(spark, path, SK_DRILLING_ALIASES))


def shape_sk_bulletin(table: DataFrame) -> DataFrame:
    return coerce_dates(table, SK_BULLETIN_DATES).withColumn("province", F.lit("SK"))


def read_sk_bulletin(spark: SparkSession, path) -> DataFrame:
    return shape_sk_bulletin(read_table(spark, path, SK_BULLETIN_ALIASES))


def read_reference_csv(spark: SparkSession, path, province: str = "SK") -> DataFrame:
    """Reference lists, infrastructure, licences, business associates."""
    return read_table(spark, path).withColumn("province", F.lit(province))


def read_pipe_table(spark: SparkSession, path) -> DataFrame:
    """Bulk well master and well production tables."""
    return read_table(spark, path, sep="|")


# --- well list --------------------------------------------------------------

WELL_LIST_ALIASES = {c: [c] for c in WELL_LIST_COLUMNS} | {
    "uwi": [normalize_name(c) for c in WELL_LIST_HEADER_CELLS]
}


def parse_well_list(lines: DataFrame, files: int | None = None) -> DataFrame:
    """The well list: tab separated, positional unless the first line is a header.

    The first line of a file gives its width: wider lines are left out, cells
    past the known columns are kept in ``extra``.
    """
    split = lines.withColumn("_cells", F.split("value", "\t"))
    first = split.where("line_no = 0").withColumn(
        "_has_header", F.upper(F.trim(F.get("_cells", F.lit(0)))).isin(WELL_LIST_HEADER_CELLS)
    )
    by_position = F.transform(F.sequence(F.lit(1), F.size("_cells")), lambda i: i)
    names = F.transform(F.col("_cells"), normalize_name_column)
    widths = first.select(
        *FILE,
        "_has_header",
        F.size(by_position).alias("_width"),
        *[
            F.when(
                F.col("_has_header"),
                F.coalesce(
                    *[
                        F.nullif(F.array_position(names, a), F.lit(0).cast("bigint"))
                        for a in WELL_LIST_ALIASES[c]
                    ]
                ),
            )
            .otherwise(i + 1)
            .cast("int")
            .alias(f"_at_{c}")
            for i, c in enumerate(WELL_LIST_COLUMNS)
        ],
    )
    known = len(WELL_LIST_COLUMNS)
    widths = broadcast_up_to(widths, files, HEADER_ROWS)
    data = (
        split.join(widths, FILE)
        .where(~F.col("_has_header") | (F.col("line_no") > 0))
        .where(F.trim("value") != "")
        .withColumn(
            "extra",
            F.when(
                F.size("_cells") > known, F.slice("_cells", known + 1, F.size("_cells"))
            ),
        )
    )
    return _pick(data, {c: [c] for c in WELL_LIST_COLUMNS}, [*FILE, "line_no", "extra"])


def read_well_list(spark: SparkSession, path) -> DataFrame:
    return parse_well_list(read_lines(spark, path, "latin-1"), file_count(spark, path))


# --- provincial statistics --------------------------------------------------


def shape_provincial_stats(lines: DataFrame) -> DataFrame:
    """Statistics sheets exported as CSV: one row per line, values by column name.

    The header is the first line that mentions a month or a year; product and
    year come from the file name.
    """
    word = "(?i)" + "|".join(STATISTICS_HEADER_WORDS)
    split = lines.withColumn("_cells", cells_of(F.col("value")))
    at = F.struct((~F.col("value").rlike(word)).alias("plain"), F.col("line_no"))
    headers = split.groupBy(*FILE).agg(
        F.min_by(F.struct("line_no", "_cells"), at).alias("_header")
    )
    stem = F.regexp_extract("file", r"([^/]+)$", 1)
    filled = F.exists("_cells", lambda c: F.trim(c) != "")
    return (
        split.join(headers, FILE)
        .where((F.col("line_no") > F.col("_header.line_no")) & filled)
        .select(
            *FILE,
            "line_no",
            file_product(stem).alias("product_type"),
            file_year(stem).alias("source_year"),
            F.map_from_entries(
                F.filter(
                    F.zip_with(
                        F.transform("_header._cells", normalize_name_column),
                        F.transform("_cells", lambda c: F.nullif(F.trim(c), F.lit(""))),
                        lambda name, cell: F.struct(name.alias("name"), cell.alias("cell")),
                    ),
                    lambda e: e["name"] != "",
                )
            ).alias("values"),
        )
    )


