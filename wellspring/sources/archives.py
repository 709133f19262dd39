"""Zip archives, also nested ones, as lines.

This is the only Python worker code of the scans. An archive cannot be split,
so archives are the unit of work; lines leave a worker in small batches and
are never held for a whole member.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from wellspring.sources.lines import LINE_SCHEMA

FALLBACKS = ("utf-8-sig", "utf-8", "cp1252", "latin-1")
BATCH = 20_000


def _is_zip(data: bytes) -> bool:
    return data[:2] == b"PK"


def _is_html(data: bytes) -> bool:
    head = data[:200].lower()
    return b"<html" in head or b"<!doctype" in head


def _wanted(archive: zipfile.ZipFile, suffix: str, prefer: str) -> list[str]:
    """All text members; only those with the preferred name where there are any."""
    names = [n for n in archive.namelist() if n.lower().endswith(suffix)]
    return [n for n in names if prefer and prefer in n.lower()] or names


def _members(data: bytes, suffix: str, prefer: str) -> Iterator[tuple[str, bytes | zipfile.ZipExtFile]]:
    """The text members of an archive and of every archive inside it.

    Broken inner archives are left out, as is anything that is not a zip.
    """
    try:
        outer = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile:
        return
    with outer:
        for name in _wanted(outer, suffix, prefer):
            yield name, outer.read(name)
        for inner in (n for n in outer.namelist() if n.lower().endswith(".zip")):
            for member, content in _members(outer.read(inner), suffix, prefer):
                yield f"{inner}/{member}", content


def _encoding(data: bytes, encodings: Sequence[str]) -> str:
    for encoding in encodings[:-1]:
        try:
            with io.TextIOWrapper(io.BytesIO(data), encoding=encoding) as text:
                while text.read(1 << 20):
                    pass
            return encoding
        except UnicodeDecodeError:
            continue
    return encodings[-1]


def _lines(file: str, member: str, data: bytes, encodings: Sequence[str]) -> Iterator[pd.DataFrame]:
    if _is_html(data):
        return
    encoding = _encoding(data, encodings)
    with io.TextIOWrapper(io.BytesIO(data), encoding=encoding, newline="\n") as text:
        batch: list[str] = []
        start = 0
        for line in text:
            batch.append(line.rstrip("\r\n"))
            if len(batch) == BATCH:
                yield _frame(file, member, start, batch)
                start, batch = start + BATCH, []
        if batch:
            yield _frame(file, member, start, batch)


def _frame(file: str, member: str, start: int, values: list[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "file": file,
            "member": member,
            "line_no": range(start, start + len(values)),
            "value": values,
        }
    )


def archive_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    suffix: str = ".txt",
    prefer: str = "",
    encodings: Sequence[str] = ("latin-1",),
) -> DataFrame:
    """Lines of the text members of archives (plain files pass through)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return expand_archives(files, suffix, prefer, encodings)


def expand_archives(
    files: DataFrame,
    suffix: str = ".txt",
    prefer: str = "",
    encodings: Sequence[str] = ("latin-1",),
) -> DataFrame:
    """Lines of archives given as (path, content) rows.

    Of several members with the suffix the first counts, or the first whose
    name contains ``prefer``. HTML error pages give no lines. For CSV members
    pass ``suffix=".csv", encodings=FALLBACKS``.
    """

    def expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"]):
                if not _is_zip(content):
                    yield from _lines(file, "", content, encodings)
                    continue
                for member, data in _members(content, suffix, prefer):
                    yield from _lines(file, member, data, encodings)

    return files.select("path", "content").mapInPandas(expand, LINE_SCHEMA)
