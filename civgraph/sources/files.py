"""Landed files by name."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import SparkSession

from civgraph.functions.columns import RELEASE_YEAR_PATTERN


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob on any Hadoop filesystem, sorted.  Only listed:
    no job runs and no content is read."""
    try:
        files = spark.read.format("binaryFile").load(pattern).inputFiles()
    except Exception as exc:  # PATH_NOT_FOUND when nothing matches
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return []
        raise
    return sorted(unquote(f) for f in files)


_RELEASE = re.compile(RELEASE_YEAR_PATTERN + r"[^/]*(?:/part-[^/]*)?$")


def newest_files(files: list[str]) -> list[str]:
    """The files of the newest release, which their names tell (see
    ``columns.release_year``); a file without a year is older than all others."""
    years = [m.group(1) if (m := _RELEASE.search(f)) else "" for f in files]
    return [f for f, y in zip(files, years) if y == max(years)]
