"""Raw preparation steps (P01-P03), re-expressed as non-destructive
DataFrame transformations instead of in-place file rewrites."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civgraph.functions.columns import col_
from civgraph.sources.contracts import CONTRACT_ARRAYS, CONTRACT_SCHEMAS
from civgraph.sources.json_elements import read_elements

# --- P02 line repair ------------------------------------------------------------


def is_separator_only(line: str | Column, strip: bool = True) -> Column:
    """True when a line holds only ``;`` (optionally around blanks), the
    spurious header some exports start with.  ``\\z`` anchors at the very end,
    so a trailing newline is not silently accepted."""
    pattern = r"^\s*;+\s*\z" if strip else r"^;+\z"
    return col_(line).rlike(pattern)


def repair_line(line: str | Column) -> Column:
    """Over-escaped quotes: every ``\"\"\"`` becomes ``\"`` (left to right)."""
    return F.replace(col_(line), F.lit('"""'), F.lit('"'))


def repair_lines(lines: DataFrame, value: str = "value", line_no: str = "line_no") -> DataFrame:
    """Drop line 1 when it is separator-only; repair quotes on every line.

    ``lines`` carries a per-file line number (see ``readers.numbered_lines``),
    which is null beyond the first block of a file.
    """
    first_is_junk = F.col(line_no).eqNullSafe(1) & is_separator_only(value)
    return lines.filter(~first_is_junk).withColumn(value, repair_line(value))


# --- P01 nested document split -----------------------------------------------------
YEAR_IN_STEM = re.compile(r"(\d{4})")


def document_year(path: str) -> str:
    """Four-digit year in the file stem; a name without one is an error."""
    stem = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    m = YEAR_IN_STEM.search(stem)
    if not m:
        raise ValueError(f"no 4-digit year in file name: {path}")
    return m.group(1)


def split_contract_document(doc: DataFrame) -> dict[str, DataFrame]:
    """The contracts of either kind from the elements of a document (see
    ``readers.read_contract_document``), one row per element.  A field of
    another type than its schema's is null; broken JSON fails the query."""
    def parsed(kind: str, schema) -> DataFrame:
        text = F.col("element")
        whole = F.when(F.json_object_keys(text).isNull(), F.raise_error(F.concat(F.lit("not a JSON object: "), text)).cast(
            "string")).otherwise(text)
        return doc.where(F.col("kind") == kind).select(F.from_json(whole, schema).alias("r")).select("r.*")

    return {kind: parsed(kind, schema) for kind, schema in CONTRACT_SCHEMAS.items()}


def write_contract_document(doc: DataFrame, source_path: str, out_dir: str) -> dict[str, str]:
    """P01 + K03: write the two datasets as Parquet named by the document year."""
    year = document_year(source_path)
    parts = split_contract_document(doc)
    paths = {
        "marche": f"{out_dir.rstrip('/')}/commande-publique-marche_{year}.parquet",
        "concession": f"{out_dir.rstrip('/')}/commande-publique-concession_{year}.parquet",
    }
    for k, df in parts.items():
        df.write.mode("overwrite").parquet(paths[k])
    return paths


# --- P03 dispatch ---------------------------------------------------------------------
#: Steps on the numbered lines of a file; the reader applies them to the files
#: that a contract names, so nothing is rewritten in place.
PREP_STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "anct_subvention_ville_2019": repair_lines,
}


def prepare(step: str, df: DataFrame) -> DataFrame:
    """Apply a named preparation step to lines; an unknown name is an error."""
    if step not in PREP_STEPS:
        raise ValueError(f"unknown preparation step: {step}")
    return df.transform(PREP_STEPS[step])


def commande_publique(spark: SparkSession, path: str, out_dir: str) -> dict[str, str]:
    """Split a landed procurement document into its two datasets."""
    return write_contract_document(read_elements(spark, path, CONTRACT_ARRAYS), path, out_dir)


#: Steps on a landed file that write datasets of their own.
FILE_STEPS: dict[str, Callable[[SparkSession, str, str], dict[str, str]]] = {
    "commande_publique": commande_publique,
}


def post(spark: SparkSession, step: str, path: str, out_dir: str) -> dict[str, str]:
    """Run the preparation step that the catalog names for a landed file;
    returns the datasets it wrote.  Steps on lines write none: they apply when
    the file is read.  An unknown name is an error."""
    if step in PREP_STEPS:
        return {}
    if step not in FILE_STEPS:
        raise ValueError(f"unknown preparation step: {step}")
    return FILE_STEPS[step](spark, path, out_dir)
