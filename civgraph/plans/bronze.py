"""Bronze (B01-B15): raw rows plus ingestion metadata.

``SELECT *, source_file_path, current_timestamp AS dt_ingested,
release_year`` — one function for all fifteen sources.  Lazy: nothing is
materialised here, so silver's column pruning and filters reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civgraph.functions.columns import YEAR_PREFIX_PATTERN, release_year
from civgraph.sources.contracts import CONTRACTS
from civgraph.sources.readers import PATH_COL, read_raw


def to_bronze(df: DataFrame, path_col: str = PATH_COL, exercise_year: bool = False) -> DataFrame:
    cols = {"dt_ingested": F.current_timestamp(), "release_year": release_year(path_col)}
    if exercise_year:  # B09: the data year is the first "YYYY_" of the file name
        cols["exercice"] = release_year(path_col, YEAR_PREFIX_PATTERN)
    return df.withColumns(cols)


def bronze(spark: SparkSession, raw_dir: str, name: str, newest: bool = False) -> DataFrame:
    return to_bronze(read_raw(spark, raw_dir, name, newest), exercise_year=(name == "fonds_vert_subvention"))
