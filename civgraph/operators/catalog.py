"""Source catalog, download history and refresh planning as DataFrame
operators (C01-C12, S21, S22).

The reference keeps these as Python objects checked one record at a time; here
the catalog and the history are DataFrames, the checks are column predicates
and the refresh plan is one LEFT join of the catalog against the latest
history row per key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civgraph.functions.columns import col_
from civgraph.sources.files import list_files

# Fixed values that must equal the reference's.
FORMATS = ("parquet", "json", "xlsx", "csv", "zip")
YEAR_PATTERN = r"^\d{4}(-\d{4})?$"
REQUIRED_FIELDS = ("name", "description", "category", "provider", "page_url", "download_url", "format")
HISTORY_COLUMNS = ("name", "description", "category", "provider", "year", "page_url",
                   "download_url", "format", "download_timestamp", "download_duration")

CATALOG_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("download_url", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("post", T.StringType()),
    T.StructField("refresh_days", T.IntegerType()),
])

HISTORY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in HISTORY_COLUMNS[:-2]]
    + [T.StructField("download_timestamp", T.TimestampNTZType()),
       T.StructField("download_duration", T.DoubleType())])


# --- C01-C03 ----------------------------------------------------------------
def year_is_valid(year: str | Column) -> Column:
    """NULL (full refresh) or ``YYYY`` / ``YYYY-YYYY``."""
    y = col_(year)
    return y.isNull() | y.rlike(YEAR_PATTERN)


def format_is_valid(fmt: str | Column) -> Column:
    """Case-sensitive membership in the allowed formats."""
    return col_(fmt).isin(list(FORMATS))


def catalog_verdict(year: str | Column, fmt: str | Column, refresh_days: str | Column) -> Column:
    """First failing rule, else ``ok``: bad_year, bad_format, missing_refresh
    (no year and no refresh period), conflicting_refresh (both set)."""
    y, r = col_(year), col_(refresh_days)
    return (F.when(~year_is_valid(y), "bad_year")
             .when(~format_is_valid(fmt), "bad_format")
             .when(y.isNull() & r.isNull(), "missing_refresh")
             .when(y.isNotNull() & r.isNotNull(), "conflicting_refresh")
             .otherwise("ok"))


# --- C04 / C05 / S21 -----------------------------------------------------------
def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog file: one JSON array of source records."""
    return spark.read.schema(CATALOG_SCHEMA).option("multiLine", True).json(path)


def validate_catalog(catalog: DataFrame) -> DataFrame:
    """All problems of a catalog as rows (name, year, problem); empty = valid.

    Per-record rules are column predicates evaluated in one pass; the
    (name, year) uniqueness rule is a grouped count where a NULL year is a
    key value of its own (Spark groups NULLs together, as the reference does).
    """
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in REQUIRED_FIELDS]
    verdict = catalog_verdict("year", "format", "refresh_days")
    per_record = (catalog.select("name", "year", F.array(*missing, F.when(verdict != "ok", verdict))
                                 .alias("problems"))
                         .select("name", "year", F.explode(F.filter("problems", lambda p: p.isNotNull()))
                                 .alias("problem")))
    return per_record.unionByName(duplicate_sources(catalog))


def duplicate_sources(catalog: DataFrame, keys=("name", "year")) -> DataFrame:
    """(name, year) pairs present more than once; a NULL year is a key
    value of its own.  Partial aggregation keeps a hot name cheap."""
    return (catalog.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") > 1).select(*keys, F.lit("duplicate").alias("problem")))


def lookup_source(catalog: DataFrame, name: str, year: str | None) -> DataFrame:
    """The record(s) with this name and year; NULL-safe on year."""
    return catalog.filter((F.col("name") == name) & F.col("year").eqNullSafe(F.lit(year)))


# --- C07 ----------------------------------------------------------------------------
def file_year(year: str | Column, now: Column | None = None) -> Column:
    now = now if now is not None else F.current_timestamp()
    return F.coalesce(col_(year), F.date_format(now, "yyyy"))


def raw_file_name(name: str | Column, year: str | Column, fmt: str | Column,
                  now: Column | None = None) -> Column:
    """``{name}_{year or current year}.{format}``; ``-`` in a year range becomes ``_``."""
    y = F.replace(file_year(year, now), F.lit("-"), F.lit("_"))
    return F.concat(col_(name), F.lit("_"), y, F.lit("."), col_(fmt))


# --- C10-C12 / S22 ----------------------------------------------------------------
def read_history(spark: SparkSession, path: str) -> DataFrame:
    """History CSV files, each record bound by its own file's header (exactly
    the 10 known columns, any order).  Another header, a record with more or
    fewer fields and a non-numeric duration are errors."""
    found = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    if set(found) != set(HISTORY_COLUMNS):
        raise ValueError(f"history has incorrect columns: expected {list(HISTORY_COLUMNS)}, got {found}")
    fields = ", ".join(f"_c{i} string" for i in range(len(HISTORY_COLUMNS)))
    lines = spark.read.schema(fields).option("mode", "FAILFAST").csv(path).select(
        F.col("_metadata.file_path").alias("__file"), F.array(*[f"_c{i}" for i in range(len(HISTORY_COLUMNS))]).alias("v"))
    is_header = F.array_sort("v") == F.array(*[F.lit(c) for c in sorted(HISTORY_COLUMNS)])
    # one header row per file, joined back on the file
    headers = lines.where(is_header).select("__file", F.col("v").alias("h")).dropDuplicates(["__file"])
    known = lines.where(~F.coalesce(is_header, F.lit(False))).join(headers, "__file", "left").select(F.map_from_arrays(F.coalesce("h", F.raise_error(
        F.lit("a history file has incorrect columns")).cast("array<string>")), "v").alias("r"))
    return known.select(*[F.col("r")[f.name].cast(f.dataType).alias(f.name) for f in HISTORY_SCHEMA.fields])


#: Files of a history that lookups read before they are merged into one.
HISTORY_FILES = 16


def _as_written(records: DataFrame) -> DataFrame:
    return records.select(*[F.col(c) for c in HISTORY_COLUMNS]).withColumn(
        "download_timestamp", F.date_format("download_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def append_history(records: DataFrame, path: str, most_files: int = HISTORY_FILES) -> None:
    """Add records; ISO timestamp text, duration as a number.  Once the
    history has more than ``most_files`` files they are merged, so that a lookup
    does not open a file per run."""
    _as_written(records).write.mode("append").option("header", True).csv(path)
    if len(list_files(records.sparkSession, path)) > most_files:
        compact_history(records.sparkSession, path)


def compact_history(spark: SparkSession, path: str) -> None:
    """Merge the files of a history into one, with the same records.

    The merged file is complete before it appears beside the old ones, which go
    last; a run that stops in between leaves records twice, which changes no
    lookup (``history_latest``, ``history_exists``)."""
    old = list_files(spark, path)
    new = f"{path.rstrip('/')}/.merged-{uuid.uuid4().hex}"  # hidden from readers
    _as_written(read_history(spark, path)).coalesce(1).write.option("header", True).csv(new)
    merged = list_files(spark, new)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for k, file in enumerate(merged):
        if not files.rename(Path(file), Path(f"{path.rstrip('/')}/merged-{uuid.uuid4().hex}-{k}.csv")):
            raise OSError(f"could not move {file}")
    if merged:
        for file in old:
            files.delete(Path(file), False)
    files.delete(Path(new), True)


def history_latest(history: DataFrame, keys=("name", "year"), ts: str = "download_timestamp",
                   out: str = "last_ts") -> DataFrame:
    """Latest download per key (partial + final max; one row per key)."""
    return history.groupBy(*keys).agg(F.max(ts).alias(out))


def history_exists(history: DataFrame, name: str, year: str) -> bool:
    """Provider and other fields are ignored; the scan stops at the first hit."""
    return bool(history.filter((F.col("name") == name) & (F.col("year") == year)).limit(1).count())


# --- C08 / C09 / J07 ------------------------------------------------------------------
def refresh_plan(catalog: DataFrame, history: DataFrame, now: Column,
                 keys=("name",), year: str | None = "year", refresh_days: str = "refresh_days",
                 ts: str = "download_timestamp") -> DataFrame:
    """Sources due for download, with ``status`` NEW / UPDATE and ``file_year``.

    A source is matched to history on ``keys`` plus (when ``year`` is given)
    its file year = its own year, or the current year for refreshed sources.
    Due when: no history row (NEW); otherwise never for dated sources;
    otherwise when ``latest download + refresh_days days < now`` (UPDATE).
    We use the LATEST history row per key (the reference's lookup returns the
    first one, contrary to its own documentation).
    """
    keys = list(keys)
    cat = catalog
    hist_keys = keys
    if year is not None:
        cat = cat.withColumn("file_year", file_year(year, now))
        hist = history_latest(history, keys + ["year"], ts).withColumnRenamed("year", "file_year")
        hist_keys = keys + ["file_year"]
    else:
        hist = history_latest(history, keys, ts)
    joined = cat.join(hist, hist_keys, "left")
    expired = (F.col("last_ts") + F.make_dt_interval(days=F.col(refresh_days).cast("int"))) < now
    is_dated = F.col(year).isNotNull() if year is not None else F.lit(False)
    due = F.col("last_ts").isNull() | (~is_dated & expired)
    return (joined.filter(due)
                  .withColumn("status", F.when(F.col("last_ts").isNull(), "NEW").otherwise("UPDATE")))
