"""Column -> Column helpers (scalar functions X01-X22).

Every helper is built from Spark SQL built-in expressions so it stays inside
whole-stage code generation; none of them needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the reference pipeline's.
RELEASE_YEAR_PATTERN = r"_(\d{4})"          # first "_YYYY" in a raw file name
YEAR_PREFIX_PATTERN = r"(\d{4})_"           # first "YYYY_" (fund-vert exercise year)
MASKED = "[ND]"                             # masked value in the company registry
NOT_AVAILABLE = "#N/A"                      # spreadsheet error value (regional subsidies)
NOT_COMMUNICATED = "NC"                     # "non communiqué" (offers received)
LABEL_MAX_CHARS = 200                       # graph label length

# Java's \s also matches \x0B; the reference engine's (RE2) does not.  Spell
# the class out so both engines collapse exactly the same characters.
_WS_RUN = r"[\t\n\f\r ]+"


def col_(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- X01 / bronze ---------------------------------------------------------
def release_year(path: ColumnOrName, pattern: str = RELEASE_YEAR_PATTERN) -> Column:
    """Release year taken from a file name: first ``_YYYY``; no match gives ``''``.

    Only the file's own name is searched (a directory such as ``run_2020/`` is
    never mistaken for a release); when the file is a Spark part file inside a
    ``name_YYYY.parquet/`` folder, that folder's name is the file name.
    """
    return F.regexp_extract(col_(path), pattern + r"[^/]*(?:/part-[^/]*)?$", 1)


# --- X02 / X07 / X17 / X18 text normalisation ------------------------------
def collapse_whitespace(c: ColumnOrName) -> Column:
    return F.regexp_replace(col_(c), _WS_RUN, " ")


def normalize_label(c: ColumnOrName, max_chars: int = LABEL_MAX_CHARS) -> Column:
    """CR and LF to blanks, keep the first ``max_chars`` code points, collapse
    whitespace runs, trim blanks — in this order (the cut happens before the
    collapse, so the result may be shorter than ``max_chars``)."""
    one_line = F.replace(F.replace(col_(c), F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    return F.trim(collapse_whitespace(F.left(one_line, F.lit(max_chars))))


# --- X03 / X04 / X10 sentinels and numbers ---------------------------------
def null_if(c: ColumnOrName, sentinel: str) -> Column:
    """Exact-match sentinel to NULL (``[ND]``, ``#N/A``, ``NC``, ``''``)."""
    return F.nullif(col_(c), F.lit(sentinel))


def strip_blanks(c: ColumnOrName) -> Column:
    return F.replace(col_(c), F.lit(" "), F.lit(""))


def decimal_comma(c: ColumnOrName) -> Column:
    """``1234,56`` -> 1234.56 (comma is the decimal separator). Strict cast."""
    return F.replace(col_(c).cast("string"), F.lit(","), F.lit(".")).cast("double")


def thousands_amount(c: ColumnOrName) -> Column:
    """``1 234,56`` -> 123456.0: blanks and commas are both group separators
    in this source, so both are removed before the strict cast."""
    return F.replace(strip_blanks(c), F.lit(","), F.lit("")).cast("double")


# --- X09 / X11 / X12 dates --------------------------------------------------
_ISO_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"


def parse_date(c: ColumnOrName, fmt: str = "yyyy-M-d") -> Column:
    """Strict date parse: malformed text fails the job (ANSI).

    For the ISO day format the text's shape is checked with a regex and the
    value produced by Spark's native string->date cast (no per-row formatter,
    about twice as fast); out-of-range days still fail in the cast.  Any
    other format goes through ``to_date``.
    """
    c = col_(c)
    if fmt != "yyyy-M-d":
        return F.to_date(c, fmt)
    text = c.cast("string")
    return (F.when(text.rlike(_ISO_DAY), text.cast("date"))
             .when(text.isNotNull(), F.raise_error(F.concat(F.lit("invalid date: "), text)))
             .cast("date"))


def _try_day(c: Column, fmt: str) -> Column:
    """NULL-on-failure parse of one day format.  The two slash formats of the
    subsidy files are shape-checked and fed to the native ``try_cast``
    (no per-row formatter; same results as ``try_to_date``); any other
    format goes through ``try_to_date``."""
    if fmt == "yyyy/M/d":
        return F.when(c.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"),
                      F.replace(c, F.lit("/"), F.lit("-")).try_cast("date"))
    if fmt == "d/M/yyyy":
        iso = F.concat(F.regexp_extract(c, r"/(\d{4})$", 1), F.lit("-"),
                       F.regexp_extract(c, r"^\d{1,2}/(\d{1,2})/", 1), F.lit("-"),
                       F.regexp_extract(c, r"^(\d{1,2})/", 1))
        return F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), iso.try_cast("date"))
    return F.try_to_date(c, fmt)


def parse_date_any(c: ColumnOrName, formats: Sequence[str] = ("yyyy/M/d", "d/M/yyyy")) -> Column:
    """First format that parses wins; none -> NULL.  Single ``M``/``d`` accept
    both padded and unpadded fields."""
    c = col_(c).cast("string")
    return F.coalesce(*[_try_day(c, f) for f in formats]).cast("date")


def month_start(c: ColumnOrName) -> Column:
    """``yyyy-MM`` text -> first day of that month.  Strict like
    ``to_date(c, 'yyyy-M')``: the shape is checked, the value comes from the
    native cast of ``yyyy-M-1`` (which still rejects month 13)."""
    text = col_(c).cast("string")
    return (F.when(text.rlike(r"^\d{4}-\d{1,2}$"), F.concat(text, F.lit("-1")).cast("date"))
             .when(text.isNotNull(), F.raise_error(F.concat(F.lit("invalid month: "), text)))
             .cast("date"))


def year_start(c: ColumnOrName) -> Column:
    """Year number (or numeric text) -> 1 January of that year."""
    return F.make_date(col_(c).cast("int"), F.lit(1), F.lit(1))


# --- X05 / X06 / X15 combination -------------------------------------------
def concat_skip_null(*cols: ColumnOrName) -> Column:
    """String concatenation that skips NULL arguments (all NULL: empty text)."""
    return F.concat_ws("", *[col_(c) for c in cols])


def display_name(company: ColumnOrName, first: ColumnOrName, last: ColumnOrName,
                 sentinel: str = MASKED) -> Column:
    """Company name; else trimmed ``first last``; else NULL. Masked parts are
    treated as absent."""
    person = F.trim(F.concat(F.coalesce(null_if(first, sentinel), F.lit("")), F.lit(" "),
                             F.coalesce(null_if(last, sentinel), F.lit(""))))
    return F.coalesce(null_if(company, sentinel), F.nullif(person, F.lit("")))


# --- X08 / X13 lists ---------------------------------------------------------
def list_to_text(c: ColumnOrName, sep: str = ", ") -> Column:
    """NULL list -> NULL, empty -> '', NULL items skipped."""
    return F.array_join(col_(c), sep)


def list_count(c: ColumnOrName) -> Column:
    """Number of non-NULL items; NULL list -> NULL."""
    c = col_(c)
    return F.when(c.isNotNull(), F.size(F.filter(c, lambda x: x.isNotNull())))


# --- X14 keys ---------------------------------------------------------------
def key_text(c: ColumnOrName) -> Column:
    """``length:text``, or ``N`` for NULL: no two lists of values have the same
    concatenation, whatever the values hold."""
    text = col_(c).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N"))


def surrogate_key(*cols: ColumnOrName) -> Column:
    """Deterministic md5 key over the given columns; NULL, empty text and the
    borders between columns all count."""
    return F.md5(F.concat(*[key_text(c) for c in cols]))


# --- X16 / X19 / X21 --------------------------------------------------------
def code_prefix(c: ColumnOrName, n: int) -> Column:
    return F.left(col_(c), F.lit(n))


def int_rounding(c: ColumnOrName) -> Column:
    """Text to INT the way the reference engine casts ``'1.6'`` (-> 2)."""
    return F.round(col_(c).cast("double")).cast("int")


def concat_strict(*cols: ColumnOrName) -> Column:
    """``||``: NULL if any part is NULL."""
    return F.concat(*[col_(c) for c in cols])
