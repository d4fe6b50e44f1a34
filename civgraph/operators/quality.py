"""Data-quality checks.

``run_checks`` evaluates all checks of a model in ONE scan; a failing check is
a row with ``failures > 0``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civgraph.functions.columns import col_


def not_null_failures(df: DataFrame, cols: Sequence[str], test: str = "not_null") -> DataFrame:
    """(test, col, failures) for every column, from one aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (counts.unpivot([], list(cols), "col", "failures")
                  .select(F.lit(test).alias("test"), "col", F.col("failures").cast("bigint")))


def duplicate_keys(df: DataFrame, key: Column | str, name: str = "k", count_as: str = "n",
                   group_by: list[str] | None = None) -> DataFrame:
    """Key values seen more than once, with their count; NULL keys ignored.
    Partial aggregation before the shuffle keeps a hot key to one row per task.

    ``group_by``: when ``key`` is an injective, NULL-propagating rendering of
    these typed columns (e.g. two integers joined by ``-``), group on the
    columns themselves and render the key only for the duplicated groups —
    cheaper hashing and a smaller shuffle than grouping on the rendered text.
    """
    if group_by:
        keep = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group_by])
        return (df.filter(keep).groupBy(*group_by).agg(F.count(F.lit(1)).alias(count_as))
                  .filter(F.col(count_as) > 1).select(col_(key).alias(name), count_as))
    return (df.select(col_(key).alias(name)).filter(F.col(name).isNotNull())
              .groupBy(name).agg(F.count(F.lit(1)).alias(count_as))
              .filter(F.col(count_as) > 1))


def unique_failures(df: DataFrame, key: Column | str, col_name: str, test: str = "unique",
                    group_by: list[str] | None = None) -> DataFrame:
    """(test, col, failures) where failures = number of duplicated key values."""
    dups = duplicate_keys(df, key, group_by=group_by)
    return dups.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(test).alias("test"), F.lit(col_name).alias("col"), "failures")


@dataclass(frozen=True)
class Check:
    test: str                 # "not_null" | "unique"
    column: str               # column name, or a label for an expression key
    expr: str | None = None   # SQL expression for model-level unique checks
    group_by: tuple[str, ...] | None = None  # typed columns the expression renders injectively


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str, expr: str | None = None, group_by: tuple[str, ...] | None = None) -> Check:
    return Check("unique", column, expr, group_by)


def run_checks(df: DataFrame, checks: Sequence[Check], model: str) -> DataFrame:
    """All checks of a model in one scan: grouping sets over the keys of the
    unique checks, and one over which of the checked columns are NULL.  Groups
    are only counted, partially first, so a hot key is one row per task."""
    nn = [c for c in checks if c.test == "not_null"]
    keys = [(list(c.group_by) if c.group_by else [c]) for c in checks if c.test == "unique"]
    names: dict = {}  # a column per key part; equal parts share one

    def part(k) -> str:
        return names.setdefault(k.expr or k.column if isinstance(k, Check) else k, f"__k{len(names)}")

    sets = [[part(k) for k in group] for group in keys]
    exprs = [(F.expr(source) if any(isinstance(k, Check) and k.expr == source for g in keys for k in g) else F.col(source)).alias(name)
             for source, name in names.items()]
    masks = []  # which of the checked columns are NULL, a bit each
    for at in range(0, len(nn), 62):
        bits_of = [F.when(F.col(c.column).isNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(nn[at:at + 62])]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits_of).cast("long").alias(f"__m{at // 62}"))
    rows = df.select(*exprs, *masks)
    mask_names = [f"__m{i}" for i in range(len(masks))]
    wanted = [*sets, *([mask_names] if masks else [])]
    columns = [*names.values(), *mask_names]
    grouped = rows.groupingSets([[F.col(k) for k in s] for s in wanted], *[F.col(k) for k in columns]).agg(
        F.count(F.lit(1)).alias("__rows"), F.grouping_id().alias("__set"))

    def of(used: list[str]) -> Column:  # grouping_id: a bit per column that is not in the set
        return F.col("__set") == sum(1 << (len(columns) - 1 - i) for i, k in enumerate(columns) if k not in used)

    def repeated(used: list[str]) -> Column:
        there = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in used])
        return F.count_if(of(used) & (F.col("__rows") > 1) & there)

    def nulls(i: int) -> Column:
        return F.sum(F.when(of(mask_names) & (F.col(f"__m{i // 62}").bitwiseAND(F.lit(1 << i % 62)) != 0), F.col("__rows")))

    one = grouped.agg(*[repeated(s).alias(f"__u{i}") for i, s in enumerate(sets)], *[
        nulls(i).alias(f"__n{i}") for i in range(len(nn))])
    results, u, n = [], 0, 0
    for c in checks:
        if c.test == "unique":
            value, u = f"__u{u}", u + 1
        else:
            value, n = f"__n{n}", n + 1
        results.append(F.struct(F.lit(model).alias("model"), F.lit(c.test).alias("test"), F.lit(c.column).alias("col"),
                                F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias("failures")))
    return one.select(F.inline(F.array(*results)))
