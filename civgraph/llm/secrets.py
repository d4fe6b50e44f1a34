"""Secret scan: known patterns, and a battery of randomness tests.

Base spans come from fixed patterns.  The battery looks at other long runs of
encoded-looking characters.  It infers the alphabet of a run and tests
whether its symbols are independent and uniform: chi-squared over the
alphabet, runs above and below the middle, serial correlation of neighbours.
Each run gets one p-value (Bonferroni over the three tests) under "random".
Runs of one alphabet and length class form a family; in each family the
Benjamini-Hochberg rule says which runs are not random, and only the others
are reported.  So the rate that is held at ``FALSE_DISCOVERY`` is that of random
runs among those called not random.  What keeps ordinary text from being reported
is power: a run must be long enough that the battery refuses nearly all words
of its alphabet and length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civgraph.llm.common import stored

# Patterns and the length that a match (assign: its second group) needs
BASE = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),  # the longest run from its first character, as with +
}
# Alphabets, narrowest first
ALPHABETS = {
    "digits": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "+/0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64url": "-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz",
}
#: Ordinary text has runs of letters of one case: the least length at which the battery
#: refuses 95 % of runs of joined words (p up to 0.01; measured on English words, 300
#: runs a length, and on those of the corpus, where less is enough).
WORDS_REFUSED = {"lower": 64, "upper": 64}
RUN = r"[A-Za-z0-9+/_-]{20,}"
FALSE_DISCOVERY = 0.01
_KINDS = [*BASE, "random"]


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches as (start, kind number, end): the text between matches and the
    matches themselves add up to the positions, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    number, empty = _KINDS.index(kind), "array<struct<start:int,kind:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(empty).alias("out"))

    def add(acc, r):
        begin = acc["at"] + r["0"]
        span = F.struct(begin.alias("start"), F.lit(number).alias("kind"), (begin + r["1"]).alias("end"))
        return F.struct((begin + F.coalesce(r["1"], F.lit(0))).alias("at"),
                        F.when(r["2"] >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    rows = F.arrays_zip(gaps, F.transform(found, lambda m: F.length(m)), F.transform(checked, lambda m: F.length(m)))
    return F.when(text.rlike(pattern), F.aggregate(rows, start, add, lambda a: a["out"])).otherwise(
        F.array().cast(empty))


def _upper_tail(z: Column) -> Column:
    """P(N > z) for z >= 0, the rational approximation of Abramowitz and Stegun 26.2.17."""
    t = 1 / (1 + 0.2316419 * z)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / 2.5066282746310002 * series


def _p_values(runs: DataFrame) -> DataFrame:
    """Adds alphabet, n and p to runs (token): chi-squared by Wilson and
    Hilferty's cube root, the two others by their normal limits."""
    token = F.col("token")
    name = reduce(lambda rest, a: F.when(F.translate(token, ALPHABETS[a], "") == "", a).otherwise(rest),
                  reversed(ALPHABETS), F.lit(None).cast("string"))
    letters = F.element_at(F.create_map(*[F.lit(x) for kv in ALPHABETS.items() for x in kv]), F.col("alphabet"))
    runs = runs.withColumn("alphabet", name).where("alphabet IS NOT NULL").withColumn("letters", letters)
    # codes and their sums; a run is one row, its characters an array
    runs = runs.withColumn("n", F.length("token")).withColumn("m", F.length("letters")).withColumn(
        "codes", F.transform(F.filter(F.split("token", ""), lambda c: c != ""), lambda c: F.instr(F.col("letters"), c) - 1))
    counts = F.aggregate(F.filter(F.split("letters", ""), lambda c: c != ""), F.lit(0.0), lambda s, c: s + F.pow(
        F.col("n") - F.length(F.replace("token", c)) - F.col("n") / F.col("m"), F.lit(2)) / (F.col("n") / F.col("m")))
    above = lambda c: (2 * c >= F.col("m")).cast("int")
    pairs = F.arrays_zip(F.slice("codes", 1, F.col("n") - 1), F.slice("codes", 2, F.col("n") - 1))
    changes = F.aggregate(pairs, F.lit(0), lambda s, p: s + (above(p["0"]) != above(p["1"])).cast("int"))
    middle = (F.col("m") - 1) / 2
    serial = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["0"] - middle) * (p["1"] - middle))
    spread = (F.col("m") * F.col("m") - 1) / 12
    tested = runs.withColumn("df", F.col("m") - 1).select(
        "*", ((F.cbrt(counts / F.col("df")) - (1 - 2 / (9 * F.col("df")))) / F.sqrt(2 / (9 * F.col("df")))).alias("z1"),
        (F.abs(changes - (F.col("n") - 1) / 2) / F.sqrt((F.col("n") - 1) / 4)).alias("z2"),
        (F.abs(serial) / (spread * F.sqrt(F.col("n") - 1))).alias("z3"))
    p1 = F.when(F.col("z1") >= 0, _upper_tail(F.col("z1"))).otherwise(1.0)
    p = F.least(F.lit(1.0), 3 * F.least(p1, 2 * _upper_tail(F.col("z2")), 2 * _upper_tail(F.col("z3"))))
    return tested.withColumn("p", F.greatest(p, F.lit(1e-12))).drop("codes", "letters", "z1", "z2", "z3", "df")


def random_runs(runs: DataFrame) -> DataFrame:
    """The runs (id columns, start, token) that stay random after the
    Benjamini-Hochberg rule in their family of alphabet and length class.

    The rule ranks steps of p-values, counted per family with partial sums; a
    step is refused if the runs up to it allow its upper end.
    """
    tested = stored(_p_values(runs).withColumn(
        "length_class", F.floor(F.log2("n"))).withColumn("step", F.floor(4 * F.log10("p"))), "tested")
    steps = tested.groupBy("alphabet", "length_class", "step").count()
    family = Window.partitionBy("alphabet", "length_class")
    upto = family.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    limit = FALSE_DISCOVERY * F.sum("count").over(upto) / F.sum("count").over(family)
    refused = steps.withColumn("ok", F.pow(F.lit(10.0), (F.col("step") + 1) / 4) <= limit).groupBy(
        "alphabet", "length_class").agg(F.max(F.when(F.col("ok"), F.col("step"))).alias("worst"))
    # power: measured for letters of one case; of other alphabets n symbols must give 96 bits
    measured = F.create_map(*[F.lit(x) for kv in WORDS_REFUSED.items() for x in kv])
    enough = F.coalesce(F.col("n") >= F.element_at(measured, F.col("alphabet")), F.col("n") * F.log2("m") >= 96)
    return tested.join(refused, ["alphabet", "length_class"]).where(
        (F.col("worst").isNull() | (F.col("step") > F.col("worst"))) & enough)


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind, end), kinds numbered
    in the order assign, access, hex, random.

    Null texts are empty.  Rows with one id are told apart by their text;
    repeated rows get the same result.  A random run that overlaps a base span
    is not reported again.  Other columns are not read; no rows give no rows.
    """
    keyed = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    base = F.array_sort(F.concat(*[_spans(text, k, *spec) for k, spec in BASE.items()]))
    found = keyed.select("doc_id", F.xxhash64("text").alias("h"), base.alias("base"),
                         _spans(text, "random", RUN, 0, 20).alias("runs"),
                         F.regexp_extract_all(text, F.lit(RUN), F.lit(0)).alias("tokens"))
    found = stored(found, "found")
    runs = found.where(F.size("runs") > 0).select("doc_id", "h", "base", F.explode(
        F.arrays_zip("runs", "tokens")).alias("r")).select(
            "doc_id", "h", F.col("r.runs").alias("span"), F.col("r.tokens").alias("token"),
            F.exists("base", lambda b: (b["start"] < F.col("r.runs.end")) & (F.col("r.runs.start") < b["end"])).alias("covered"))
    runs = runs.where(~F.col("covered")).drop("covered").distinct()
    added = random_runs(runs).groupBy("doc_id", "h").agg(F.collect_set("span").alias("added"))
    added = added.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "added")
    joined = found.join(added, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left")
    return joined.select("doc_id", "base", F.when(F.col("added").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", "added"))).alias("spans"))


def _written(spans: str) -> Column:
    names = F.array(*map(F.lit, _KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def secret_digest(documents: DataFrame) -> DataFrame:
    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == _KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return scan(documents).select(
        "doc_id", *map(count, BASE), F.sha2(_written("base").cast("binary"), 256).alias("base_sha256"),
        _written("spans").alias("spans"))
