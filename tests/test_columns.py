import pytest
from pyspark.sql import functions as F

from civgraph.functions import columns as X
from civgraph.functions.names import camel_to_snake


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_camel_to_snake():
    assert camel_to_snake("statutDiffusionUniteLegale") == "statut_diffusion_unite_legale"
    assert camel_to_snake("prenom1UniteLegale") == "prenom1_unite_legale"
    assert camel_to_snake("denominationUsuelle1UniteLegale") == "denomination_usuelle1_unite_legale"
    assert camel_to_snake("activitePrincipaleNAF25UniteLegale") == "activite_principale_naf25_unite_legale"
    assert camel_to_snake("codePostal2Etablissement") == "code_postal2_etablissement"
    assert camel_to_snake("siren") == "siren"


@pytest.mark.parametrize("path,year", [
    ("/data/raw/communes-france_2026.csv", "2026"),
    ("/x/run_2020/communes-france_2026.csv", "2026"),          # directory ignored
    ("/r/anct-subvention-ville-2025_2026.csv", "2026"),
    ("/r/src_2024_2026.csv", "2024"),                          # first match in the name
    ("/r/no-year.csv", ""),                                    # no match -> ''
    ("/r/commande-publique-marche_2025.parquet/part-00000-abc.snappy.parquet", "2025"),
])
def test_release_year(spark, path, year):
    assert one(spark, X.release_year("v"), path) == year


def test_exercise_year(spark):
    assert one(spark, X.release_year("v", X.YEAR_PREFIX_PATTERN), "/r/fonds-vert-subvention-2023_2026.csv") == "2023"


def test_normalize_label_order(spark):
    text = "a\r\nb  \t c" + "x" * 300
    out = one(spark, X.normalize_label("v"), text)
    assert out.startswith("a b c")
    assert len(out) <= 200 and "\n" not in out and "  " not in out
    # cut happens before collapsing: 200 code points incl. the collapsed blanks
    assert len(out) == 200 - 4
    assert one(spark, X.normalize_label("v"), "  é\x0bz  ") == "é\x0bz"  # \x0B is kept (RE2 parity)
    assert one(spark, X.normalize_label("v"), None) is None


def test_sentinels_and_numbers(spark):
    assert one(spark, X.null_if("v", "[ND]"), "[ND]") is None
    assert one(spark, X.null_if("v", "[ND]"), "[ND] ") == "[ND] "
    assert one(spark, X.decimal_comma("v"), "1234,56") == 1234.56
    assert one(spark, X.thousands_amount("v"), "1 234,56") == 123456.0
    assert one(spark, X.strip_blanks("v"), "012 345 678") == "012345678"


def test_decimal_comma_is_strict(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("12,5x",)], "v string").select(X.decimal_comma("v")).collect()


def test_dates(spark):
    assert str(one(spark, X.parse_date_any("v"), "2024/1/5")) == "2024-01-05"
    assert str(one(spark, X.parse_date_any("v"), "05/01/2024")) == "2024-01-05"
    assert one(spark, X.parse_date_any("v"), "garbage") is None
    assert str(one(spark, X.month_start("v"), "2024-03")) == "2024-03-01"
    assert str(one(spark, X.year_start("v"), "2024")) == "2024-01-01"
    assert str(one(spark, X.parse_date("v"), "2024-3-7")) == "2024-03-07"


def test_display_name(spark):
    df = spark.createDataFrame([("ACME", None, None), ("[ND]", "Jean", "Dupont"), ("[ND]", "[ND]", "[ND]"),
                                (None, None, "Seul")], "c string, f string, l string")
    got = [r[0] for r in df.select(X.display_name("c", "f", "l")).collect()]
    assert got == ["ACME", "Jean Dupont", None, "Seul"]


def test_concat_and_lists(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert df.select(X.concat_skip_null("a", "b", "c")).first()[0] == "ac"
    assert df.select(X.concat_strict("a", "b", "c")).first()[0] is None
    l = spark.createDataFrame([(["x", None, "y"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in l.select(X.list_to_text("v")).collect()] == ["x, y", "", None]
    assert [r[0] for r in l.select(X.list_count("v")).collect()] == [2, 0, None]


def test_surrogate_key_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    a, b = [r[0] for r in df.select(X.surrogate_key("x", "y")).collect()]
    assert a != b and len(a) == 32


def test_int_rounding(spark):
    assert one(spark, X.int_rounding("v"), "1.6") == 2


@pytest.mark.parametrize("bad", ["2024-02-30", "2024-3-7T10", " 2024-3-7", "2024", "7/3/2024"])
def test_parse_date_is_strict(spark, bad):
    with pytest.raises(Exception):
        spark.createDataFrame([(bad,)], "v string").select(X.parse_date("v")).collect()


def test_parse_date_any_matches_formatter(spark):
    import random
    random.seed(11)
    vals = [None, "", "2024/2/29", "2023/2/29", "29/02/2024", "31/04/2024", "2024//1", "garbage", " 2024/1/5"]
    for _ in range(3000):
        y, m, d = random.randint(1890, 2100), random.randint(0, 13), random.randint(0, 32)
        vals += [f"{y}/{m}/{d}", f"{d:02d}/{m:02d}/{y}", f"{d}/{m}/{y % 100}"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    ref = F.coalesce(F.try_to_date("v", "yyyy/M/d"), F.try_to_date("v", "d/M/yyyy"))
    assert df.filter(~X.parse_date_any("v").eqNullSafe(ref)).count() == 0


def test_month_start_matches_formatter_and_is_strict(spark):
    vals = [f"{y}-{m}" for y in (1999, 2024) for m in range(1, 13)] + [f"2024-{m:02d}" for m in range(1, 13)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert df.filter(~X.month_start("v").eqNullSafe(F.to_date("v", "yyyy-M"))).count() == 0
    for bad in ["2024-13", "2024-00", "2024-3-1", "24-03", " 2024-03"]:
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "v string").select(X.month_start("v")).collect()
