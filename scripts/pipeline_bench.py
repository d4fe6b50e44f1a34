"""End-to-end pipeline benchmark over raw files that Spark derives from the
benchmark tables, so the work grows with them.

The records are the ones the model-level driver queries check against DuckDB
(`civgraph.plans.driver_models`): legal units and establishments from
customers and suppliers, communes from customers, markets per line item,
concessions per order, the eight subsidy sources per line item / order.  Each
is landed under its contract's file pattern, one file per release year, in
the contract's delimiter and encoding (the agriculture file with its two
preamble lines, a second anct file with a reordered header).  Departments,
regions and the seeds come from nation / region / part.

`build_all` then runs twice (the second run is reported); prints one JSON line.
usage: python scripts/pipeline_bench.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from civgraph.plans import driver_models as DM  # noqa: E402
from civgraph.plans.driver import table  # noqa: E402
from civgraph.plans.pipeline import build_all  # noqa: E402
from civgraph.session import build_session  # noqa: E402
from civgraph.sources.contracts import CONTRACTS  # noqa: E402


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8", single: bool = False) -> None:
    out = df.coalesce(1) if single else df
    (out.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", encoding)
        .option("escape", '"').csv(path))


def land(df: DataFrame, raw: str, contract: str, stem: str | None = None) -> None:
    """One file per release year under the contract's pattern and dialect."""
    c = CONTRACTS[contract]
    stem = stem or c.pattern.split("*")[0].rstrip("_")
    ext = c.pattern.rsplit(".", 1)[1]
    for (year,) in df.select("release_year").distinct().collect():  # a few release years
        part = df.filter(F.col("release_year") == year).drop("release_year")
        path = f"{raw}/{stem}_{year}.{ext}"
        if c.format == "parquet":
            part.write.mode("overwrite").parquet(path)
        elif c.skip_lines:
            # preamble lines, header and rows as ready-made lines in one file; the
            # text sink only writes UTF-8, so they go through the CSV sink as one
            # unquoted column in the contract's encoding
            spark = part.sparkSession
            lead = [(0, i, f"Export {i}") for i in range(c.skip_lines)] + [(1, 0, c.sep.join(part.columns))]
            head = spark.createDataFrame(lead, "k int, i int, v string")
            rows = part.select(F.lit(2).alias("k"), F.lit(0).alias("i"),
                               F.concat_ws(c.sep, *[F.coalesce(F.col(f"`{x}`"), F.lit("")) for x in part.columns])
                               .alias("v"))
            # one file: preamble, then header, then rows (order made explicit; a
            # union followed by coalesce does not keep it)
            (head.unionByName(rows).repartition(1).sortWithinPartitions("k", "i").select("v")
                 .write.mode("overwrite").option("header", False).option("sep", "\u0001").option("quote", "")
                 .option("encoding", c.encoding).csv(path))
        else:
            write_csv(part, path, c.sep, c.encoding)


def derive(spark, sf: str, raw: str, seeds: str) -> None:
    n, r, p = (table(spark, sf, t) for t in ("nation", "region", "part"))
    land(DM.bronze_communes(spark, sf), raw, "france_communes")
    dep = n.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("DEP"),
                   F.col("n_regionkey").cast("string").alias("REG"), F.col("n_name").alias("LIBELLE"),
                   F.lit("2026").alias("release_year"))
    land(dep, raw, "france_departements")
    land(r.select(F.col("r_regionkey").cast("string").alias("REG"), F.col("r_name").alias("LIBELLE"),
                  F.lit("2026").alias("release_year")), raw, "france_regions")
    land(DM.bronze_legal_units(spark, sf), raw, "sirene_unite_legale", "sirene-unite-legal")
    land(DM.bronze_establishments(spark, sf), raw, "sirene_etablissement")
    land(DM.bronze_markets(spark, sf), raw, "commande_publique_marche")
    land(DM.bronze_concessions(spark, sf), raw, "commande_publique_concession")
    b = DM.bronze_subsidies(spark, sf)
    land(b["culture"], raw, "culture_convention_subvention")
    land(b["agriculture"], raw, "agriculture_subvention")
    land(b["anct"], raw, "anct_subvention_ville", "anct-subvention-ville-2024")
    # another yearly file of the same source with a reordered header
    land(b["anct"].select(*b["anct"].columns[::-1]), raw, "anct_subvention_ville", "anct-subvention-ville-2023")
    land(b["ademe"], raw, "ademe_aide_financiere")
    land(b["dotation"], raw, "dotation_soutien_territoire", "dotation-soutien-territoire-2024")
    land(b["caisse"], raw, "caisse_depots_subvention", "subvention-caisse-depots")
    land(b["idf"], raw, "idf_subvention_association")
    fv = b["fonds_vert"].drop("exercice")  # the exercise year comes from the file name
    land(fv, raw, "fonds_vert_subvention", "fonds-vert-subvention-2023")
    land(fv.withColumnRenamed("opérateur", "operateur"), raw, "fonds_vert_subvention", "fonds-vert-subvention-2024")
    divisions, _ = DM.subsidy_reference(spark, sf)
    write_csv(divisions, f"{seeds}/ministere_culture_division.csv", single=True)
    write_csv(p.select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("libelle"),
                       F.length(F.col("p_partkey").cast("string")).alias("type")).filter("type <= 3"),
              f"{seeds}/insee_sirene_cat_juridique.csv", single=True)
    write_csv(n.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"),
                       F.concat(F.lit("NAF "), F.col("n_name")).alias("libelle"),
                       F.when(F.col("n_nationkey") % 2 == 0, "sousclasse").otherwise("classe").alias("niveau")),
              f"{seeds}/insee_sirene_naf.csv", single=True)
    write_csv(n.select(F.col("n_name").alias("code"), F.col("n_name").alias("libelle")),
              f"{seeds}/nom_activite_artisanat.csv", single=True)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="civgraph-pipe-", dir="/tmp")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(app="civgraph-pipeline-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    raw, seeds = f"{scratch}/raw", f"{scratch}/seeds"
    t0 = time.perf_counter()
    derive(spark, sf, raw, seeds)
    t_derive = time.perf_counter() - t0
    runs, summary = [], None
    for i in range(2):
        t0 = time.perf_counter()
        summary = build_all(spark, raw, seeds, f"{scratch}/lake{i}")
        runs.append(time.perf_counter() - t0)
    counts = {k: spark.read.parquet(f"{scratch}/lake1/silver/{k}.parquet").count() for k in summary["silver"]}
    dangling = spark.read.parquet(f"{scratch}/lake1/quality/integrity.parquet").filter("dangling > 0")
    print(json.dumps({"metric": "pipeline_build_all_sec", "value": round(runs[-1], 3), "unit": "sec",
                      "first_run_sec": round(runs[0], 3), "derive_sec": round(t_derive, 3),
                      "failed_checks": summary["failed_checks"], "seconds": summary["seconds"],
                      "silver_seconds": summary["silver_seconds"], "silver_rows": counts,
                      "dangling": [r.asDict() for r in dangling.collect()], "sf_dir": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
