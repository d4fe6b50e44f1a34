"""End-to-end build: raw files -> bronze -> silver (Parquet) -> gold (CSV),
with data-quality checks, the graph integrity report and the import manifest.

Every silver model is written once and read back before anything downstream
uses it: lineage is cut at each model (executor loss only recomputes from the
last written table), models read by many others (the establishment table is
read by thirteen) are computed once, and surrogate ids are fixed on disk so
node and relationship files always agree.  The contract table is partitioned
by ``type_contrat`` so the market / concession filters prune files.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from civgraph.operators import quality as Q
from civgraph.operators.graph import integrity_report, manifest, write_graph
from civgraph.plans import gold
from civgraph.plans import silver as S
from civgraph.plans.bronze import bronze
from civgraph.session import ensure_pipeline_conf
from civgraph.sources.blocks import shared_table
from civgraph.sources.prep import post
from civgraph.sources.readers import list_files, read_seed

# Fixed value: landing name of the consolidated procurement document.
CONTRACT_DOCUMENT_PATTERN = "commande-publique-france_*.json"

# Q01-Q03: the silver data tests (model -> checks).
CHECKS: dict[str, list[Q.Check]] = {
    "commande_publique_marche": [Q.not_null("id"), Q.not_null("acheteur_siret"), Q.not_null("titulaire_id")],
    "commande_publique_concession": [Q.not_null("id"), Q.not_null("concesionnaire_id"),
                                     Q.not_null("autorite_concedante_siret")],
    "ent_sirene_unite_legale": [Q.unique("siren"), Q.not_null("siren")],
    "ent_sirene_etablissement": [Q.not_null("siren"), Q.not_null("nic"), Q.unique("siret"), Q.not_null("siret")],
    "ent_commande_publique": [Q.not_null("id"), Q.not_null("id_contrat"), Q.not_null("siret_autorite"),
                              Q.not_null("id_titulaire")],
    "ent_subvention_publique": [Q.not_null("id"), Q.not_null("montant")],
    "france_communes": [Q.unique("code_commune || '-' || type_commune",
                                 "code_commune || '-' || type_commune"),
                        Q.not_null("type_commune"), Q.not_null("code_commune")],
    "france_departements": [Q.unique("code_dep"), Q.not_null("code_dep")],
    "france_regions": [Q.unique("code_reg"), Q.not_null("code_reg")],
    "sirene_unite_legale": [Q.unique("siren"), Q.not_null("siren")],
    "sirene_etablissement": [Q.not_null("siren"), Q.not_null("nic"), Q.unique("siret"), Q.not_null("siret")],
    "insee_categorie_juridique": [Q.unique("code_iii"), Q.not_null("code_iii")],
    "subvention_ministere_culture": [Q.not_null("montant_engage"), Q.not_null("nom_beneficiaire"),
                                     Q.not_null("num_engagement_juridique"), Q.not_null("release_year")],
    "subvention_ministere_agriculture": [Q.not_null("nom_attributaire"), Q.not_null("identification_attributaire"),
                                         Q.not_null("nom_beneficiaire"), Q.not_null("montant_total_subvention")],
    "subvention_anct_ville": [Q.not_null("identification_attributaire"), Q.not_null("montant_total_subvention")],
    "subvention_ademe_aide_financiere": [Q.not_null("id_attribuant"), Q.not_null("montant")],
    "dotation_soutien_territoire": [Q.not_null("subvention")],
    "subvention_caisse_depots": [Q.not_null("id_attribuant"), Q.not_null("montant")],
    "idf_subvention_association": [Q.not_null("id_attribuant"), Q.not_null("montant")],
    "fonds_vert_subvention": [Q.not_null("montant_engage")],
}


def run_concurrently(tasks: dict, max_workers: int = 4) -> dict:
    """Run independent Spark actions from a few driver threads.

    Each task submits its own job(s); the scheduler interleaves them on the
    executors, so small independent models fill cores a single large one
    leaves idle and per-job latency overlaps.  Results keep the task names.
    """
    from concurrent.futures import ThreadPoolExecutor
    if len(tasks) <= 1 or max_workers <= 1:
        return {k: fn() for k, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


class Silver:
    """Writes each silver model once and hands back the re-read table."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.root, self.tables, self.seconds = spark, f"{out_dir.rstrip('/')}/silver", {}, {}

    def put(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        t0 = time.perf_counter()
        path = f"{self.root}/{name}.parquet"
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path)
        self.tables[name] = self.spark.read.parquet(path)
        self.seconds[name] = round(time.perf_counter() - t0, 3)
        return self.tables[name]

    def put_many(self, models: dict, partition_by: dict | None = None) -> dict[str, DataFrame]:
        """Write independent models concurrently (lazy DataFrames or thunks)."""
        partition_by = partition_by or {}
        tasks = {k: (lambda k=k, v=v: self.put(k, v() if callable(v) else v, partition_by.get(k)))
                 for k, v in models.items()}
        return run_concurrently(tasks)


def build_silver(spark: SparkSession, raw_dir: str, seeds_dir: str, out_dir: str) -> Silver:
    """Write every silver model (in dependency waves, independent models concurrently);
    returns the writer, whose ``tables`` are the re-read models."""
    ensure_pipeline_conf(spark)
    b = lambda n: bronze(spark, raw_dir, n)
    # the newest release of a source, chosen from the file names
    new = lambda n: bronze(spark, raw_dir, n, newest=True)
    one = {"prune_files": None}
    seed = lambda n: read_seed(spark, seeds_dir, n)
    sv = Silver(spark, out_dir)
    # wave 1: models that read raw files and seeds only
    w1 = sv.put_many({
        "france_communes": lambda: S.france_communes(new("france_communes"), **one),
        "france_departements": lambda: S.france_departements(new("france_departements"), **one),
        "france_regions": lambda: S.france_regions(new("france_regions"), **one),
        "insee_categorie_juridique": lambda: S.categorie_juridique(seed("insee_sirene_cat_juridique")),
        "sirene_unite_legale": lambda: S.sirene_unite_legale(new("sirene_unite_legale"), **one),
        "sirene_etablissement": lambda: S.sirene_etablissement(new("sirene_etablissement"), **one),
        "commande_publique_marche": lambda: S.commande_publique_marche(b("commande_publique_marche")),
        "commande_publique_concession": lambda: S.commande_publique_concession(b("commande_publique_concession")),
        "subvention_ministere_culture": lambda: S.subvention_ministere_culture(new("culture_convention_subvention"), **one),
        "subvention_ministere_agriculture": lambda: S.subvention_ministere_agriculture(new("agriculture_subvention"), **one),
        "subvention_anct_ville": lambda: S.subvention_anct_ville(new("anct_subvention_ville"), **one),
        "subvention_ademe_aide_financiere": lambda: S.subvention_ademe(new("ademe_aide_financiere"), **one),
        "dotation_soutien_territoire": lambda: S.dotation_soutien_territoire(new("dotation_soutien_territoire"), **one),
        "subvention_caisse_depots": lambda: S.subvention_caisse_depots(new("caisse_depots_subvention"), **one),
        "idf_subvention_association": lambda: S.idf_subvention_association(new("idf_subvention_association"), **one),
    })
    # wave 2: enrichment and the contract union
    w2 = sv.put_many({
        "ent_sirene_unite_legale": lambda: S.ent_sirene_unite_legale(
            w1["sirene_unite_legale"], seed("insee_sirene_naf"), w1["insee_categorie_juridique"]),
        "ent_sirene_etablissement": lambda: S.ent_sirene_etablissement(
            w1["sirene_etablissement"], seed("nom_activite_artisanat")),
        "ent_commande_publique": lambda: S.ent_commande_publique(
            w1["commande_publique_marche"], w1["commande_publique_concession"], by_hash=True),
    }, partition_by={"ent_commande_publique": "type_contrat"})
    ent_eta = w2["ent_sirene_etablissement"]
    # wave 3: head-office fill, then the subsidy union
    fv = sv.put("fonds_vert_subvention", S.fonds_vert_subvention(new("fonds_vert_subvention"), ent_eta, **one))
    sv.put("ent_subvention_publique", S.ent_subvention_publique(
        w1["subvention_ministere_culture"], seed("ministere_culture_division"),
        w1["subvention_ministere_agriculture"], w1["subvention_anct_ville"],
        w1["subvention_ademe_aide_financiere"], w1["dotation_soutien_territoire"],
        w1["subvention_caisse_depots"], w1["idf_subvention_association"], fv, ent_eta, by_hash=True))
    return sv


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    from functools import reduce
    parts = [Q.run_checks(tables[m], checks, m) for m, checks in CHECKS.items() if m in tables]
    return reduce(lambda a, b: a.unionByName(b), parts)


def prepare_raw(spark: SparkSession, raw_dir: str) -> list[str]:
    """Raw preparation (P01/K03): split every landed procurement document into
    the market and concession datasets named by the document's year."""
    docs = list_files(spark, f"{raw_dir.rstrip('/')}/{CONTRACT_DOCUMENT_PATTERN}")
    for doc in docs:
        post(spark, "commande_publique", doc, raw_dir)
    return docs


def build_all(spark: SparkSession, raw_dir: str, seeds_dir: str, out_dir: str, prepare: bool = True) -> dict:
    """Run the whole pipeline; returns the silver models, output paths, the
    failing checks and the seconds spent per step."""
    out_dir = out_dir.rstrip("/")
    seconds: dict[str, float] = {}
    t0 = time.perf_counter()
    if prepare:
        prepare_raw(spark, raw_dir)
        seconds["prepare_raw"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    sv = build_silver(spark, raw_dir, seeds_dir, out_dir)
    silver = sv.tables
    seconds["silver"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()

    def checks() -> list[dict]:
        quality_report(silver).write.mode("overwrite").parquet(f"{out_dir}/quality/checks.parquet")
        return [r.asDict() for r in spark.read.parquet(f"{out_dir}/quality/checks.parquet")
                .filter("failures > 0").collect()]  # at most one row per check

    nodes = gold.nodes(silver)
    rels = gold.relationships(silver, lambda df: shared_table(df, "relationship"))
    # the checks read silver only: they run while the graph files are written
    done = run_concurrently({
        "checks": checks,
        "gold": lambda: write_graph(nodes, rels, f"{out_dir}/gold/graph", single_file=gold.SINGLE_FILE_NODES)},
        max_workers=2)
    failures, paths = done["checks"], done["gold"]
    seconds["checks_and_gold"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()

    def reread(frames: dict, kind: str) -> dict:
        # the files are re-read as written (text) with their known header: no inference job
        return {k: spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in frames[k].columns]))
                .option("header", True).option("escape", '"').csv(p) for k, p in paths[kind].items()}
    written_nodes = reread(nodes, "node")
    by_label = {next(c for c in df.columns if ":ID(" in c).split("(")[1][:-1]: df
                for df in written_nodes.values()}
    written_rels = reread(rels, "relationship")
    integrity_report(written_rels, by_label).write.mode("overwrite").parquet(f"{out_dir}/quality/integrity.parquet")
    man = manifest(spark, paths["node"], paths["relationship"])
    man.coalesce(1).write.mode("overwrite").json(f"{out_dir}/gold/manifest")
    seconds["integrity_and_manifest"] = round(time.perf_counter() - t0, 3)
    return {"silver": sorted(silver), "paths": paths, "failed_checks": failures,
            "seconds": seconds, "silver_seconds": sv.seconds}


def refresh_report(spark: SparkSession, catalog_path: str, history_path: str | None = None,
                   now=None) -> DataFrame:
    """Entry point A as a plan: validate the source catalog (any problem is
    an error, as in the reference), read the download history if there is
    one, and list the sources due for download with their status and the raw
    file name they will land under."""
    from pyspark.sql import functions as F

    from civgraph.operators import catalog as C

    catalog = C.read_catalog(spark, catalog_path)
    problems = C.validate_catalog(catalog).collect()  # at most a few rows per declared source
    if problems:
        raise ValueError(f"invalid source catalog: {[r.asDict() for r in problems]}")
    if history_path and list_files(spark, history_path):
        history = C.read_history(spark, history_path)
    else:
        history = spark.createDataFrame([], C.HISTORY_SCHEMA)
    now = now if now is not None else F.localtimestamp()
    plan = C.refresh_plan(catalog, history, now)
    return plan.select("name", "year", "file_year", "format", "refresh_days", "last_ts", "status",
                       C.raw_file_name("name", "file_year", "format", now).alias("file_name"))
