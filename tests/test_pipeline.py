"""End-to-end: raw fixtures -> bronze -> silver -> gold, asserted row by row."""

import datetime as dt
import os

from pyspark.sql import functions as F

import fixtures
from civgraph.functions.columns import normalize_label


def silver(spark, built, name):
    return spark.read.parquet(f"{built['root']}/out/silver/{name}.parquet")


def gold(spark, built, kind, name):
    return spark.read.option("header", True).csv(built["paths"][kind][name])


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_all_models_written_and_checks_pass(built):
    assert len(built["silver"]) == 20
    assert len(built["paths"]["node"]) == 10 and len(built["paths"]["relationship"]) == 14
    assert built["failed_checks"] == []


def test_geo_latest_release_and_codes(spark, built):
    com = silver(spark, built, "france_communes")
    assert com.select("release_year").distinct().collect()[0][0] == "2026"
    assert com.count() == 6
    assert by(com.filter("type_commune = 'COM'"), "code_commune")["2A004"]["code_dep"] == "2A"
    assert silver(spark, built, "france_departements").count() == 3


def test_legal_units_names_and_labels(spark, built):
    ul = by(silver(spark, built, "ent_sirene_unite_legale"), "siren")
    assert set(ul) == {"012345678", "111111111", "222222222", "333333333"}  # 2025 release dropped
    assert ul["012345678"]["denomination_unite_legale"] == "ACME"
    assert ul["111111111"]["denomination_unite_legale"] == "Jean Dupont"
    assert ul["222222222"]["denomination_unite_legale"] is None
    assert ul["333333333"]["denomination_unite_legale"] == "Seul"
    assert ul["012345678"]["activite_principale_unite_legale_libelle"] == "Programmation informatique"
    r = ul["012345678"]
    assert (r["categorie_juridique_unite_legale_libelle_ii"], r["categorie_juridique_unite_legale_libelle_i"]) == \
        ("SAS", "Société commerciale")
    assert ul["222222222"]["categorie_juridique_unite_legale_libelle_iii"] == "Sans parent"
    assert ul["222222222"]["categorie_juridique_unite_legale_libelle_ii"] is None
    assert ul["333333333"]["categorie_juridique_unite_legale_libelle_iii"] is None


def test_category_hierarchy_keeps_zero_codes(spark, built):
    cj = by(silver(spark, built, "insee_categorie_juridique"), "code_iii")
    assert (cj["0000"]["code_ii"], cj["0000"]["code_i"]) == ("00", "0")
    assert cj["9999"]["code_ii"] is None and len(cj) == 4


def test_establishments_masking_and_casts(spark, built):
    eta = by(silver(spark, built, "ent_sirene_etablissement"), "siret")
    assert len(eta["01234567800011"]) == 34
    e = eta["01234567800011"]
    assert e["enseigne1_etablissement"] == "Boutique"
    assert e["coordonnee_lambert_abscisse_etablissement"] == 870000.1
    assert e["libelle_voie_etablissement"] is None
    assert e["activite_principale_registre_metiers_etablissement_libelle"] == "Maréchalerie"
    assert eta["01234567800029"]["enseigne1_etablissement"] is None
    assert eta["01234567800029"]["coordonnee_lambert_abscisse_etablissement"] is None


def test_markets_unnest(spark, built):
    m = silver(spark, built, "commande_publique_marche")
    assert m.count() == 4  # M1 x3, M2 x1; empty and NULL lists dropped
    m1 = m.filter("id = 'M1'").collect()
    assert {r["titulaire_id"] for r in m1} == {"11111111100015", "FR123", "99999999900000"}
    assert {r["nb_titulaires"] for r in m1} == {3}
    assert m1[0]["techniques"] == "Accord-cadre, Concours" and m1[0]["modalites_execution"] == ""
    assert m1[0]["offre_recues"] == 3 and m1[0]["montant"] == 1500.5
    m2 = m.filter("id = 'M2'").first()
    assert m2["offre_recues"] is None and m2["date_notification"] == dt.date(2024, 3, 7)


def test_contract_union_ids(spark, built):
    cp = silver(spark, built, "ent_commande_publique")
    assert cp.count() == 5
    assert cp.select("id").distinct().count() == 5
    c = cp.filter("type_contrat = 'concession'").first()
    assert (c["siret_autorite"], c["id_titulaire"], c["montant"]) == ("22222222200012", "33333333300019", 250000.0)
    assert c["nombre_offres"] is None and c["duree_mois"] == 120


def test_contract_nodes_and_edges(spark, built):
    n = gold(spark, built, "node", "commande_publique_marche")
    assert n.columns == ["id:ID(CommandePubliqueMarche)", "montant:double", "date_contrat:date", "objet"]
    objets = {r["objet"] for r in n.collect()}
    expected = spark.createDataFrame([(fixtures.LONG_OBJET,)], "o string").select(normalize_label("o")).first()[0]
    assert expected in objets and len(expected) <= 200 and "  " not in expected
    assert gold(spark, built, "relationship", "has_publique_marche").count() == 3
    gives = gold(spark, built, "relationship", "gives_publique_marche")
    assert sorted(r[0] for r in gives.collect()) == ["01234567800029", "11111111100015"]


def test_agriculture_preamble_encoding_and_amount(spark, built):
    a = silver(spark, built, "subvention_ministere_agriculture").collect()
    assert len(a) == 1  # "Généré ..." footer and NULL payer dropped
    assert a[0]["montant_total_subvention"] == 123456.0
    assert a[0]["identification_attributaire"] == "01234567800011"
    assert a[0]["nom_beneficiaire"] == "Ferme œuvre €"


def test_anct_union_by_name_and_dates(spark, built):
    a = by(silver(spark, built, "subvention_anct_ville"), "nom_beneficiaire")
    assert set(a) == {"Asso", "n", "Club", "Ville de Paris"}  # NULL payer dropped, all yearly files kept
    assert a["Ville de Paris"]["montant_total_subvention"] == 7.5  # 2019 file repaired before parsing
    assert a["Asso"]["date_versement"] == dt.date(2024, 1, 5)
    assert a["Asso"]["date_convention_subvention"] == dt.date(2024, 1, 5)
    assert a["Asso"]["montant_total_subvention"] == 1234.56 and a["Asso"]["reference_decision"] == "R1"
    assert a["n"]["date_versement"] is None and a["n"]["date_convention_subvention"] == dt.date(2024, 12, 31)
    assert a["Club"]["montant_total_subvention"] == 10.5 and a["Club"]["identification_beneficiaire"] == "11111111100015"


def test_culture_and_fonds_vert(spark, built):
    c = silver(spark, built, "subvention_ministere_culture").first()
    assert (c["annee"], c["montant_engage"]) == (2024, 1500.5)
    assert c["code_commune_unite_patrimoniale_concernee_par_lop_fin"] == "75056"
    fv = by(silver(spark, built, "fonds_vert_subvention"), "numero_dossier_ds")
    assert fv["DS1"]["siret_beneficiaire"] == "01234567800011"  # head office of its SIREN
    assert (fv["DS1"]["operateur"], fv["DS1"]["forme_juridique_beneficiaire"]) == ("Op", "Commune")
    assert (fv["DS2"]["operateur"], fv["DS2"]["forme_juridique_beneficiaire"]) == ("Op2", "SA")
    assert (fv["DS1"]["exercice"], fv["DS2"]["exercice"]) == ("2023", "2024")


def test_subsidy_union(spark, built):
    s = silver(spark, built, "ent_subvention_publique")
    assert s.count() == 12 and s.select("id").distinct().count() == 12
    per = {r["origine_data"]: r for r in s.collect()}
    cul = per["Ministère de la culture"]
    assert (cul["siret_crediteur"], cul["nom_projet"], cul["code_commune"]) == ("01234567800011", "Culture - ", "75056")
    assert cul["date_subvention"] == dt.date(2024, 1, 1)
    dot = per["Direction générale des collectivités territoriales"]
    assert (dot["siret_beneficiaire"], dot["montant"]) == ("01234567800011", 500.25)
    assert per["Caisse des Dépôts"]["date_subvention"] == dt.date(2024, 3, 1)
    assert per["Région Île-de-France"]["siret_beneficiaire"] is None
    node = gold(spark, built, "node", "subvention_publique")
    assert "\n" not in "".join(r["objet"] or "" for r in node.collect())


def test_geo_edges_and_located_in(spark, built):
    assert gold(spark, built, "relationship", "etablissement_located_in_commune").count() == 2
    deleguee = gold(spark, built, "relationship", "etablissement_located_in_commune_deleguee").collect()
    assert sorted(r[0] for r in deleguee) == ["01234567800011", "22222222200012"]  # 01001 is COM and COMD
    arm = gold(spark, built, "relationship", "has_arrondissement").first()
    assert (arm[0], arm[1]) == ("75056", "75101")


def test_integrity_and_manifest(spark, built):
    rep = spark.read.parquet(f"{built['root']}/out/quality/integrity.parquet")
    assert rep.agg(F.sum("dangling")).first()[0] == 0 and rep.count() == 28
    man = spark.read.json(f"{built['root']}/out/gold/manifest")
    args = {r["argument"].split("=")[0] + "=" + r["label"] for r in man.collect()}
    assert "--nodes=etablissement" in args and "--relationships=has_commune" in args
    listed = {}
    for r in man.collect():  # every listed path is a file of its own, with the header
        option, label, path = r["argument"].split("=", 2)
        local = path.removeprefix("file:")
        assert os.path.isfile(local) and path == r["path"] and (option, label) == (
            {"node": "--nodes", "relationship": "--relationships"}[r["kind"]], r["label"])
        with open(local) as fh:
            listed.setdefault((r["kind"], r["label"]), []).append(len(fh.read().splitlines()) - 1)
    for kind in ("node", "relationship"):
        assert {k[1] for k in listed if k[0] == kind} == set(built["paths"][kind])
    assert sum(listed["node", "etablissement"]) == gold(spark, built, "node", "etablissement").count()


def test_csv_roundtrip_quotes(spark, built):
    n = gold(spark, built, "node", "unite_legale")
    assert by(n, "siren:ID(UniteLegale)")["012345678"]["name"] == "ACME"


def test_graph_invariants(spark, built):
    """Unique ids per node file; every node file re-read from CSV equals the
    frame it was written from (values as text)."""
    from civgraph.plans import gold as GOLD
    silver_tables = {k: silver(spark, built, k) for k in built["silver"]}
    frames = GOLD.nodes(silver_tables)
    for label, df in frames.items():
        written = gold(spark, built, "node", label)
        id_col = next(c for c in written.columns if ":ID(" in c)
        assert written.count() == written.select(f"`{id_col}`").distinct().count(), label
        as_text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
        assert sorted(map(tuple, as_text.collect()), key=repr) == sorted(map(tuple, written.collect()), key=repr), label


def test_multiline_quoted_field_and_label(spark, built):
    """A quoted CSV field holding a newline stays one record; N05 turns it
    into a one-line label."""
    s = silver(spark, built, "ent_subvention_publique").filter("domaine = 'culture'").first()
    assert s["description_projet"] == "Aide\nau spectacle"
    node = gold(spark, built, "node", "subvention_publique")
    labels = {r["objet"] for r in node.collect()}
    assert "Aide au spectacle" in labels


def test_stacked_edges_equal_the_files(spark, built):
    from civgraph.plans import gold as GOLD
    cp, eta, com = (silver(spark, built, n) for n in ("ent_commande_publique", "ent_sirene_etablissement", "france_communes"))
    for stacked, files in ((GOLD.contract_endpoints(cp, eta), GOLD.contract_relationships(cp, eta)),
                           (GOLD.located_in_edges(eta, com), GOLD.located_in_relationships(eta, com))):
        want = sorted((name, *r) for name, df in files.items() for r in df.collect())
        assert sorted(map(tuple, stacked.collect())) == want
    for name, df in GOLD.relationships({k: silver(spark, built, k) for k in built["silver"]}).items():
        written = gold(spark, built, "relationship", name)
        assert written.columns == df.columns
        as_text = df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns])
        assert sorted(map(tuple, as_text.collect()), key=repr) == sorted(map(tuple, written.collect()), key=repr), name
