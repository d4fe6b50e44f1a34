"""Gold graph (N01-N10 nodes, E01-E14 relationships) from the silver tables.

Node label and relationship type are the file base names; headers follow the
bulk-import convention (see ``operators.graph``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civgraph.functions.columns import normalize_label
from civgraph.operators import graph as G

COM, COMMUNE_DELEGUEE, ARM = ["COM"], ["COMD", "COMA"], ["ARM"]
LOCATED_IN = {"etablissement_located_in_commune": (COM, "Commune"),
              "etablissement_located_in_commune_deleguee": (COMMUNE_DELEGUEE, "CommuneDeleguee"),
              "etablissement_located_in_arrondissement": (ARM, "Arrondissement")}


def nodes(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    com, cp = s["france_communes"], s["ent_commande_publique"]
    marche = cp.filter(F.col("type_contrat") == "marche")
    concession = cp.filter(F.col("type_contrat") == "concession")
    contract_props = {"montant": "montant", "date_contrat": "date_contrat", "objet": normalize_label("objet")}
    contract_types = {"montant": "double", "date_contrat": "date"}
    sub = s["ent_subvention_publique"]
    return {
        "unite_legale": G.node(s["ent_sirene_unite_legale"], "siren", "UniteLegale",
                               props={"name": "denomination_unite_legale"}),                       # N01
        "etablissement": G.node(s["ent_sirene_etablissement"], "siret", "Etablissement",
                                props={"siren": "siren"}),                                         # N02
        "commande_publique_marche": G.node(marche, "id", "CommandePubliqueMarche",
                                           props=contract_props, types=contract_types),            # N03
        "commande_publique_concession": G.node(concession, "id", "CommandePubliqueConcession",
                                               props=contract_props, types=contract_types),        # N04
        "subvention_publique": G.node(sub, "id", "SubventionPublique", props={
            "date_subvention": F.col("date_subvention").cast("date"), "montant": "montant",
            "objet": normalize_label("description_projet")},
            types={"date_subvention": "date", "montant": "double"}),                               # N05
        "region": G.node(s["france_regions"], "code_reg", "Region", props={"name": "name_reg"}),  # N06
        "departement": G.node(s["france_departements"], "code_dep", "Departement",
                              props={"name": "name_dep", "code_reg": "code_reg"}),                # N07
        "commune": G.node(com.filter(F.col("type_commune").isin(COM)), "code_commune", "Commune",
                          props={"name": "name_commune", "code_dep": "code_dep", "code_reg": "code_reg"}),  # N08
        "commune_deleguee": G.node(com.filter(F.col("type_commune").isin(COMMUNE_DELEGUEE)), "code_commune",
                                   "CommuneDeleguee", id_name="code_commune_deleguee",
                                   props={"name": "name_commune"}),                                # N09
        "arrondissement": G.node(com.filter(F.col("type_commune").isin(ARM)), "code_commune", "Arrondissement",
                                 id_name="code_arrondissement", props={"name": "name_commune"}),  # N10
    }


def contract_relationships(cp: DataFrame, eta: DataFrame) -> dict[str, DataFrame]:
    """Buyer / grantor and awardee edges of the contract table; the
    establishment must exist, awardees only when identified by SIRET."""
    marche = cp.filter(F.col("type_contrat") == "marche")
    concession = cp.filter(F.col("type_contrat") == "concession")
    siret_typed = F.col("type_identifiant_titulaire") == "SIRET"
    E = G.edge_existing
    return {
        "has_publique_marche": E(marche, "siret_autorite", "Etablissement", "id",
                                 "CommandePubliqueMarche", eta, "siret"),                           # E02
        "has_publique_concession": E(concession, "siret_autorite", "Etablissement", "id",
                                     "CommandePubliqueConcession", eta, "siret"),                   # E03
        "gives_publique_marche": E(marche.filter(siret_typed), "id_titulaire", "Etablissement", "id",
                                   "CommandePubliqueMarche", eta, "siret"),                         # E04
        "gives_publique_concession": E(concession.filter(siret_typed), "id_titulaire", "Etablissement",
                                       "id", "CommandePubliqueConcession", eta, "siret"),           # E05
    }


def contract_ends(cp: DataFrame, contract: str = "id") -> DataFrame:
    """Endpoints of E02-E05 stacked (relationship, siret, other): two per
    contract row, awardees only when identified by SIRET."""
    kind = F.col("type_contrat")
    authority = F.struct(F.concat(F.lit("has_publique_"), kind).alias("relationship"),
                         F.col("siret_autorite").alias("siret"))
    awardee = F.when(F.col("type_identifiant_titulaire") == "SIRET", F.struct(
        F.concat(F.lit("gives_publique_"), kind).alias("relationship"), F.col("id_titulaire").alias("siret")))
    ends = cp.select(F.col(contract).alias("other"), F.explode(F.array(authority, awardee)).alias("end"))
    return ends.select("end.relationship", "end.siret", "other")


def subsidy_ends(sub: DataFrame) -> DataFrame:
    """Endpoints of E06 and E07 stacked (relationship, siret, other)."""
    ends = [F.struct(F.lit(name).alias("relationship"), F.col(side).alias("siret")) for name, side in (
        ("provides_subvention_publique", "siret_crediteur"), ("receives_subvention_publique", "siret_beneficiaire"))]
    return sub.select(F.col("id").alias("other"), F.explode(F.array(*ends)).alias("end")).select(
        "end.relationship", "end.siret", "other")


def contract_endpoints(cp: DataFrame, eta: DataFrame, contract: str = "id") -> DataFrame:
    """E02-E05 in one frame (relationship, siret, contract): one semi join with the establishments."""
    return G.keep_existing(contract_ends(cp, contract), "siret", eta, "siret").withColumnRenamed("other", "contract")


def establishment_edges(cp: DataFrame, sub: DataFrame, eta: DataFrame) -> DataFrame:
    """E02-E07 in one frame (relationship, siret, other): the registry meets
    the endpoints of all six once."""
    return G.keep_existing(contract_ends(cp).unionByName(subsidy_ends(sub)), "siret", eta, "siret")


def located_in_relationships(eta: DataFrame, com: DataFrame) -> dict[str, DataFrame]:
    """Establishment -> commune / delegated commune / district by the
    establishment's commune code; one edge per matching commune row.  No
    broadcast hint: Spark's own size check decides."""
    return {name: G.edge_typed(eta, "code_commune_etablissement", com, "code_commune", "type_commune", types,
                               "siret", "Etablissement", label) for name, (types, label) in LOCATED_IN.items()}


def located_in_edges(eta: DataFrame, com: DataFrame) -> DataFrame:
    """E08-E10 in one frame (relationship, siret, commune) from one join."""
    name = F.coalesce(*[F.when(F.col("type_commune").isin(types), F.lit(rel))
                        for rel, (types, _) in LOCATED_IN.items()])
    sites = eta.where("code_commune_etablissement IS NOT NULL").select("siret", "code_commune_etablissement")
    kinds = com.select(name.alias("relationship"), F.col("code_commune").alias("commune")).where(
        "relationship IS NOT NULL")
    return sites.join(kinds, F.col("code_commune_etablissement") == F.col("commune")).select(
        "relationship", "siret", "commune")


#: Label of the other end of E02-E07.
OTHER_END = {
    "has_publique_marche": "CommandePubliqueMarche", "has_publique_concession": "CommandePubliqueConcession",
    "gives_publique_marche": "CommandePubliqueMarche", "gives_publique_concession": "CommandePubliqueConcession",
    "provides_subvention_publique": "SubventionPublique", "receives_subvention_publique": "SubventionPublique",
}


def relationships(s: dict[str, DataFrame], staged=lambda df: df) -> dict[str, DataFrame]:
    """E01-E14.  E02-E07 and E08-E10 are two stacked frames, one join each;
    ``staged`` may write them (by relationship), so that the files of the
    single types read their own part of the result instead of joining again."""
    eta, com = s["ent_sirene_etablissement"], s["france_communes"]
    known = staged(establishment_edges(s["ent_commande_publique"], s["ent_subvention_publique"], eta))
    located = staged(located_in_edges(eta, com))

    def one(df: DataFrame, name: str, other: str, label: str) -> DataFrame:
        return G.edge(df.filter(F.col("relationship") == name), "siret", "Etablissement", other, label)

    return {
        "has_etablissement": G.edge(eta, "siren", "UniteLegale", "siret", "Etablissement"),          # E01
        **{name: one(known, name, "other", label) for name, label in OTHER_END.items()},             # E02-E07
        **{name: one(located, name, "commune", label) for name, (_, label) in LOCATED_IN.items()},   # E08-E10
        "has_departement": G.edge(s["france_departements"], "code_reg", "Region", "code_dep",
                                  "Departement"),                                                   # E11
        "has_commune": G.edge(com.filter(F.col("type_commune").isin(COM)), "code_dep", "Departement",
                              "code_commune", "Commune"),                                           # E12
        "has_commune_deleguee": G.edge(com.filter(F.col("type_commune").isin(COMMUNE_DELEGUEE)),
                                       "parent_code_commune", "Commune", "code_commune",
                                       "CommuneDeleguee"),                                          # E13
        "has_arrondissement": G.edge(com.filter(F.col("type_commune").isin(ARM)), "parent_code_commune",
                                     "Commune", "code_commune", "Arrondissement"),                  # E14
    }


# Node files small enough by nature (administrative geography) to be written
# as one CSV part each.
SINGLE_FILE_NODES = ("region", "departement", "commune", "commune_deleguee", "arrondissement")
