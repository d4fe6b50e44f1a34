"""Raw source contracts (S01-S22): where each source lands and how to read it.

A contract only states file-level facts (glob, format, delimiter, encoding,
preamble, whether headers drift between yearly files).  Column names come from
each file's own header and every CSV value is read as text; typing happens in
silver.  Header spellings that vary between releases are resolved in silver
with ``pick``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    name: str                    # logical source name
    pattern: str                 # file glob relative to the raw folder
    format: str = "csv"          # csv | parquet | json
    sep: str = ","
    encoding: str = "UTF-8"
    skip_lines: int = 0          # preamble lines before the header
    drifting_header: bool = False  # yearly files may reorder / rename columns
    prep: dict = field(default_factory=dict)  # file-name glob -> named preparation step (P03)
    multiline: bool = True       # quoted fields may hold newlines (records are cut by ``csv_records``)
    options: dict = field(default_factory=dict)


# Landing file patterns and read options of each raw source.
CONTRACTS: dict[str, Contract] = {c.name: c for c in [
    Contract("commande_publique_marche", "commande-publique-marche_*.parquet", "parquet"),
    Contract("commande_publique_concession", "commande-publique-concession_*.parquet", "parquet"),
    Contract("sirene_unite_legale", "sirene-unite-legal_*.parquet", "parquet"),
    Contract("sirene_etablissement", "sirene-etablissement_*.parquet", "parquet"),
    # code lists without free text: splittable reads
    Contract("france_communes", "communes-france_*.csv", multiline=False),
    Contract("france_departements", "departements-france_*.csv", multiline=False),
    Contract("france_regions", "regions-france_*.csv", multiline=False),
    Contract("culture_convention_subvention", "culture-convention-subvention_*.csv", sep=";",
             encoding="ISO-8859-1"),
    Contract("agriculture_subvention", "agriculture-subvention_*.csv", sep=";",
             encoding="windows-1252", skip_lines=2),
    Contract("anct_subvention_ville", "anct-subvention-ville-*.csv", sep=";",
             encoding="windows-1252", drifting_header=True,
             prep={"anct-subvention-ville-2019_*.csv": "anct_subvention_ville_2019"}),
    Contract("ademe_aide_financiere", "ademe-aide-financiere_*.csv"),
    Contract("dotation_soutien_territoire", "dotation-soutien-territoire-*.csv", sep=";",
             drifting_header=True),
    Contract("caisse_depots_subvention", "subvention-caisse-depots_*.csv"),
    Contract("idf_subvention_association", "idf-subvention-association_*.csv"),
    Contract("fonds_vert_subvention", "fonds-vert-subvention-*.csv", drifting_header=True),
]}

# Seeds (S16-S19): small reference code lists, read with an explicit all-text
# schema so codes such as "00" / "0000" keep their leading zeros.
SEEDS: dict[str, T.StructType] = {
    "insee_sirene_cat_juridique": T.StructType([
        T.StructField("code", T.StringType()), T.StructField("libelle", T.StringType()),
        T.StructField("type", T.IntegerType())]),
    "insee_sirene_naf": T.StructType([
        T.StructField("code", T.StringType()), T.StructField("libelle", T.StringType()),
        T.StructField("niveau", T.StringType())]),
    "nom_activite_artisanat": T.StructType([
        T.StructField("code", T.StringType()), T.StructField("libelle", T.StringType())]),
    "ministere_culture_division": T.StructType([
        T.StructField("type_division", T.StringType()), T.StructField("nom_division", T.StringType()),
        T.StructField("siret", T.StringType())]),
}

# The consolidated public-procurement document.  Scalars are read as text
# so a field holding 3 in one record and "NC" in another is kept as "3"/"NC".
_S = T.StringType()
_LIST = lambda inner: T.StructType([T.StructField(inner, T.ArrayType(_S))])
_PARTY = lambda wrapper: T.ArrayType(T.StructType([T.StructField(wrapper, T.StructType([
    T.StructField("typeIdentifiant", _S), T.StructField("id", _S)]))]))

MARCHE_SCHEMA = T.StructType([
    T.StructField("id", _S), T.StructField("acheteur", T.StructType([T.StructField("id", _S)])),
    T.StructField("nature", _S), T.StructField("objet", _S), T.StructField("codeCPV", _S),
    T.StructField("techniques", _LIST("technique")),
    T.StructField("modalitesExecution", _LIST("modaliteExecution")),
    T.StructField("ccag", _S), T.StructField("offresRecues", _S), T.StructField("tauxAvance", _S),
    T.StructField("typeGroupementOperateurs", _S), T.StructField("procedure", _S),
    T.StructField("lieuExecution", T.StructType([T.StructField("typeCode", _S), T.StructField("code", _S)])),
    T.StructField("dureeMois", _S), T.StructField("dateNotification", _S),
    T.StructField("datePublicationDonnees", _S), T.StructField("montant", _S),
    T.StructField("typesPrix", _LIST("typePrix")), T.StructField("formePrix", _S),
    T.StructField("origineUE", _S), T.StructField("origineFrance", _S),
    T.StructField("titulaires", _PARTY("titulaire")),
    T.StructField("considerationsSociales", _LIST("considerationSociale")),
    T.StructField("considerationsEnvironnementales", _LIST("considerationEnvironnementale")),
    T.StructField("source", _S), T.StructField("marcheInnovant", _S),
    T.StructField("attributionAvance", _S), T.StructField("sousTraitanceDeclaree", _S),
    T.StructField("idAccordCadre", _S),
])

CONCESSION_SCHEMA = T.StructType([
    T.StructField("id", _S), T.StructField("nature", _S), T.StructField("objet", _S),
    T.StructField("tauxAvance", _S), T.StructField("procedure", _S), T.StructField("dureeMois", _S),
    T.StructField("datePublicationDonnees", _S), T.StructField("origineUE", _S),
    T.StructField("origineFrance", _S),
    T.StructField("considerationsSociales", _LIST("considerationSociale")),
    T.StructField("considerationsEnvironnementales", _LIST("considerationEnvironnementale")),
    T.StructField("source", _S),
    T.StructField("autoriteConcedante", T.StructType([T.StructField("id", _S)])),
    T.StructField("dateSignature", _S), T.StructField("dateDebutExecution", _S),
    T.StructField("valeurGlobale", _S), T.StructField("montantSubventionPublique", _S),
    T.StructField("concessionnaires", _PARTY("concessionnaire")),
])

CONTRACT_DOCUMENT_SCHEMA = T.StructType([T.StructField("marches", T.StructType([
    T.StructField("marche", T.ArrayType(MARCHE_SCHEMA)),
    T.StructField("contrat-concession", T.ArrayType(CONCESSION_SCHEMA)),
]))])

# Where the document keeps its two arrays.
CONTRACT_ARRAYS = {"marche": ("marches", "marche"), "concession": ("marches", "contrat-concession")}
CONTRACT_SCHEMAS = {"marche": MARCHE_SCHEMA, "concession": CONCESSION_SCHEMA}
