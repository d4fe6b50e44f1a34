"""Silver models (V01-V20): rename, clean, cast, latest release, unnest,
enrich and conform — declarative select lists over the bronze frames using
the column helpers and relational operators.

``prune_files`` (default on): the release year comes from the raw file names,
so the newest release is applied as a literal and older release files are
skipped at listing; pass ``False`` for frames whose release is a computed
column (the scalar-subquery form then needs no extra pass) and ``None`` for
frames read from the files of one release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civgraph.functions import columns as X
from civgraph.functions.names import camel_to_snake
from civgraph.operators import relational as R


def pick(df: DataFrame, *names: str) -> Column:
    """First of several header spellings present in ``df`` (case-insensitive),
    coalesced when more than one exists; an error when none does, as a renamed
    raw column must not become NULL."""
    lower = {c.lower(): c for c in df.columns}
    found = [F.col(f"`{lower[n.lower()]}`") for n in names if n.lower() in lower]
    if not found:
        raise ValueError(f"no column {' / '.join(names)}; the source has {df.columns}")
    return found[0] if len(found) == 1 else F.coalesce(*found)


def renamed(df: DataFrame, mapping: dict[str, str]) -> list[Column]:
    return [pick(df, src).alias(dst) for src, dst in mapping.items()]


# ---------------------------------------------------------------- geography
# Raw header -> silver column names of the geography files.
COMMUNE_COLUMNS = {
    "typecom": "type_commune", "com": "code_commune", "reg": "code_reg", "dep": "code_dep",
    "ctcd": "code_collectivite_territorial", "arr": "arrondissement", "tncc": "type_name_format",
    "ncc": "name_commune_uppercase", "nccenr": "name_commune_typo_enriched", "libelle": "name_commune",
    "can": "canton_code", "comparent": "parent_code_commune",
}
DEPARTEMENT_COLUMNS = {
    "dep": "code_dep", "reg": "code_reg", "cheflieu": "code_commune_prefecture", "tncc": "type_name_format",
    "ncc": "name_dep_uppercase", "nccenr": "name_dep_typo_enriched", "libelle": "name_dep",
}
REGION_COLUMNS = {
    "reg": "code_reg", "cheflieu": "code_commune_cheflieu", "tncc": "type_name_format",
    "ncc": "name_reg_uppercase", "nccenr": "name_reg_typo_enriched", "libelle": "name_reg",
}


def _renamed_latest(brz: DataFrame, mapping: dict[str, str], prune_files: bool | None = True) -> DataFrame:
    return R.latest_release(brz.select(*renamed(brz, mapping), "release_year"), prune_files=prune_files)


def france_communes(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:            # V01
    return _renamed_latest(brz, COMMUNE_COLUMNS, prune_files)


def france_departements(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:        # V02
    return _renamed_latest(brz, DEPARTEMENT_COLUMNS, prune_files)


def france_regions(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:             # V03
    return _renamed_latest(brz, REGION_COLUMNS, prune_files)


# ---------------------------------------------------------------- registry
def categorie_juridique(seed: DataFrame, bounded: bool = True,
                        widths: tuple[int, ...] = (3, 2, 1)) -> DataFrame:       # V04
    """Three-level legal-category hierarchy; the seed is a bounded code list
    (``bounded=False`` for other lists of codes)."""
    return R.prefix_hierarchy(seed, "code", "libelle", "type", bounded=bounded, widths=widths)


# Raw columns of the legal-unit file (snake_case names follow
# from ``camel_to_snake``).
UNITE_LEGALE_RAW = [
    "siren", "statutDiffusionUniteLegale", "unitePurgeeUniteLegale", "dateCreationUniteLegale",
    "sigleUniteLegale", "sexeUniteLegale", "prenom1UniteLegale", "prenom2UniteLegale",
    "prenom3UniteLegale", "prenom4UniteLegale", "prenomUsuelUniteLegale", "pseudonymeUniteLegale",
    "identifiantAssociationUniteLegale", "trancheEffectifsUniteLegale", "anneeEffectifsUniteLegale",
    "dateDernierTraitementUniteLegale", "nombrePeriodesUniteLegale", "categorieEntreprise",
    "anneeCategorieEntreprise", "dateDebut", "etatAdministratifUniteLegale", "nomUniteLegale",
    "nomUsageUniteLegale", "denominationUniteLegale", "denominationUsuelle1UniteLegale",
    "denominationUsuelle2UniteLegale", "denominationUsuelle3UniteLegale",
    "categorieJuridiqueUniteLegale", "activitePrincipaleUniteLegale",
    "nomenclatureActivitePrincipaleUniteLegale", "nicSiegeUniteLegale",
    "economieSocialeSolidaireUniteLegale", "societeMissionUniteLegale",
    "caractereEmployeurUniteLegale", "activitePrincipaleNAF25UniteLegale",
]

# Raw columns of the establishment file; the ones in
# ETABLISSEMENT_PLAIN are never masked, all others may hold "[ND]".
ETABLISSEMENT_RAW = [
    "siren", "nic", "siret", "statutDiffusionEtablissement", "dateCreationEtablissement",
    "trancheEffectifsEtablissement", "anneeEffectifsEtablissement",
    "activitePrincipaleRegistreMetiersEtablissement", "dateDernierTraitementEtablissement",
    "etablissementSiege", "nombrePeriodesEtablissement", "complementAdresseEtablissement",
    "numeroVoieEtablissement", "indiceRepetitionEtablissement", "dernierNumeroVoieEtablissement",
    "indiceRepetitionDernierNumeroVoieEtablissement", "typeVoieEtablissement", "libelleVoieEtablissement",
    "codePostalEtablissement", "libelleCommuneEtablissement", "libelleCommuneEtrangerEtablissement",
    "distributionSpecialeEtablissement", "codeCommuneEtablissement", "codeCedexEtablissement",
    "libelleCedexEtablissement", "codePaysEtrangerEtablissement", "libellePaysEtrangerEtablissement",
    "identifiantAdresseEtablissement", "coordonneeLambertAbscisseEtablissement",
    "coordonneeLambertOrdonneeEtablissement", "complementAdresse2Etablissement",
    "numeroVoie2Etablissement", "indiceRepetition2Etablissement", "typeVoie2Etablissement",
    "libelleVoie2Etablissement", "codePostal2Etablissement", "libelleCommune2Etablissement",
    "libelleCommuneEtranger2Etablissement", "distributionSpeciale2Etablissement",
    "codeCommune2Etablissement", "codeCedex2Etablissement", "libelleCedex2Etablissement",
    "codePaysEtranger2Etablissement", "libellePaysEtranger2Etablissement", "dateDebut",
    "etatAdministratifEtablissement", "enseigne1Etablissement", "enseigne2Etablissement",
    "enseigne3Etablissement", "denominationUsuelleEtablissement", "activitePrincipaleEtablissement",
    "nomenclatureActivitePrincipaleEtablissement", "caractereEmployeurEtablissement",
    "activitePrincipaleNAF25Etablissement",
]
ETABLISSEMENT_PLAIN = {
    "siren", "nic", "siret", "statutDiffusionEtablissement", "dateCreationEtablissement",
    "trancheEffectifsEtablissement", "anneeEffectifsEtablissement",
    "activitePrincipaleRegistreMetiersEtablissement", "dateDernierTraitementEtablissement",
    "etablissementSiege", "nombrePeriodesEtablissement", "dateDebut", "etatAdministratifEtablissement",
    "activitePrincipaleEtablissement", "nomenclatureActivitePrincipaleEtablissement",
    "caractereEmployeurEtablissement", "activitePrincipaleNAF25Etablissement",
}
ETABLISSEMENT_DOUBLE = {"coordonneeLambertAbscisseEtablissement", "coordonneeLambertOrdonneeEtablissement"}


def sirene_unite_legale(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:        # V05
    cols = [pick(brz, c).alias(camel_to_snake(c)) for c in UNITE_LEGALE_RAW]
    return R.latest_release(brz.select(*cols, "release_year"), prune_files=prune_files)


def sirene_etablissement(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:       # V06
    cols = []
    for c in ETABLISSEMENT_RAW:
        v = pick(brz, c)
        if c not in ETABLISSEMENT_PLAIN:
            v = X.null_if(v.cast("string"), X.MASKED)
        if c in ETABLISSEMENT_DOUBLE:
            v = v.cast("double")
        cols.append(v.alias(camel_to_snake(c)))
    return R.latest_release(brz.select(*cols, "release_year"), prune_files=prune_files)


def ent_sirene_unite_legale(ul: DataFrame, naf: DataFrame, catj: DataFrame,
                            bounded: bool = True) -> DataFrame:  # V17
    naf_sc = naf.filter(F.col("niveau") == "sousclasse")
    out = R.lookup_label(ul, naf_sc, {"activite_principale_unite_legale": "code"},
                         {"libelle": "activite_principale_unite_legale_libelle"}, bounded=True)
    out = R.lookup_label(out, catj, {"categorie_juridique_unite_legale": "code_iii"},
                         {"libelle_iii": "categorie_juridique_unite_legale_libelle_iii",
                          "libelle_ii": "categorie_juridique_unite_legale_libelle_ii",
                          "libelle_i": "categorie_juridique_unite_legale_libelle_i"}, bounded=bounded)
    name = X.display_name("denomination_unite_legale", "prenom_usuel_unite_legale", "nom_unite_legale")
    return out.select(
        "siren", "statut_diffusion_unite_legale", "unite_purgee_unite_legale", "date_creation_unite_legale",
        "identifiant_association_unite_legale", "tranche_effectifs_unite_legale",
        "annee_effectifs_unite_legale", "date_dernier_traitement_unite_legale", "date_debut",
        "etat_administratif_unite_legale", "activite_principale_unite_legale",
        "activite_principale_unite_legale_libelle", "categorie_juridique_unite_legale",
        "categorie_juridique_unite_legale_libelle_iii", "categorie_juridique_unite_legale_libelle_ii",
        "categorie_juridique_unite_legale_libelle_i", "nic_siege_unite_legale",
        "economie_sociale_solidaire_unite_legale", "societe_mission_unite_legale", "release_year",
        name.alias("denomination_unite_legale"))


# The establishment columns that are kept.
ENT_ETABLISSEMENT_COLUMNS = [
    "siren", "nic", "siret", "statut_diffusion_etablissement", "date_creation_etablissement",
    "tranche_effectifs_etablissement", "annee_effectifs_etablissement",
    "activite_principale_registre_metiers_etablissement",
    "activite_principale_registre_metiers_etablissement_libelle",
    "date_dernier_traitement_etablissement", "etablissement_siege", "nombre_periodes_etablissement",
    "complement_adresse_etablissement", "numero_voie_etablissement", "type_voie_etablissement",
    "libelle_voie_etablissement", "code_postal_etablissement", "libelle_commune_etablissement",
    "libelle_commune_etranger_etablissement", "code_commune_etablissement", "code_cedex_etablissement",
    "libelle_cedex_etablissement", "code_pays_etranger_etablissement", "libelle_pays_etranger_etablissement",
    "identifiant_adresse_etablissement", "coordonnee_lambert_abscisse_etablissement",
    "coordonnee_lambert_ordonnee_etablissement", "date_debut", "etat_administratif_etablissement",
    "enseigne1_etablissement", "denomination_usuelle_etablissement", "activite_principale_etablissement",
    "caractere_employeur_etablissement", "release_year",
]


def ent_sirene_etablissement(eta: DataFrame, artisanat: DataFrame) -> DataFrame:  # V18
    out = R.lookup_label(eta, artisanat, {"activite_principale_registre_metiers_etablissement": "code"},
                         {"libelle": "activite_principale_registre_metiers_etablissement_libelle"},
                         bounded=True)
    return out.select(*ENT_ETABLISSEMENT_COLUMNS)


def head_offices(eta: DataFrame) -> DataFrame:
    """``siret, siren`` of head-office establishments (F09 bare predicate)."""
    return eta.filter(F.col("etablissement_siege").cast("boolean")).select("siret", "siren")


# ---------------------------------------------------------------- procurement
def commande_publique_marche(brz: DataFrame, latest_only: bool = False) -> DataFrame:  # V07
    """Markets, one row per awardee.  All releases are kept, as in the
    reference (a contract republished in a later release appears twice);
    ``latest_only=True`` keeps the newest release only."""
    if latest_only:
        brz = R.latest_release(brz, prune_files=True)
    flat = brz.select(
        F.col("id").alias("marche_id"), F.col("acheteur.id").alias("acheteur_siret"), "nature", "objet",
        F.col("codecpv").alias("code_cpv"),
        X.list_to_text("techniques.technique").alias("techniques"),
        X.list_to_text("modalitesexecution.modaliteexecution").alias("modalites_execution"),
        "ccag",
        X.int_rounding(X.null_if(F.col("offresrecues").cast("string"), X.NOT_COMMUNICATED)).alias("offre_recues"),
        F.col("tauxavance").cast("double").alias("taux_avance"),
        F.col("typegroupementoperateurs").alias("type_groupement_operateurs"), "procedure",
        F.col("lieuexecution.typecode").alias("lieu_execution_type"),
        F.col("lieuexecution.code").alias("lieu_execution_code"),
        X.int_rounding("dureemois").alias("duree_mois"),
        X.parse_date("datenotification").alias("date_notification"),
        X.parse_date("datepublicationdonnees").alias("date_publication_donnees"),
        F.col("montant").cast("double").alias("montant"),
        X.list_to_text("typesprix.typeprix").alias("types_prix"),
        F.col("formeprix").alias("forme_prix"), F.col("origineue").alias("origine_ue"),
        F.col("originefrance").alias("origine_france"),
        "titulaires",
        X.list_to_text("considerationssociales.considerationsociale").alias("considerations_sociales"),
        X.list_to_text("considerationsenvironnementales.considerationenvironnementale")
         .alias("considerations_environnementales"),
        "source", F.col("marcheinnovant").alias("marche_innovant"),
        F.col("attributionavance").alias("attribution_avance"),
        F.col("soustraitancedeclaree").alias("sous_traitance_declaree"),
        F.col("idaccordcadre").alias("id_accord_cadre"), "release_year")
    out = R.explode_parties(flat, "titulaires", count_as="nb_titulaires",
                            rename={"id": "titulaire_id", "typeIdentifiant": "titulaire_type_identifiant"})
    return out.withColumnRenamed("marche_id", "id")


def commande_publique_concession(brz: DataFrame, latest_only: bool = False) -> DataFrame:  # V08
    """Concessions, one row per awardee; all releases kept unless ``latest_only``."""
    if latest_only:
        brz = R.latest_release(brz, prune_files=True)
    flat = brz.select(
        F.col("id").alias("concession_id"), "nature", "objet",
        F.col("tauxavance").cast("double").alias("taux_avance"), "procedure",
        X.int_rounding("dureemois").alias("duree_mois"),
        X.parse_date("datepublicationdonnees").alias("date_publication_donnes"),
        F.col("origineue").alias("origine_ue"), F.col("originefrance").alias("origine_france"),
        X.list_to_text("considerationssociales.considerationsociale").alias("considerations_sociales"),
        X.list_to_text("considerationsenvironnementales.considerationenvironnementale")
         .alias("considerations_environnementales"),
        "source", F.col("autoriteconcedante.id").alias("autorite_concedante_siret"),
        X.parse_date("datesignature").alias("date_signature"),
        X.parse_date("datedebutexecution").alias("date_debut_execution"),
        F.col("valeurglobale").cast("double").alias("valeur_globale"),
        F.col("montantsubventionpublique").cast("double").alias("montant_subvention_publique"),
        "concessionnaires", "release_year")
    out = R.explode_parties(flat, "concessionnaires",
                            rename={"id": "concesionnaire_id",
                                    "typeIdentifiant": "concesionnaire_type_identifiant"})
    return out.withColumnRenamed("concession_id", "id")


# Columns of the contract table.
CONTRACT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("id", T.StringType()), ("id_contrat", T.StringType()), ("type_contrat", T.StringType()),
    ("siret_autorite", T.StringType()), ("id_titulaire", T.StringType()),
    ("type_identifiant_titulaire", T.StringType()), ("nature", T.StringType()), ("objet", T.StringType()),
    ("procedure", T.StringType()), ("duree_mois", T.IntegerType()), ("montant", T.DoubleType()),
    ("taux_avance", T.DoubleType()), ("date_contrat", T.DateType()), ("date_publication", T.DateType()),
    ("date_debut_execution", T.DateType()), ("origine_ue", T.StringType()),
    ("origine_france", T.StringType()), ("considerations_sociales", T.StringType()),
    ("considerations_environnementales", T.StringType()), ("source", T.StringType()),
    ("code_lieu_execution", T.StringType()), ("type_lieu_execution", T.StringType()),
    ("nombre_offres", T.IntegerType()), ("type_prix", T.StringType()), ("structure_prix", T.StringType()),
    ("montant_subvention_publique", T.DoubleType())]])


def contract_union(marche: DataFrame, concession: DataFrame) -> DataFrame:
    """Markets and concessions in one shape, tagged by ``type_contrat``."""
    common = ["nature", "objet", "procedure", "duree_mois", "taux_avance", "origine_ue", "origine_france",
              "considerations_sociales", "considerations_environnementales", "source"]
    m = R.conform(marche, CONTRACT_SCHEMA, {
        **{c: c for c in common}, "id_contrat": "id", "type_contrat": F.lit("marche"),
        "siret_autorite": "acheteur_siret", "id_titulaire": "titulaire_id",
        "type_identifiant_titulaire": "titulaire_type_identifiant", "montant": "montant",
        "date_contrat": "date_notification", "date_publication": "date_publication_donnees",
        "code_lieu_execution": "lieu_execution_code", "type_lieu_execution": "lieu_execution_type",
        "nombre_offres": "offre_recues", "type_prix": "types_prix", "structure_prix": "forme_prix"})
    c = R.conform(concession, CONTRACT_SCHEMA, {
        **{k: k for k in common}, "id_contrat": "id", "type_contrat": F.lit("concession"),
        "siret_autorite": "autorite_concedante_siret", "id_titulaire": "concesionnaire_id",
        "type_identifiant_titulaire": "concesionnaire_type_identifiant", "montant": "valeur_globale",
        "date_contrat": "date_signature", "date_publication": "date_publication_donnes",
        "date_debut_execution": "date_debut_execution",
        "montant_subvention_publique": "montant_subvention_publique"})
    return R.conform_union([m, c]).drop("id")


def ent_commande_publique(marche: DataFrame, concession: DataFrame, by_hash: bool = False,
                          staged=lambda df: df) -> DataFrame:  # V19
    """The contract union with an id that only the row's own values decide;
    ``by_hash`` for frames that read stored tables (see ``with_surrogate_key``),
    or for a union that ``staged`` writes."""
    return R.with_surrogate_key(staged(contract_union(marche, concession)), "id", by_hash).select(*CONTRACT_SCHEMA.fieldNames())


# ---------------------------------------------------------------- subsidies
# Accented headers of the culture file -> silver names.  The
# "l'op." columns are also accepted with a doubled apostrophe.
CULTURE_COLUMNS = {
    "Origine des crédits": "origine_credits", "Détail origine des crédits": "detail_origine_credits",
    "CPER": "cper", "Nom du bénéficiaire": "nom_beneficiaire", "Région du bénéficiaire": "region_beneficiaire",
    "Département du bénéficiaire": "departement_beneficiaire", "EPCI du bénéficiaire": "epci_beneficiaire",
    "Sous-types de communes du bénéficiaire": "sous_types_communes_beneficiaire",
    "Code postal du bénéficiaire": "code_postal_beneficiaire",
    "Code commune du bénéficiaire": "code_commune_beneficiaire", "Commune du bénéficiaire": "commune_beneficiaire",
    "N° SIREN du bénéficiaire": "siren_beneficiaire", "N° SIRET du bénéficiaire": "siret_beneficiaire",
    "N° EJ": "num_engagement_juridique", "Titre": "titre", "Mission": "mission", "Programme": "programme",
    "Localisation interministérielle": "localisation_interministerielle",
    "Fonctionnement/Investissement": "fonctionnement_investissement",
    "Domaine fonctionnel": "domaine_fonctionnel", "Compte budgétaire": "compte_budgetaire",
    "Code activité": "code_activite", "Activité libellé long": "activite_libelle_long",
    "Activité libellé court": "activite_libelle_court", "Centre financier": "centre_financier",
    "Centre de coût": "centre_cout",
}
CULTURE_OP_COLUMNS = {
    "Appellation": "appellation", "Région": "region", "Département": "departement",
    "Code postal": "code_postal", "Code commune": "code_commune", "Commune": "commune",
}
CULTURE_OP_SUFFIX = " unité patrimoniale concernée par l{q}op. fin."


def subvention_ministere_culture(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:  # V09
    cols = [pick(brz, "Année").cast("int").alias("annee")]
    cols += renamed(brz, {k: v for k, v in list(CULTURE_COLUMNS.items())[:3]})
    cols.append(pick(brz, "Montant engagé").cast("double").alias("montant_engage"))
    cols += renamed(brz, {k: v for k, v in list(CULTURE_COLUMNS.items())[3:]})
    for head, name in CULTURE_OP_COLUMNS.items():
        variants = [head + CULTURE_OP_SUFFIX.format(q=q) for q in ("'", "''")]
        cols.append(pick(brz, *variants).alias(f"{name}_unite_patrimoniale_concernee_par_lop_fin"))
    return R.latest_release(brz.select(*cols, "release_year"), prune_files=prune_files)


def subvention_ministere_agriculture(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:  # V10
    payer = pick(brz, "Nom attributaire*")
    out = brz.select(
        payer.alias("nom_attributaire"),
        X.strip_blanks(pick(brz, "Identification de l'attributaire*")).alias("identification_attributaire"),
        pick(brz, "Date de convention*").alias("date_convention"),
        X.strip_blanks(pick(brz, "Référence de la décision")).alias("reference_decision"),
        X.strip_blanks(pick(brz, "Identification du bénéficiaire*")).alias("identification_beneficiaire"),
        pick(brz, "Nom du bénéficiaire*").alias("nom_beneficiaire"),
        pick(brz, "Objet de la convention").alias("objet_convention"),
        X.thousands_amount(pick(brz, "Montant total de la subvention*")).alias("montant_total_subvention"),
        pick(brz, "Nature de la subvention*").alias("nature_subvention"),
        pick(brz, "Conditions de versement*").alias("conditions_versement"),
        pick(brz, "Date de versement").alias("date_versement"),
        pick(brz, "Numéro de référencement au répertoire des entreprises")
        .alias("numero_referencement_repertoire_entreprises"),
        pick(brz, "Aide notifiée à l'Europe").alias("aide_notifiee_europe"),
        pick(brz, "Pourcentage du montant de la subvention attribué au bénéficiaire*").cast("double")
        .alias("pourcentage_montant_attribue_beneficiaire"),
        "release_year")
    # rows whose payer starts with "Généré" are export footers; NULL payers drop too
    return R.latest_release(out, prune_files=prune_files).filter(~F.col("nom_attributaire").like("Généré%"))


FILE_STEM = r"([^/]*)_\d{4}[^/]*(?:/part-[^/]*)?$"


def file_stem(path_col: str = "source_file_path") -> Column:
    """File name without its fetch-year suffix: ``.../anct-subvention-ville-2024_2026.csv``
    -> ``anct-subvention-ville-2024`` (one group per data year of a multi-file source)."""
    return F.regexp_extract(F.col(path_col), FILE_STEM, 1)


def _newest(out: DataFrame, prune_files: bool | None, per_file_stem: bool) -> DataFrame:
    """Newest release overall (reference behaviour) or, with ``per_file_stem``,
    the newest release of each data file — so a data year not yet refetched
    this year is not dropped."""
    if per_file_stem:
        return R.latest_release(out, by=["__stem"]).drop("__stem")
    return R.latest_release(out, prune_files=prune_files)


def subvention_anct_ville(brz: DataFrame, prune_files: bool | None = True,
                          per_file_stem: bool = False) -> DataFrame:      # V11
    out = brz.select(
        pick(brz, "Nom de l'attribuant").alias("nom_attribuant"),
        pick(brz, "Identification de l'attributaire").alias("identification_attributaire"),
        X.parse_date_any(pick(brz, "Date de la convention de subvention")).alias("date_convention_subvention"),
        pick(brz, "Code département/Direction").alias("code_departement_direction"),
        pick(brz, "Libellé département/Direction").alias("libelle_departement_direction"),
        X.strip_blanks(pick(brz, "Référence de la décision")).alias("reference_decision"),
        pick(brz, "Identification du bénéficiaire").alias("identification_beneficiaire"),
        pick(brz, "Nom du bénéficiaire").alias("nom_beneficiaire"),
        pick(brz, "Objet de la subvention").alias("objet_subvention"),
        X.decimal_comma(pick(brz, "Montant total de la subvention")).alias("montant_total_subvention"),
        pick(brz, "Nature de la subvention").alias("nature_subvention"),
        pick(brz, "Conditions de versement").alias("conditions_versement"),
        X.parse_date_any(pick(brz, "Date de versement")).alias("date_versement"),
        pick(brz, "RAE").alias("rae"), pick(brz, "notificationUE").alias("notification_ue"),
        pick(brz, "PourcentageSubvention").cast("double").alias("pourcentage_subvention"),
        "release_year", *([file_stem().alias("__stem")] if per_file_stem else []))
    return _newest(out, prune_files, per_file_stem).filter(F.col("identification_attributaire").isNotNull())


def subvention_ademe(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:           # V12
    out = brz.select(
        pick(brz, "Nom de l attribuant").alias("nom_attribuant"),
        pick(brz, "idAttribuant").cast("string").alias("id_attribuant"),
        pick(brz, "dateConvention").alias("date_convention"),
        pick(brz, "referenceDecision").alias("reference_decision"),
        pick(brz, "nomBeneficiaire").alias("nom_beneficiaire"),
        pick(brz, "idBeneficiaire").cast("string").alias("id_beneficiaire"),
        pick(brz, "objet").alias("objet"), pick(brz, "dispositifAide").alias("dispositif_aide"),
        pick(brz, "montant").cast("double").alias("montant"), pick(brz, "nature").alias("nature"),
        pick(brz, "conditionsVersement").alias("conditions_versement"),
        pick(brz, "datesPeriodeVersement").alias("dates_periode_versement"),
        pick(brz, "idRAE").alias("id_rae"), pick(brz, "notificationUE").alias("notification_ue"),
        "release_year")
    return R.latest_release(out, prune_files=prune_files)


def dotation_soutien_territoire(brz: DataFrame, prune_files: bool | None = True,
                                per_file_stem: bool = False) -> DataFrame:  # V13
    out = brz.select(
        pick(brz, "exercice").cast("int").alias("exercice"), pick(brz, "dispositif").alias("dispositif"),
        pick(brz, "programme").alias("programme"), pick(brz, "beneficiaire_type").alias("beneficiaire_type"),
        pick(brz, "beneficiaire_siren").cast("string").alias("beneficiaire_siren"),
        pick(brz, "beneficiaire_dep").alias("beneficiaire_dep"),
        pick(brz, "beneficiaire_nom").alias("beneficiaire_nom"),
        pick(brz, "beneficiaire_code_insee").alias("beneficiaire_code_insee"),
        pick(brz, "intitule").alias("intitule"),
        X.decimal_comma(pick(brz, "cout_ht")).alias("cout_ht"),
        X.decimal_comma(pick(brz, "subvention")).alias("subvention"),
        X.decimal_comma(pick(brz, "taux")).alias("taux"),
        "release_year", *([file_stem().alias("__stem")] if per_file_stem else []))
    return _newest(out, prune_files, per_file_stem).filter(F.col("subvention").isNotNull())


def subvention_caisse_depots(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:   # V14
    out = brz.select(
        pick(brz, "nomAttribuant").alias("nom_attribuant"),
        pick(brz, "IdAttribuant").cast("string").alias("id_attribuant"),
        X.month_start(pick(brz, "DateConvention")).alias("date_convention"),
        pick(brz, "ReferenceDecision").alias("reference_decision"),
        pick(brz, "IdBeneficiaire").cast("string").alias("id_beneficiaire"),
        pick(brz, "NomBeneficiaire").alias("nom_beneficiaire"), pick(brz, "Objet").alias("objet"),
        pick(brz, "Montant").cast("double").alias("montant"), pick(brz, "Nature").alias("nature"),
        pick(brz, "ConditionsVersement").alias("conditions_versement"),
        pick(brz, "DatesVersement_debut").alias("dates_versement_debut"),
        pick(brz, "DatesVersement_fin").alias("dates_versement_fin"),
        pick(brz, "IdRAE").cast("string").alias("id_rae"),
        pick(brz, "NotificationUE").alias("notification_ue"),
        pick(brz, "PourcentageSubvention").cast("double").alias("pourcentage_subvention"),
        "release_year")
    return R.latest_release(out, prune_files=prune_files)


def idf_subvention_association(brz: DataFrame, prune_files: bool | None = True) -> DataFrame:  # V15
    na = X.NOT_AVAILABLE
    out = brz.select(
        pick(brz, "idAttribuant").cast("string").alias("id_attribuant"),
        pick(brz, "nomAttribuant").alias("nom_attribuant"),
        pick(brz, "anneeExercice").cast("int").alias("annee_exercice"),
        pick(brz, "dateConvention").cast("date").alias("date_convention"),
        X.null_if(pick(brz, "referenceDecision"), na).alias("reference_decision"),
        X.null_if(pick(brz, "idDossier"), na).alias("id_dossier"),
        X.null_if(pick(brz, "idBeneficiaire").cast("string"), na).alias("id_beneficiaire"),
        pick(brz, "nomBeneficiaire").alias("nom_beneficiaire"),
        X.null_if(pick(brz, "objet"), na).alias("objet"),
        pick(brz, "montant").cast("double").alias("montant"),
        pick(brz, "datesPeriodeVersement").alias("dates_periode_versement"),
        pick(brz, "delegation").cast("boolean").alias("delegation"),
        pick(brz, "gestionFondsEuropeens").cast("boolean").alias("gestion_fonds_europeens"),
        pick(brz, "pourcentageSubvention").cast("double").alias("pourcentage_subvention"),
        pick(brz, "dispositifAide").alias("dispositif_aide"),
        "release_year")
    return R.latest_release(out, prune_files=prune_files)


def with_siren_key(df: DataFrame, siren: str, out: str, pad_siren: bool) -> DataFrame:
    """Join key for a SIREN read from a file: as is (reference behaviour), or
    left-padded to 9 digits when an upstream tool dropped leading zeros."""
    key = F.col(siren).cast("string")
    return df.withColumn(out, F.when(F.length(key) < 9, F.lpad(key, 9, "0")).otherwise(key) if pad_siren else key)


def fonds_vert_subvention(brz: DataFrame, etablissements: DataFrame, prune_files: bool | None = True,
                          pad_siren: bool = False) -> DataFrame:  # V16
    newest = with_siren_key(R.latest_release(brz, prune_files=prune_files), "siren", "__siren", pad_siren)
    filled = R.fill_from_primary(newest, head_offices(etablissements), "__siren", "siren", "siret",
                                 "__siret", own_value=pick(brz, "siret_beneficiaire"))
    keep = ["nom_region", "code_departement", "nom_departement", "code_commune", "nom_commune",
            "numero_dossier_ds", "nom_du_projet", "nom_beneficiaire_principal"]
    return filled.select(
        *[pick(brz, c).alias(c) for c in keep],
        pick(brz, "montant_engage").cast("double").alias("montant_engage"),
        *[pick(brz, c).alias(c) for c in ["resume_du_projet", "numero_ej", "numero_operateur"]],
        pick(brz, "operateur", "opérateur").alias("operateur"),
        pick(brz, "demarche").alias("demarche"),
        F.col("__siret").alias("siret_beneficiaire"),
        pick(brz, "raison_sociale_beneficiaire").alias("raison_sociale_beneficiaire"),
        pick(brz, "forme juridique_beneficiaire", "forme_juridique_beneficiaire")
        .alias("forme_juridique_beneficiaire"),
        "exercice", "release_year")


# Columns of the subsidy table.
SUBSIDY_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("date_subvention", T.DateType()), ("code_commune", T.StringType()), ("nom_projet", T.StringType()),
    ("description_projet", T.StringType()), ("reference_decision", T.StringType()),
    ("nom_beneficiaire", T.StringType()), ("siret_beneficiaire", T.StringType()),
    ("siret_crediteur", T.StringType()), ("montant", T.DoubleType()), ("domaine", T.StringType()),
    ("origine_data", T.StringType())]])

# Domain and provider tags of each subsidy source, and the
# payer SIRET of the green fund.
SUBSIDY_TAGS = {
    "culture": ("culture", "Ministère de la culture"),
    "agriculture": ("agriculture", "Ministère de l'agriculture"),
    "anct": ("territoires", "Agence nationale de la cohésion des territoires"),
    "ademe": ("environnement", "Agence de l'environnement et de la maîtrise de l'énergie"),
    "dotation": ("territoires", "Direction générale des collectivités territoriales"),
    "caisse": ("developpement", "Caisse des Dépôts"),
    "idf": ("association", "Région Île-de-France"),
    "fonds_vert": ("environnement", "Ministère de la Transition écologique"),
}
FONDS_VERT_PAYER_SIRET = "11006801200050"


def _tags(key: str) -> dict:
    dom, org = SUBSIDY_TAGS[key]
    return {"domaine": F.lit(dom), "origine_data": F.lit(org)}


def ent_subvention_publique(culture: DataFrame, divisions: DataFrame, agriculture: DataFrame,
                            anct: DataFrame, ademe: DataFrame, dotation: DataFrame, caisse: DataFrame,
                            idf: DataFrame, fonds_vert: DataFrame, etablissements: DataFrame,
                            pad_siren: bool = False, by_hash: bool = False,
                            staged=lambda df: df) -> DataFrame:  # V20
    cul = R.lookup_label(culture, divisions, {"origine_credits": "type_division",
                                              "detail_origine_credits": "nom_division"},
                         {"siret": "__payer"}, bounded=True)
    branches = [
        R.conform(cul, SUBSIDY_SCHEMA, {
            "date_subvention": X.year_start("annee"),
            "code_commune": F.coalesce("code_commune_unite_patrimoniale_concernee_par_lop_fin",
                                       "code_commune_beneficiaire"),
            "nom_projet": X.concat_skip_null("mission", F.lit(" - "), "programme"),
            "description_projet": "activite_libelle_long", "reference_decision": "num_engagement_juridique",
            "nom_beneficiaire": "nom_beneficiaire", "siret_beneficiaire": "siret_beneficiaire",
            "siret_crediteur": "__payer", "montant": "montant_engage", **_tags("culture")}),
        R.conform(agriculture, SUBSIDY_SCHEMA, {
            "date_subvention": F.col("date_convention").cast("date"), "description_projet": "objet_convention",
            "reference_decision": "reference_decision", "nom_beneficiaire": "nom_beneficiaire",
            "siret_beneficiaire": "identification_beneficiaire",
            "siret_crediteur": "identification_attributaire", "montant": "montant_total_subvention",
            **_tags("agriculture")}),
        R.conform(anct, SUBSIDY_SCHEMA, {
            "date_subvention": F.coalesce("date_versement", "date_convention_subvention"),
            "description_projet": "objet_subvention", "reference_decision": "reference_decision",
            "nom_beneficiaire": "nom_beneficiaire", "siret_beneficiaire": "identification_beneficiaire",
            "siret_crediteur": "identification_attributaire", "montant": "montant_total_subvention",
            **_tags("anct")}),
        R.conform(ademe, SUBSIDY_SCHEMA, {
            "date_subvention": F.col("date_convention").cast("date"), "description_projet": "objet",
            "reference_decision": "reference_decision", "nom_beneficiaire": "nom_beneficiaire",
            "siret_beneficiaire": "id_beneficiaire", "siret_crediteur": "id_attribuant",
            "montant": "montant", **_tags("ademe")}),
        R.conform(R.fill_from_primary(with_siren_key(dotation, "beneficiaire_siren", "__siren", pad_siren),
                                      head_offices(etablissements), "__siren", "siren", "siret", "__siret"),
                  SUBSIDY_SCHEMA, {
            "date_subvention": X.year_start("exercice"), "code_commune": "beneficiaire_code_insee",
            "nom_projet": "intitule", "description_projet": "intitule", "nom_beneficiaire": "beneficiaire_nom",
            "siret_beneficiaire": "__siret", "montant": "subvention", **_tags("dotation")}),
        R.conform(caisse, SUBSIDY_SCHEMA, {
            "date_subvention": "date_convention", "description_projet": "objet",
            "reference_decision": "reference_decision", "nom_beneficiaire": "nom_beneficiaire",
            "siret_beneficiaire": "id_beneficiaire", "siret_crediteur": "id_attribuant",
            "montant": "montant", **_tags("caisse")}),
        R.conform(idf, SUBSIDY_SCHEMA, {
            "date_subvention": "date_convention", "description_projet": "objet",
            "reference_decision": "reference_decision", "nom_beneficiaire": "nom_beneficiaire",
            "siret_beneficiaire": "id_beneficiaire", "siret_crediteur": "id_attribuant",
            "montant": "montant", **_tags("idf")}),
        R.conform(fonds_vert, SUBSIDY_SCHEMA, {
            "date_subvention": X.year_start("exercice"), "code_commune": "code_commune",
            "nom_projet": "nom_du_projet", "description_projet": "resume_du_projet",
            "reference_decision": F.coalesce("numero_ej", "numero_dossier_ds"),
            "nom_beneficiaire": "nom_beneficiaire_principal", "siret_beneficiaire": "siret_beneficiaire",
            "siret_crediteur": F.lit(FONDS_VERT_PAYER_SIRET), "montant": "montant_engage",
            **_tags("fonds_vert")}),
    ]
    union = staged(R.conform_union(branches))
    return R.with_surrogate_key(union, "id", by_hash).select("id", *SUBSIDY_SCHEMA.fieldNames())
