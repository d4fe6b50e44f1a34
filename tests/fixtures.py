"""Tiny raw open-data fixtures (FIXTURES.md §1-§5) written to a folder.

Covers the edge cases every model must handle: two releases, contracts with
0 / NULL / 1 / 3 awardees and a TVA-typed awardee, label text with CR/LF/tabs
and > 200 characters, masked names, two date formats and garbage, opposite
comma meanings, COM+COMD code, ARM with parent, unknown / NULL / empty SIRET,
leading zeros and "2A", "Généré" footer and NULL payer, separator-only first
line and tripled quotes, reordered / renamed headers, € and œ in cp1252.
"""

from __future__ import annotations

import csv
import io
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq

LONG_OBJET = "Travaux\r\nde  voirie\tet " + ("réseaux " * 40) + "fin"


def _csv(path: str, header: list[str], rows: list[list], sep: str = ",", encoding: str = "utf-8",
         preamble: list[str] = (), raw_prefix: str = "") -> None:
    buf = io.StringIO()
    for line in preamble:
        buf.write(line + "\n")
    buf.write(raw_prefix)
    w = csv.writer(buf, delimiter=sep, lineterminator="\n")
    w.writerow(header)
    for r in rows:
        w.writerow(["" if v is None else v for v in r])
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(buf.getvalue())


def write_geo(raw: str) -> None:
    h = ["TYPECOM", "COM", "REG", "DEP", "CTCD", "ARR", "TNCC", "NCC", "NCCENR", "LIBELLE", "CAN", "COMPARENT"]
    old = [["COM", "01001", "84", "01", "01D", "012", "5", "ABERGEMENT", "Abergement", "L'Abergement", "0108", ""]]
    new = [
        ["COM", "01001", "84", "01", "01D", "012", "5", "ABERGEMENT", "Abergement", "L'Abergement", "0108", ""],
        ["COM", "2A004", "94", "2A", "20R", "2A1", "1", "AJACCIO", "Ajaccio", "Ajaccio", "2A98", ""],
        ["COM", "75056", "11", "75", "75C", "751", "0", "PARIS", "Paris", "Paris", "7598", ""],
        ["ARM", "75101", "11", "75", "75C", "751", "0", "PARIS 1ER", "Paris 1er", "Paris 1er", "", "75056"],
        ["COMD", "01001", "84", "01", "01D", "012", "5", "ABERGEMENT D", "Abergement d", "Abergement délégué", "", "01001"],
        ["COMA", "01002", "84", "01", "01D", "012", "5", "ASSOC", "Assoc", "Associée", "", "01001"],
    ]
    _csv(f"{raw}/communes-france_2025.csv", h, old)
    _csv(f"{raw}/communes-france_2026.csv", h, new)
    hd = ["DEP", "REG", "CHEFLIEU", "TNCC", "NCC", "NCCENR", "LIBELLE"]
    _csv(f"{raw}/departements-france_2026.csv", hd, [
        ["01", "84", "01053", "5", "AIN", "Ain", "Ain"], ["2A", "94", "2A004", "3", "CORSE DU SUD", "Corse-du-Sud", "Corse-du-Sud"],
        ["75", "11", "75056", "0", "PARIS", "Paris", "Paris"]])
    hr = ["REG", "CHEFLIEU", "TNCC", "NCC", "NCCENR", "LIBELLE"]
    _csv(f"{raw}/regions-france_2026.csv", hr, [
        ["84", "69123", "1", "AUVERGNE RHONE ALPES", "Auvergne-Rhône-Alpes", "Auvergne-Rhône-Alpes"],
        ["94", "2A004", "0", "CORSE", "Corse", "Corse"], ["11", "75056", "1", "ILE DE FRANCE", "Île-de-France", "Île-de-France"]])


UL_COLS = None  # filled lazily from the silver contract


def write_sirene(raw: str) -> None:
    from civgraph.plans.silver import ETABLISSEMENT_RAW, UNITE_LEGALE_RAW
    def ul(siren, denom, prenom, nom, cat="5710", naf="62.01Z"):
        r = {c: None for c in UNITE_LEGALE_RAW}
        r.update(siren=siren, denominationUniteLegale=denom, prenomUsuelUniteLegale=prenom,
                 nomUniteLegale=nom, categorieJuridiqueUniteLegale=cat, activitePrincipaleUniteLegale=naf,
                 etatAdministratifUniteLegale="A")
        return r
    rows = [ul("012345678", "ACME", None, None), ul("111111111", "[ND]", "Jean", "Dupont", "1000"),
            ul("222222222", "[ND]", "[ND]", "[ND]", "9999"), ul("333333333", None, None, "Seul", "5499")]
    ul_schema = pa.schema([(c, pa.string()) for c in UNITE_LEGALE_RAW])
    pq.write_table(pa.Table.from_pylist(rows, schema=ul_schema), f"{raw}/sirene-unite-legal_2026.parquet")
    # an older release whose workforce year was still an integer (type drift)
    old = pa.Table.from_pylist([ul("999999999", "OLD", None, None)], schema=ul_schema)
    old = old.set_column(old.schema.get_field_index("anneeEffectifsUniteLegale"), "anneeEffectifsUniteLegale",
                         pa.array([2019], pa.int32()))
    pq.write_table(old, f"{raw}/sirene-unite-legal_2025.parquet")
    def eta(siret, siege, commune, enseigne="[ND]", x="[ND]", artisanat=None):
        r = {c: None for c in ETABLISSEMENT_RAW}
        r.update(siren=siret[:9], nic=siret[9:], siret=siret, etablissementSiege=siege,
                 codeCommuneEtablissement=commune, enseigne1Etablissement=enseigne,
                 coordonneeLambertAbscisseEtablissement=x, coordonneeLambertOrdonneeEtablissement="6570000.5",
                 activitePrincipaleRegistreMetiersEtablissement=artisanat, libelleVoieEtablissement="[ND]")
        return r
    etas = [eta("01234567800011", True, "01001", "Boutique", "870000.1", "0162ZP"),
            eta("01234567800029", False, "75101"),
            eta("11111111100015", True, "2A004"),
            eta("22222222200012", True, "01002"),
            eta("33333333300019", True, None)]
    schema = pa.schema([(c, pa.bool_() if c == "etablissementSiege" else pa.string()) for c in ETABLISSEMENT_RAW])
    pq.write_table(pa.Table.from_pylist(etas, schema=schema), f"{raw}/sirene-etablissement_2026.parquet")


def contract_document() -> dict:
    def party(kind, ident):
        return {"titulaire": {"typeIdentifiant": kind, "id": ident}}
    marches = [
        {"id": "M1", "acheteur": {"id": "01234567800011"}, "nature": "Marché", "objet": LONG_OBJET,
         "codeCPV": "45000000", "techniques": {"technique": ["Accord-cadre", None, "Concours"]},
         "modalitesExecution": {"modaliteExecution": []}, "offresRecues": 3, "tauxAvance": "0.05",
         "lieuExecution": {"typeCode": "Code commune", "code": "75056"}, "dureeMois": "12",
         "dateNotification": "2024-01-05", "datePublicationDonnees": "2024-02-01", "montant": "1500.5",
         "titulaires": [party("SIRET", "11111111100015"), party("TVA", "FR123"), party("SIRET", "99999999900000")]},
        {"id": "M2", "acheteur": {"id": "55555555500000"}, "nature": "Marché", "objet": "Simple",
         "offresRecues": "NC", "dateNotification": "2024-3-7", "datePublicationDonnees": "2024-03-08",
         "montant": 10, "titulaires": [party("SIRET", "01234567800029")]},
        {"id": "M3", "acheteur": {"id": "01234567800011"}, "objet": "Sans titulaire", "titulaires": []},
        {"id": "M4", "acheteur": {"id": "01234567800011"}, "objet": "Titulaires nuls", "titulaires": None},
    ]
    concessions = [
        {"id": "C1", "nature": "Concession", "objet": "Parking", "tauxAvance": "0", "dureeMois": "120",
         "datePublicationDonnees": "2024-05-01", "autoriteConcedante": {"id": "22222222200012"},
         "dateSignature": "2024-04-01", "dateDebutExecution": "2024-06-01", "valeurGlobale": "250000",
         "montantSubventionPublique": "1000",
         "concessionnaires": [{"concessionnaire": {"typeIdentifiant": "SIRET", "id": "33333333300019"}}]},
    ]
    return {"marches": {"marche": marches, "contrat-concession": concessions}}


def write_subsidies(raw: str) -> None:
    op = "unité patrimoniale concernée par l'op. fin."
    culture_h = ["Année", "Origine des crédits", "Détail origine des crédits", "CPER", "Montant engagé",
                 "Nom du bénéficiaire", "Région du bénéficiaire", "Département du bénéficiaire",
                 "EPCI du bénéficiaire", "Sous-types de communes du bénéficiaire", "Code postal du bénéficiaire",
                 "Code commune du bénéficiaire", "Commune du bénéficiaire", "N° SIREN du bénéficiaire",
                 "N° SIRET du bénéficiaire", "N° EJ", "Titre", "Mission", "Programme",
                 "Localisation interministérielle", "Fonctionnement/Investissement", "Domaine fonctionnel",
                 "Compte budgétaire", "Code activité", "Activité libellé long", "Activité libellé court",
                 "Centre financier", "Centre de coût"] + [f"{h} {op}" for h in
                 ["Appellation", "Région", "Département", "Code postal", "Code commune", "Commune"]]
    row = {h: "" for h in culture_h}
    row.update({"Année": "2024", "Origine des crédits": "DRAC", "Détail origine des crédits": "Corse",
                "Montant engagé": "1500.5", "Nom du bénéficiaire": "Théâtre", "N° SIRET du bénéficiaire": "11111111100015",
                "N° EJ": "EJ1", "Mission": "Culture", "Programme": "", "Activité libellé long": "Aide\nau spectacle",
                "Code commune du bénéficiaire": "2A004", f"Code commune {op}": "75056"})
    _csv(f"{raw}/culture-convention-subvention_2026.csv", culture_h, [[row[h] for h in culture_h]],
         sep=";", encoding="latin-1")
    agri_h = ["Nom attributaire*", "Identification de l'attributaire*", "Date de convention*",
              "Référence de la décision", "Identification du bénéficiaire*", "Nom du bénéficiaire*",
              "Objet de la convention", "Montant total de la subvention*", "Nature de la subvention*",
              "Conditions de versement*", "Date de versement", "Numéro de référencement au répertoire des entreprises",
              "Aide notifiée à l'Europe", "Pourcentage du montant de la subvention attribué au bénéficiaire*"]
    _csv(f"{raw}/agriculture-subvention_2026.csv", agri_h, [
        ["Ministère", "012 345 678 00011", "2024-01-15", "DEC 1", "111 111 111 00015", "Ferme œuvre €",
         "Objet agri", "1 234,56", "Aide", "Unique", "", "", "Non", "100"],
        ["Généré le 01/01/2026", "", "", "", "", "", "", "0", "", "", "", "", "", ""],
        [None, "x", "2024-01-16", "", "y", "z", "", "5", "", "", "", "", "", "1"]],
        sep=";", encoding="cp1252", preamble=["Export des subventions;;", "Ministère;;"])
    anct_a = ["Nom de l'attribuant", "Code département/Direction", "Libellé département/Direction",
              "Identification de l'attributaire", "Référence de la décision", "Identification du bénéficiaire",
              "Nom du bénéficiaire", "Objet de la subvention", "Montant total de la subvention",
              "Nature de la subvention", "Conditions de versement", "Date de versement", "RAE",
              "notificationUE", "PourcentageSubvention", "Date de la convention de subvention"]
    _csv(f"{raw}/anct-subvention-ville-2024_2026.csv", anct_a, [
        ["ANCT", "75", "Paris", "01234567800011", "R 1", "22222222200012", "Asso", "Objet €", "1234,56",
         "Aide", "", "2024/1/5", "", "Non", "50", "05/01/2024"],
        ["ANCT", "75", "Paris", "", "R 2", "x", "y", "z", "1", "", "", "", "", "", "", ""],
        ["ANCT", "75", "Paris", "01234567800011", "R 3", "bad", "n", "o", "2,5", "", "", "garbage", "", "", "", "2024/12/31"]],
        sep=";", encoding="cp1252")
    # reordered and partly renamed header in the other yearly file
    anct_b = ["Identification de l'attributaire", "Nom de l'attribuant", "Montant total de la subvention",
              "Identification du bénéficiaire", "Nom du bénéficiaire", "Date de versement"]
    _csv(f"{raw}/anct-subvention-ville-2023_2026.csv", anct_b, [
        ["01234567800011", "ANCT", "10,5", "11111111100015", "Club", "03/02/2023"]], sep=";", encoding="cp1252")
    # the 2019 file needs the line repair: a separator-only first line and tripled quotes
    with open(f"{raw}/anct-subvention-ville-2019_2026.csv", "w", encoding="cp1252", newline="") as fh:
        fh.write(";;;;;;\n")
        fh.write(";".join(anct_b) + "\n")
        fh.write('01234567800011;ANCT;"""7,5""";22222222200012;"""Ville de Paris""";01/02/2019\n')
    _csv(f"{raw}/ademe-aide-financiere_2026.csv",
         ["Nom de l attribuant", "idAttribuant", "dateConvention", "referenceDecision", "nomBeneficiaire",
          "idBeneficiaire", "objet", "dispositifAide", "montant", "nature", "conditionsVersement",
          "datesPeriodeVersement", "idRAE", "notificationUE"],
         [["ADEME", "38529030900454", "2024-02-01", "D1", "Benef", "01234567800011", "Iso", "Fonds", "1000.5",
           "aide", "", "", "", "Non"]])
    dot_h = ["exercice", "dispositif", "programme", "beneficiaire_type", "beneficiaire_siren", "beneficiaire_dep",
             "beneficiaire_nom", "beneficiaire_code_insee", "intitule", "cout_ht", "subvention", "taux"]
    _csv(f"{raw}/dotation-soutien-territoire-2024_2026.csv", dot_h, [
        ["2024", "DETR", "119", "commune", "012345678", "01", "Commune A", "01001", "École", "1000,5", "500,25", "0,5"],
        ["2024", "DETR", "119", "commune", "000000000", "01", "Commune B", "01002", "Sans", "1", "", "0"]], sep=";")
    _csv(f"{raw}/subvention-caisse-depots_2026.csv",
         ["nomAttribuant", "IdAttribuant", "DateConvention", "ReferenceDecision", "IdBeneficiaire",
          "NomBeneficiaire", "Objet", "Montant", "Nature", "ConditionsVersement", "DatesVersement_debut",
          "DatesVersement_fin", "IdRAE", "NotificationUE", "PourcentageSubvention"],
         [["CDC", "18002002600019", "2024-03", "R", "11111111100015", "B", "O", "300.0", "", "", "", "", "", "", "10"]])
    _csv(f"{raw}/idf-subvention-association_2026.csv",
         ["idAttribuant", "nomAttribuant", "anneeExercice", "dateConvention", "referenceDecision", "idDossier",
          "idBeneficiaire", "nomBeneficiaire", "objet", "montant", "datesPeriodeVersement", "delegation",
          "gestionFondsEuropeens", "pourcentageSubvention", "dispositifAide"],
         [["23750007900312", "IDF", "2024", "2024-04-02", "#N/A", "D1", "#N/A", "Asso", "#N/A", "42.0", "",
           "true", "false", "1.5", ""]])
    fv_a = ["nom_region", "code_departement", "nom_departement", "code_commune", "nom_commune", "axe",
            "numero_demarche_ds", "nom_demarche_ds", "numero_dossier_ds", "nom_du_projet",
            "nom_beneficiaire_principal", "siren", "montant_engage", "resume_du_projet", "numero_ej",
            "numero_operateur", "opérateur", "demarche", "siret_beneficiaire", "raison_sociale_beneficiaire",
            "forme juridique_beneficiaire"]
    _csv(f"{raw}/fonds-vert-subvention-2023_2026.csv", fv_a, [
        ["Corse", "2A", "Corse-du-Sud", "2A004", "Ajaccio", "a", "1", "d", "DS1", "Projet", "Ville",
         "012345678", "1000.0", "Résumé", "", "", "Op", "dem", "", "Ville", "Commune"]])
    fv_b = ["siren", "nom_region", "code_commune", "numero_dossier_ds", "nom_du_projet", "nom_beneficiaire_principal",
            "montant_engage", "resume_du_projet", "numero_ej", "operateur", "siret_beneficiaire",
            "forme_juridique_beneficiaire"]
    _csv(f"{raw}/fonds-vert-subvention-2024_2026.csv", fv_b, [
        ["111111111", "Corse", "2A004", "DS2", "P2", "B2", "2000.0", "R2", "EJ2", "Op2", "11111111100015", "SA"]])


def write_seeds(seeds: str) -> None:
    _csv(f"{seeds}/insee_sirene_cat_juridique.csv", ["code", "libelle", "type"], [
        ["0", "Organisme sans personnalité", "1"], ["00", "Organisme sans personnalité (2)", "2"],
        ["0000", "Organisme (4)", "3"], ["1", "Entrepreneur individuel", "1"], ["10", "Entrepreneur (2)", "2"],
        ["1000", "Entrepreneur individuel (3)", "3"], ["5", "Société commerciale", "1"],
        ["57", "SAS", "2"], ["5710", "SAS, société par actions simplifiée", "3"], ["9999", "Sans parent", "3"]])
    _csv(f"{seeds}/insee_sirene_naf.csv", ["code", "libelle", "niveau"], [
        ["62.01Z", "Programmation informatique", "sousclasse"], ["62.01", "Programmation", "classe"]])
    _csv(f"{seeds}/nom_activite_artisanat.csv", ["code", "libelle"], [["0162ZP", "Maréchalerie"]])
    _csv(f"{seeds}/ministere_culture_division.csv", ["type_division", "nom_division", "siret"], [
        ["DRAC", "Corse", "01234567800011"], ["DRAC", "Nouvelle-Calédonie", ""]])


def write_all(root: str, spark=None) -> tuple[str, str]:
    """Write every raw source and seed under ``root``."""
    raw, seeds = os.path.join(root, "raw"), os.path.join(root, "seeds")
    os.makedirs(raw, exist_ok=True)
    os.makedirs(seeds, exist_ok=True)
    write_geo(raw)
    write_sirene(raw)
    write_subsidies(raw)
    write_seeds(seeds)
    # the procurement document lands as JSON; the pipeline's preparation step splits it
    with open(os.path.join(raw, "commande-publique-france_2026.json"), "w", encoding="utf-8") as fh:
        json.dump(contract_document(), fh, ensure_ascii=False, indent=1)
    return raw, seeds
