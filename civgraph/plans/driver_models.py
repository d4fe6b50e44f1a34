"""Driver queries that run the pipeline's own silver and gold model functions
over bronze-shaped records that Spark derives row by row from the benchmark
tables (no grouping, so their size follows the tables):

* markets per line item (buyer = the order's customer; awardees = a
  SIRET-typed supplier and a VAT-typed part; line 4: empty list, line 5: NULL
  list) and concessions per order -> V07, V08, V19, E02-E05;
* the eight subsidy sources per line item / order -> V09-V16, V20;
* legal units per customer, legal categories from part codes, activity codes
  per nation -> V04, V05, V17;
* communes per customer and establishments per customer / supplier -> V01,
  V06, V18, E08-E10.

``scripts/pipeline_bench.py`` lands the same records as raw files and runs
the whole pipeline over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civgraph.operators import relational as R
from civgraph.plans import gold
from civgraph.plans import silver as S
from civgraph.plans.driver import CODE_WIDTHS, part_codes, table
from civgraph.sources.blocks import shared_table
from civgraph.sources.contracts import CONCESSION_SCHEMA, MARCHE_SCHEMA

_RELEASE = [T.StructField("release_year", T.StringType())]
BRONZE_MARCHE = T.StructType(MARCHE_SCHEMA.fields + _RELEASE)
BRONZE_CONCESSION = T.StructType(CONCESSION_SCHEMA.fields + _RELEASE)


def customer_siret(c) -> F.Column:
    return F.lpad(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), 14, "0")


def supplier_siret(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit("9"), F.lpad(c.cast("string"), 13, "0"))


def _party(wrapper: str, kind: F.Column | str, ident: F.Column) -> F.Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(F.struct(kind.alias("typeIdentifiant"), ident.alias("id")).alias(wrapper))


def bronze_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    both = F.array(_party("titulaire", "SIRET", supplier_siret("l_suppkey")),
                   _party("titulaire", "TVA", F.concat(F.lit("FR"), F.col("l_partkey").cast("string"))))
    awardees = (F.when(F.col("l_linenumber") == 4, F.slice(both, 1, 0))
                 .when(F.col("l_linenumber") == 5, F.lit(None))
                 .otherwise(both))
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return R.conform(j, BRONZE_MARCHE, {
        "id": F.concat(F.lit("M"), F.col("l_orderkey").cast("string"), F.lit("-"),
                       F.col("l_linenumber").cast("string")),
        "acheteur": F.struct(customer_siret("o_custkey").alias("id")),
        "objet": F.concat(F.lit("Ligne "), F.col("l_linenumber").cast("string")),
        "techniques": F.struct(F.array(F.lit("Accord-cadre"),
                                       F.when(F.col("l_linenumber") % 2 == 1, F.lit("Concours")),
                                       F.col("l_linestatus")).alias("technique")),
        "offresRecues": F.when(F.col("l_linenumber") % 3 == 0, F.lit("NC"))
                         .otherwise(F.col("l_linenumber").cast("string")),
        "dureeMois": (F.col("l_linenumber") * 3).cast("string"),
        "dateNotification": day, "datePublicationDonnees": day,
        "montant": F.col("l_extendedprice").cast("string"),
        "titulaires": awardees,
        "release_year": F.year("l_shipdate").cast("string")})


def bronze_concessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderkey") % 4 == 0, F.lit("TVA")).otherwise(F.lit("SIRET"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return R.conform(o, BRONZE_CONCESSION, {
        "id": F.concat(F.lit("C"), F.col("o_orderkey").cast("string")),
        "objet": F.col("o_orderpriority"),
        "dureeMois": (F.col("o_orderkey") % 120).cast("string"),
        "datePublicationDonnees": day, "dateSignature": day,
        "autoriteConcedante": F.struct(customer_siret("o_custkey").alias("id")),
        "valeurGlobale": F.col("o_totalprice").cast("string"),
        "concessionnaires": F.array(_party("concessionnaire", kind, supplier_siret("o_custkey"))),
        "release_year": F.year("o_orderdate").cast("string")})


def establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").filter(F.col("c_nationkey") < 15).select(
        customer_siret("c_custkey").alias("siret"))
    s = table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") < 15).select(
        supplier_siret("s_suppkey").alias("siret"))
    return c.unionByName(s)


def model_market_unnest(spark, sf_dir):
    """V07 over derived market records: struct access, list text, NC -> NULL,
    strict dates, recursive unnest of the awardee list with its count."""
    v07 = S.commande_publique_marche(bronze_markets(spark, sf_dir))
    return v07.select("id", "acheteur_siret", "titulaire_id", "titulaire_type_identifiant", "nb_titulaires",
                      "offre_recues", "montant", "date_notification", "techniques", "duree_mois", "release_year")


def contracts(spark, sf_dir):
    return (S.commande_publique_marche(bronze_markets(spark, sf_dir)),
            S.commande_publique_concession(bronze_concessions(spark, sf_dir)))


def model_contract_edges(spark, sf_dir):
    """V07 + V08 -> V19 -> E02-E05: every edge, the contract by its business id."""
    return gold.contract_endpoints(S.contract_union(*contracts(spark, sf_dir)), establishments(spark, sf_dir),
                                   "id_contrat")


def model_contract_union(spark, sf_dir):
    """V07 + V08 -> V19: all columns but the id.  The union is written before
    it gets keys, so that these are made by row hash and only hashes are shuffled."""
    return S.ent_commande_publique(*contracts(spark, sf_dir), by_hash=True, staged=shared_table).drop("id")


QUERIES = {
    "model_market_unnest": model_market_unnest,
    "model_contract_edges": model_contract_edges,
    "model_contract_union": model_contract_union,
}

_MARKETS_SQL = r"""WITH m AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, l_shipdate, l_linestatus, o_custkey FROM lineitem JOIN orders ON l_orderkey=o_orderkey),
b AS (SELECT *, CASE WHEN l_linenumber=4 THEN []::STRUCT(titulaire STRUCT(typeIdentifiant VARCHAR, id VARCHAR))[] WHEN l_linenumber=5 THEN NULL ELSE [{'titulaire': {'typeIdentifiant': 'SIRET', 'id': '9'||lpad(CAST(l_suppkey AS VARCHAR),13,'0')}}, {'titulaire': {'typeIdentifiant': 'TVA', 'id': 'FR'||CAST(l_partkey AS VARCHAR)}}] END AS tits FROM m)"""

ORACLE = {
    "model_market_unnest": _MARKETS_SQL + r"""
SELECT 'M'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) AS id, lpad(CAST(o_custkey AS VARCHAR),14,'0') AS acheteur_siret, u.t.titulaire.id AS titulaire_id, u.t.titulaire.typeIdentifiant AS titulaire_type_identifiant, list_count(tits) AS nb_titulaires, CAST(nullif(CASE WHEN l_linenumber%3=0 THEN 'NC' ELSE CAST(l_linenumber AS VARCHAR) END,'NC') AS INTEGER) AS offre_recues, CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS montant, CAST(strptime(strftime(l_shipdate,'%Y-%m-%d'),'%Y-%m-%d') AS DATE) AS date_notification, array_to_string(['Accord-cadre', CASE WHEN l_linenumber%2=1 THEN 'Concours' END, l_linestatus], ', ') AS techniques, l_linenumber*3 AS duree_mois, CAST(year(l_shipdate) AS VARCHAR) AS release_year FROM b, unnest(b.tits) AS u(t)""",
    "model_contract_edges": _MARKETS_SQL + r""",
eta AS (SELECT lpad(CAST(c_custkey AS VARCHAR),14,'0') AS siret FROM customer WHERE c_nationkey<15 UNION ALL SELECT '9'||lpad(CAST(s_suppkey AS VARCHAR),13,'0') FROM supplier WHERE s_nationkey<15),
mu AS (SELECT 'M'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) AS id, lpad(CAST(o_custkey AS VARCHAR),14,'0') AS buyer, u.t.titulaire.typeIdentifiant AS typ, u.t.titulaire.id AS tit FROM b, unnest(b.tits) AS u(t)),
c AS (SELECT 'C'||CAST(o_orderkey AS VARCHAR) AS id, lpad(CAST(o_custkey AS VARCHAR),14,'0') AS grantor, CASE WHEN o_orderkey%4=0 THEN 'TVA' ELSE 'SIRET' END AS typ, '9'||lpad(CAST(o_custkey AS VARCHAR),13,'0') AS tit FROM orders)
SELECT 'has_publique_marche' AS relationship, buyer AS siret, id AS contract FROM mu WHERE buyer IN (SELECT siret FROM eta)
UNION ALL SELECT 'has_publique_concession', grantor, id FROM c WHERE grantor IN (SELECT siret FROM eta)
UNION ALL SELECT 'gives_publique_marche', tit, id FROM mu WHERE typ='SIRET' AND tit IN (SELECT siret FROM eta)
UNION ALL SELECT 'gives_publique_concession', tit, id FROM c WHERE typ='SIRET' AND tit IN (SELECT siret FROM eta)""",
    "model_contract_union": _MARKETS_SQL + r"""
SELECT 'M'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) AS id_contrat, 'marche' AS type_contrat, lpad(CAST(o_custkey AS VARCHAR),14,'0') AS siret_autorite, u.t.titulaire.id AS id_titulaire, u.t.titulaire.typeIdentifiant AS type_identifiant_titulaire, CAST(NULL AS VARCHAR) AS nature, 'Ligne '||CAST(l_linenumber AS VARCHAR) AS objet, CAST(NULL AS VARCHAR) AS procedure, CAST(l_linenumber*3 AS INTEGER) AS duree_mois, l_extendedprice AS montant, CAST(NULL AS DOUBLE) AS taux_avance, CAST(l_shipdate AS DATE) AS date_contrat, CAST(l_shipdate AS DATE) AS date_publication, CAST(NULL AS DATE) AS date_debut_execution, CAST(NULL AS VARCHAR) AS origine_ue, CAST(NULL AS VARCHAR) AS origine_france, CAST(NULL AS VARCHAR) AS considerations_sociales, CAST(NULL AS VARCHAR) AS considerations_environnementales, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS VARCHAR) AS code_lieu_execution, CAST(NULL AS VARCHAR) AS type_lieu_execution, CASE WHEN l_linenumber%3=0 THEN NULL ELSE l_linenumber END AS nombre_offres, CAST(NULL AS VARCHAR) AS type_prix, CAST(NULL AS VARCHAR) AS structure_prix, CAST(NULL AS DOUBLE) AS montant_subvention_publique FROM b, unnest(b.tits) AS u(t)
UNION ALL SELECT 'C'||CAST(o_orderkey AS VARCHAR), 'concession', lpad(CAST(o_custkey AS VARCHAR),14,'0'), '9'||lpad(CAST(o_custkey AS VARCHAR),13,'0'), CASE WHEN o_orderkey%4=0 THEN 'TVA' ELSE 'SIRET' END, NULL, o_orderpriority, NULL, CAST(o_orderkey%120 AS INTEGER), o_totalprice, NULL, CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders""",
}


# ---------------------------------------------------------------- subsidies
# Raw columns that the derived records leave NULL.
NULL_COLUMNS = {
    "culture": [*S.CULTURE_COLUMNS, *(head + S.CULTURE_OP_SUFFIX.format(q="'") for head in S.CULTURE_OP_COLUMNS)],
    "agriculture": ["Nature de la subvention*", "Conditions de versement*", "Date de versement",
                    "Numéro de référencement au répertoire des entreprises", "Aide notifiée à l'Europe",
                    "Pourcentage du montant de la subvention attribué au bénéficiaire*"],
    "anct": ["Code département/Direction", "Libellé département/Direction", "Nature de la subvention",
             "Conditions de versement", "RAE", "notificationUE", "PourcentageSubvention"],
    "ademe": ["dispositifAide", "nature", "conditionsVersement", "datesPeriodeVersement", "idRAE", "notificationUE"],
    "caisse": ["Nature", "ConditionsVersement", "DatesVersement_debut", "DatesVersement_fin", "IdRAE",
               "NotificationUE", "PourcentageSubvention"],
    "idf": ["anneeExercice", "idDossier", "datesPeriodeVersement", "delegation", "gestionFondsEuropeens",
            "pourcentageSubvention", "dispositifAide"],
    "fonds_vert": ["nom_region", "code_departement", "nom_departement", "nom_commune", "numero_operateur", "demarche",
                   "raison_sociale_beneficiaire", "forme juridique_beneficiaire"],
    "dotation": ["programme", "beneficiaire_type", "beneficiaire_dep", "cout_ht", "taux"],
    "communes": [c.upper() for c in S.COMMUNE_COLUMNS],
}


def complete(df: DataFrame, source: str) -> DataFrame:
    """``df`` with the raw columns of its source that it lacks, as NULL text."""
    there = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in NULL_COLUMNS[source] if c.lower() not in there])


# One subsidy per line item, the source chosen by the line number (1..7), and
# one territorial grant per order.  Release '2025' for every tenth order, so
# the newest-release filter has something to drop.
def _release(key: str, modulo: int = 10) -> F.Column:
    return F.when(F.col(key) % modulo == 0, F.lit("2025")).otherwise(F.lit("2026"))


def _commune(c) -> F.Column:
    return F.lpad(c.cast("string"), 19, "0")


def _ref(prefix: str = "R") -> F.Column:
    return F.concat(F.lit(prefix), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


# The raw headers of the eight sources, in the records below.
def bronze_subsidies(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    l2 = li.join(o.select("o_orderkey", "o_custkey"), li["l_orderkey"] == o["o_orderkey"], "inner")
    line = lambda k: l2.filter(F.col("l_linenumber") == k)
    benef = customer_siret("o_custkey")
    payer = supplier_siret("l_suppkey")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    price = F.col("l_extendedprice").cast("string")
    op = "unité patrimoniale concernée par l'op. fin."
    orderkey = F.col("l_orderkey")
    out = {
        "culture": line(1).select(
            F.year("l_shipdate").cast("string").alias("Année"), F.lit("DRAC").alias("Origine des crédits"),
            F.when(orderkey % 3 == 0, "ALGERIA").when(orderkey % 3 == 1, "BRAZIL").otherwise("NOWHERE")
             .alias("Détail origine des crédits"),
            price.alias("Montant engagé"), F.lit("Benef").alias("Nom du bénéficiaire"),
            benef.alias("N° SIRET du bénéficiaire"), _ref("EJ").alias("N° EJ"), F.lit("Culture").alias("Mission"),
            F.when(orderkey % 2 == 1, F.col("l_linestatus")).alias("Programme"),
            F.concat(F.lit("Activité "), F.col("l_returnflag")).alias("Activité libellé long"),
            _commune(F.col("o_custkey")).alias("Code commune du bénéficiaire"),
            F.when(orderkey % 4 == 0, _commune(F.col("l_suppkey"))).alias(f"Code commune {op}"),
            _release("l_orderkey").alias("release_year")),
        "agriculture": line(2).select(
            F.when(orderkey % 50 == 0, "Généré le 01/01/2026").when(orderkey % 51 == 0, F.lit(None))
             .otherwise("Ministère").alias("Nom attributaire*"),
            F.concat(F.substring(payer, 1, 3), F.lit(" "), F.substring(payer, 4, 11))
             .alias("Identification de l'attributaire*"),
            day.alias("Date de convention*"), _ref("D ").alias("Référence de la décision"),
            benef.alias("Identification du bénéficiaire*"), F.lit("Ferme").alias("Nom du bénéficiaire*"),
            F.lit("Objet").alias("Objet de la convention"),
            F.concat(((orderkey % 100000 + 1000) / 1000).cast("int").cast("string"), F.lit(" "),
                     F.lpad(((orderkey % 100000 + 1000) % 1000).cast("string"), 3, "0"))
             .alias("Montant total de la subvention*"),
            _release("l_orderkey").alias("release_year")),
        "anct": line(3).select(
            F.lit("ANCT").alias("Nom de l'attribuant"),
            F.when(orderkey % 20 != 0, payer).alias("Identification de l'attributaire"),
            _ref("R ").alias("Référence de la décision"), benef.alias("Identification du bénéficiaire"),
            F.lit("Asso").alias("Nom du bénéficiaire"), F.lit("Objet").alias("Objet de la subvention"),
            F.replace(price, F.lit("."), F.lit(",")).alias("Montant total de la subvention"),
            F.when(orderkey % 3 == 0, "garbage").when(orderkey % 3 == 1, F.date_format("l_shipdate", "yyyy/M/d"))
             .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("Date de versement"),
            F.date_format("l_shipdate", "d/M/yyyy").alias("Date de la convention de subvention"),
            _release("l_orderkey").alias("release_year")),
        "ademe": line(4).select(
            F.lit("ADEME").alias("Nom de l attribuant"), payer.alias("idAttribuant"), day.alias("dateConvention"),
            _ref().alias("referenceDecision"), F.lit("B").alias("nomBeneficiaire"), benef.alias("idBeneficiaire"),
            F.lit("Objet").alias("objet"), price.alias("montant"), _release("l_orderkey").alias("release_year")),
        "caisse": line(5).select(
            F.lit("CDC").alias("nomAttribuant"), payer.alias("IdAttribuant"),
            F.date_format("l_shipdate", "yyyy-MM").alias("DateConvention"), _ref().alias("ReferenceDecision"),
            benef.alias("IdBeneficiaire"), F.lit("B").alias("NomBeneficiaire"), F.lit("Objet").alias("Objet"),
            price.alias("Montant"), _release("l_orderkey").alias("release_year")),
        "idf": line(6).select(
            payer.alias("idAttribuant"), F.lit("IDF").alias("nomAttribuant"), day.alias("dateConvention"),
            F.when(orderkey % 3 == 0, "#N/A").otherwise(_ref()).alias("referenceDecision"),
            F.when(orderkey % 5 == 0, "#N/A").otherwise(benef).alias("idBeneficiaire"),
            F.lit("B").alias("nomBeneficiaire"), F.when(orderkey % 7 == 0, "#N/A").otherwise("Objet").alias("objet"),
            price.alias("montant"), _release("l_orderkey").alias("release_year")),
        "fonds_vert": line(7).select(
            _commune(F.col("o_custkey")).alias("code_commune"), F.concat(F.lit("DS"), _ref("")).alias("numero_dossier_ds"),
            F.lit("Projet").alias("nom_du_projet"), F.lit("Ville").alias("nom_beneficiaire_principal"),
            F.lpad(F.col("o_custkey").cast("string"), 19, "0").alias("siren"), price.alias("montant_engage"),
            F.lit("Résumé").alias("resume_du_projet"), F.when(orderkey % 2 == 1, _ref("EJ")).alias("numero_ej"),
            F.lit("Op").alias("opérateur"), F.when(orderkey % 3 != 0, benef).alias("siret_beneficiaire"),
            F.year("l_shipdate").cast("string").alias("exercice"), _release("l_orderkey").alias("release_year")),
        "dotation": o.select(
            F.year("o_orderdate").cast("string").alias("exercice"), F.lit("DETR").alias("dispositif"),
            F.lpad(F.col("o_custkey").cast("string"), 19, "0").alias("beneficiaire_siren"),
            F.lit("Commune").alias("beneficiaire_nom"), _commune(F.col("o_custkey")).alias("beneficiaire_code_insee"),
            F.col("o_orderpriority").alias("intitule"),
            F.when(F.col("o_orderkey") % 10 != 0,
                   F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(","))).alias("subvention"),
            _release("o_orderkey", 7).alias("release_year")),
    }
    return {name: complete(df, name) for name, df in out.items()}


#: The line number whose records make up each source; None: the orders.
SUBSIDY_LINES = {"culture": 1, "agriculture": 2, "anct": 3, "ademe": 4, "caisse": 5, "idf": 6, "fonds_vert": 7, "dotation": None}


def newest_subsidies(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The records of every source's newest release.  The releases, which
    files tell by their names, are columns here: one grouped pass finds the newest of
    all sources (one row each), and the sources keep the rows that match it."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    lines = li.join(o.select("o_orderkey"), li["l_orderkey"] == o["o_orderkey"], "left_semi").groupBy(
        F.col("l_linenumber").alias("line")).agg(F.max(_release("l_orderkey")).alias("newest"))
    newest = lines.unionByName(o.groupBy(F.lit(None).cast("int").alias("line")).agg(
        F.max(_release("o_orderkey", 7)).alias("newest")))
    frames = bronze_subsidies(spark, sf_dir)
    return {name: df.join(F.broadcast(newest.where(F.col("line").eqNullSafe(F.lit(SUBSIDY_LINES[name])))), F.col("release_year")
                          == F.col("newest"), "left_semi") for name, df in frames.items()}


def subsidy_reference(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Culture divisions (one per nation, a bounded list) and establishments:
    one per customer, head office unless the key is a multiple of 4."""
    n = table(spark, sf_dir, "nation")
    divisions = n.select(F.lit("DRAC").alias("type_division"), F.col("n_name").alias("nom_division"),
                         customer_siret(F.col("n_nationkey") + 1).alias("siret"))
    c = table(spark, sf_dir, "customer")
    eta = c.select(F.lpad(F.col("c_custkey").cast("string"), 19, "0").alias("siren"),
                   customer_siret("c_custkey").alias("siret"),
                   (F.col("c_custkey") % 4 != 0).alias("etablissement_siege"))
    return divisions, eta


def model_subsidy_union(spark, sf_dir):
    """Eight subsidy sources cleaned and conformed into one
    shape, written before it gets keys by row hash."""
    b = newest_subsidies(spark, sf_dir)
    divisions, eta = subsidy_reference(spark, sf_dir)
    kw = {"prune_files": None}  # of one release already
    v20 = S.ent_subvention_publique(
        S.subvention_ministere_culture(b["culture"], **kw), divisions,
        S.subvention_ministere_agriculture(b["agriculture"], **kw), S.subvention_anct_ville(b["anct"], **kw),
        S.subvention_ademe(b["ademe"], **kw), S.dotation_soutien_territoire(b["dotation"], **kw),
        S.subvention_caisse_depots(b["caisse"], **kw), S.idf_subvention_association(b["idf"], **kw),
        S.fonds_vert_subvention(b["fonds_vert"], eta, **kw), eta, by_hash=True, staged=shared_table)
    return v20.drop("id")


QUERIES["model_subsidy_union"] = model_subsidy_union

ORACLE["model_subsidy_union"] = r"""WITH l2 AS (SELECT l.*, o_custkey, lpad(CAST(o_custkey AS VARCHAR),14,'0') AS benef, '9'||lpad(CAST(l_suppkey AS VARCHAR),13,'0') AS payer, lpad(CAST(o_custkey AS VARCHAR),19,'0') AS commune FROM lineitem l JOIN orders ON l_orderkey=o_orderkey WHERE l_orderkey % 10 <> 0),
eta AS (SELECT lpad(CAST(c_custkey AS VARCHAR),19,'0') AS siren, lpad(CAST(c_custkey AS VARCHAR),14,'0') AS siret FROM customer WHERE c_custkey % 4 <> 0),
div AS (SELECT 'DRAC' AS type_division, n_name AS nom_division, lpad(CAST(n_nationkey+1 AS VARCHAR),14,'0') AS siret FROM nation),
culture AS (SELECT make_date(year(l_shipdate),1,1) AS date_subvention, coalesce(CASE WHEN l_orderkey%4=0 THEN lpad(CAST(l_suppkey AS VARCHAR),19,'0') END, commune) AS code_commune, concat('Culture',' - ',CASE WHEN l_orderkey%2=1 THEN l_linestatus END) AS nom_projet, 'Activité '||l_returnflag AS description_projet, 'EJ'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) AS reference_decision, 'Benef' AS nom_beneficiaire, benef AS siret_beneficiaire, div.siret AS siret_crediteur, CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS montant, 'culture' AS domaine, 'Ministère de la culture' AS origine_data FROM l2 LEFT JOIN div ON div.type_division='DRAC' AND div.nom_division = CASE WHEN l_orderkey%3=0 THEN 'ALGERIA' WHEN l_orderkey%3=1 THEN 'BRAZIL' ELSE 'NOWHERE' END WHERE l_linenumber=1),
agri AS (SELECT CAST(l_shipdate AS DATE), NULL, NULL, 'Objet', 'D'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR), 'Ferme', benef, payer, CAST(l_orderkey % 100000 + 1000 AS DOUBLE), 'agriculture', 'Ministère de l''agriculture' FROM l2 WHERE l_linenumber=2 AND l_orderkey%50<>0 AND l_orderkey%51<>0),
anct AS (SELECT CAST(l_shipdate AS DATE), NULL, NULL, 'Objet', 'R'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR), 'Asso', benef, payer, l_extendedprice, 'territoires', 'Agence nationale de la cohésion des territoires' FROM l2 WHERE l_linenumber=3 AND l_orderkey%20<>0),
ademe AS (SELECT CAST(l_shipdate AS DATE), NULL, NULL, 'Objet', 'R'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR), 'B', benef, payer, l_extendedprice, 'environnement', 'Agence de l''environnement et de la maîtrise de l''énergie' FROM l2 WHERE l_linenumber=4),
dot AS (SELECT make_date(year(o_orderdate),1,1), lpad(CAST(o_custkey AS VARCHAR),19,'0'), o_orderpriority, o_orderpriority, NULL, 'Commune', eta.siret, NULL, o_totalprice, 'territoires', 'Direction générale des collectivités territoriales' FROM orders LEFT JOIN eta ON lpad(CAST(o_custkey AS VARCHAR),19,'0')=eta.siren WHERE o_orderkey % 7 <> 0 AND o_orderkey % 10 <> 0),
caisse AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE), NULL, NULL, 'Objet', 'R'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR), 'B', benef, payer, l_extendedprice, 'developpement', 'Caisse des Dépôts' FROM l2 WHERE l_linenumber=5),
idf AS (SELECT CAST(l_shipdate AS DATE), NULL, NULL, CASE WHEN l_orderkey%7=0 THEN NULL ELSE 'Objet' END, CASE WHEN l_orderkey%3=0 THEN NULL ELSE 'R'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) END, 'B', CASE WHEN l_orderkey%5=0 THEN NULL ELSE benef END, payer, l_extendedprice, 'association', 'Région Île-de-France' FROM l2 WHERE l_linenumber=6),
fv AS (SELECT make_date(year(l_shipdate),1,1), commune, 'Projet', 'Résumé', coalesce(CASE WHEN l_orderkey%2=1 THEN 'EJ'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) END, 'DS'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR)), 'Ville', coalesce(CASE WHEN l_orderkey%3<>0 THEN benef END, eta.siret), '11006801200050', l_extendedprice, 'environnement', 'Ministère de la Transition écologique' FROM l2 LEFT JOIN eta ON lpad(CAST(o_custkey AS VARCHAR),19,'0')=eta.siren WHERE l_linenumber=7)
SELECT * FROM culture UNION ALL SELECT * FROM agri UNION ALL SELECT * FROM anct UNION ALL SELECT * FROM ademe UNION ALL SELECT * FROM dot UNION ALL SELECT * FROM caisse UNION ALL SELECT * FROM idf UNION ALL SELECT * FROM fv"""


# ---------------------------------------------------------------- registry and geography
def _raw_frame(df: DataFrame, raw_columns: list[str], values: dict) -> DataFrame:
    """A raw registry record: every contract column, NULL unless given."""
    return df.select(*[(values[c] if c in values else F.lit(None).cast("string")).alias(c) for c in raw_columns],
                     values["release_year"].alias("release_year"))


def bronze_legal_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return _raw_frame(c, S.UNITE_LEGALE_RAW, {
        "siren": F.lpad(key.cast("string"), 19, "0"),
        "denominationUniteLegale": F.when(key % 7 == 0, F.lit("[ND]")).otherwise(F.col("c_name")),
        "prenomUsuelUniteLegale": F.when(key % 3 == 0, F.lit("[ND]")).otherwise(F.lit("Jean")),
        "nomUniteLegale": F.col("c_mktsegment"),
        "categorieJuridiqueUniteLegale": F.lpad(key.cast("string"), CODE_WIDTHS[0], "0"),
        "activitePrincipaleUniteLegale": F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
        "release_year": _release("c_custkey")})


def model_legal_units(spark, sf_dir):
    """V04 + V05 + V17: legal units with display name, activity label (codes
    of even nations are sub-classes) and the three legal-category levels."""
    codes = part_codes(spark, sf_dir)
    naf = table(spark, sf_dir, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"),
        F.concat(F.lit("NAF "), F.col("n_name")).alias("libelle"),
        F.when(F.col("n_nationkey") % 2 == 0, "sousclasse").otherwise("classe").alias("niveau"))
    ul = S.sirene_unite_legale(bronze_legal_units(spark, sf_dir), prune_files=False)
    categories = S.categorie_juridique(codes, bounded=False, widths=CODE_WIDTHS)
    v17 = S.ent_sirene_unite_legale(ul, naf, categories, bounded=False)
    return v17.select("siren", "denomination_unite_legale", "activite_principale_unite_legale_libelle",
                      "categorie_juridique_unite_legale_libelle_iii", "categorie_juridique_unite_legale_libelle_ii",
                      "categorie_juridique_unite_legale_libelle_i", "release_year")


def _commune_code(k) -> F.Column:
    return F.lpad(k.cast("string"), 19, "0")


def bronze_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One commune row per customer, typed by key (COM, COMD, COMA, ARM).
    A delegated commune reuses the code of the commune before it, so one code
    is listed under two types; codes are unique within a type."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    kind = (F.when(key % 10 == 1, "COMD").when(key % 10 == 2, "ARM")
             .when(key % 10 == 3, "COMA").otherwise("COM"))
    return complete(c.select(kind.alias("TYPECOM"),
                    _commune_code(F.when(key % 10 == 1, key - 1).otherwise(key)).alias("COM"),
                    F.col("c_nationkey").cast("string").alias("REG"),
                    F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("DEP"),
                    F.col("c_name").alias("LIBELLE"),
                    F.when(kind != "COM", _commune_code(key - key % 10)).alias("COMPARENT"),
                    _release("c_custkey", 9).alias("release_year")), "communes")


def bronze_establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One head-office establishment per customer, one secondary per supplier;
    some commune codes missing or masked."""
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    eta_c = _raw_frame(c, S.ETABLISSEMENT_RAW, {
        "siren": F.lpad(F.col("c_custkey").cast("string"), 19, "0"), "siret": customer_siret("c_custkey"),
        "nic": F.lit("00011"), "etablissementSiege": F.lit("true"),
        "codeCommuneEtablissement": F.when(F.col("c_custkey") % 6 != 0,
                                           _commune_code(F.col("c_custkey"))),
        "release_year": F.lit("2026")})
    eta_s = _raw_frame(s, S.ETABLISSEMENT_RAW, {
        "siren": F.concat(F.lit("9"), F.lpad(F.col("s_suppkey").cast("string"), 19, "0")),
        "siret": supplier_siret("s_suppkey"), "nic": F.lit("00029"), "etablissementSiege": F.lit("false"),
        "codeCommuneEtablissement": F.when(F.col("s_suppkey") % 5 == 0, F.lit("[ND]"))
                                     .otherwise(_commune_code(F.col("s_suppkey"))),
        "release_year": F.lit("2026")})
    return eta_c.unionByName(eta_s)


def model_located_in(spark, sf_dir):
    """V01 + V06 + V18 -> E08-E10: every edge from an establishment to a
    commune, delegated commune or district; a code listed under two types
    gives two edges."""
    communes = S.france_communes(bronze_communes(spark, sf_dir), prune_files=False)
    artisanat = table(spark, sf_dir, "nation").select(F.col("n_name").alias("code"), F.col("n_name").alias("libelle"))
    eta = S.ent_sirene_etablissement(S.sirene_etablissement(bronze_establishments(spark, sf_dir),
                                                            prune_files=False), artisanat)
    return gold.located_in_edges(eta, communes)


QUERIES["model_legal_units"] = model_legal_units
QUERIES["model_located_in"] = model_located_in

ORACLE["model_legal_units"] = r"""WITH ul AS (SELECT lpad(CAST(c_custkey AS VARCHAR),19,'0') AS siren, CASE WHEN c_custkey%7=0 THEN '[ND]' ELSE c_name END AS denom, CASE WHEN c_custkey%3=0 THEN '[ND]' ELSE 'Jean' END AS prenom, c_mktsegment AS nom, lpad(CAST(c_custkey AS VARCHAR),19,'0') AS cat, lpad(CAST(c_nationkey AS VARCHAR),2,'0') AS naf FROM customer WHERE c_custkey%10<>0),
p AS (SELECT lpad(CAST(p_partkey AS VARCHAR),19,'0') AS code, p_name AS libelle, p_partkey FROM part),
catj AS (SELECT a.code AS code_iii, a.libelle AS libelle_iii, b.libelle AS libelle_ii, c.libelle AS libelle_i FROM p a LEFT JOIN (SELECT left(code,18) AS code, libelle FROM p WHERE p_partkey%10=0) b ON b.code=left(a.code,18) LEFT JOIN (SELECT left(code,17) AS code, libelle FROM p WHERE p_partkey%100=0) c ON c.code=left(b.code,17)),
naf AS (SELECT lpad(CAST(n_nationkey AS VARCHAR),2,'0') AS code, 'NAF '||n_name AS libelle FROM nation WHERE n_nationkey%2=0)
SELECT siren, coalesce(nullif(denom,'[ND]'), nullif(trim(concat(coalesce(nullif(prenom,'[ND]'),''),' ',coalesce(nullif(nom,'[ND]'),''))),'')) AS denomination_unite_legale, naf.libelle AS activite_principale_unite_legale_libelle, catj.libelle_iii AS categorie_juridique_unite_legale_libelle_iii, catj.libelle_ii AS categorie_juridique_unite_legale_libelle_ii, catj.libelle_i AS categorie_juridique_unite_legale_libelle_i, '2026' AS release_year FROM ul LEFT JOIN naf ON ul.naf=naf.code LEFT JOIN catj ON ul.cat=catj.code_iii"""

ORACLE["model_located_in"] = r"""WITH com AS (SELECT CASE c_custkey%10 WHEN 1 THEN 'COMD' WHEN 2 THEN 'ARM' WHEN 3 THEN 'COMA' ELSE 'COM' END AS type_commune, lpad(CAST(CASE WHEN c_custkey%10=1 THEN c_custkey-1 ELSE c_custkey END AS VARCHAR),19,'0') AS code_commune FROM customer WHERE c_custkey%9<>0),
eta AS (SELECT lpad(CAST(c_custkey AS VARCHAR),14,'0') AS siret, CASE WHEN c_custkey%6<>0 THEN lpad(CAST(c_custkey AS VARCHAR),19,'0') END AS code FROM customer UNION ALL SELECT '9'||lpad(CAST(s_suppkey AS VARCHAR),13,'0'), CASE WHEN s_suppkey%5=0 THEN NULL ELSE lpad(CAST(s_suppkey AS VARCHAR),19,'0') END FROM supplier)
SELECT CASE type_commune WHEN 'COM' THEN 'etablissement_located_in_commune' WHEN 'ARM' THEN 'etablissement_located_in_arrondissement' ELSE 'etablissement_located_in_commune_deleguee' END AS relationship, siret, code_commune AS commune FROM eta JOIN com ON eta.code=com.code_commune"""


# ---------------------------------------------------------------- the graph as build_all writes it
def bronze_departements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One department per nation in two releases, the older one with fewer."""
    n = table(spark, sf_dir, "nation")
    code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    new = n.select(code.alias("DEP"), F.col("n_regionkey").cast("string").alias("REG"), F.concat(code, F.lit("001")).alias("CHEFLIEU"),
                   (F.col("n_nationkey") % 6).cast("string").alias("TNCC"), F.col("n_name").alias("NCC"),
                   F.initcap("n_name").alias("NCCENR"), F.concat(F.lit("Dép. "), F.col("n_name")).alias("LIBELLE"))
    old = new.where("DEP < '20'").withColumn("LIBELLE", F.lit("old"))
    return new.withColumn("release_year", F.lit("2026")).unionByName(old.withColumn("release_year", F.lit("2025")))


def bronze_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    key = F.col("r_regionkey").cast("string")
    return r.select(key.alias("reg"), F.concat(key, F.lit("001")).alias("Cheflieu"), F.lit("1").alias("TNCC"),
                    F.col("r_name").alias("NCC"), F.initcap("r_name").alias("NCCENR"), F.col("r_name").alias("libelle"),
                    F.lit("2026").alias("release_year"))


def model_geography(spark, sf_dir):
    """Every column of the three code lists, newest release."""
    frames = {"commune": S.france_communes(bronze_communes(spark, sf_dir), prune_files=False),
              "departement": S.france_departements(bronze_departements(spark, sf_dir), prune_files=False),
              "region": S.france_regions(bronze_regions(spark, sf_dir), prune_files=False)}
    return R.union_by_name([df.withColumn("level", F.lit(k)) for k, df in frames.items()])


def silver_establishments(spark, sf_dir):
    artisanat = table(spark, sf_dir, "nation").select(F.col("n_name").alias("code"), F.col("n_name").alias("libelle"))
    return S.ent_sirene_etablissement(S.sirene_etablissement(bronze_establishments(spark, sf_dir), prune_files=False), artisanat)


def model_establishments(spark, sf_dir):
    """Every column."""
    return silver_establishments(spark, sf_dir)


def graph_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The silver tables that gold reads.  Contracts and subsidies carry their
    business id, which SQL can name, in place of the surrogate key."""
    return {
        "ent_sirene_unite_legale": S.sirene_unite_legale(bronze_legal_units(spark, sf_dir), prune_files=False),
        "ent_sirene_etablissement": silver_establishments(spark, sf_dir),
        "ent_commande_publique": S.contract_union(*contracts(spark, sf_dir)).withColumn("id", F.col("id_contrat")),
        "ent_subvention_publique": model_subsidy_union(spark, sf_dir).withColumn(
            "id", F.concat_ws(":", "domaine", "reference_decision", "code_commune")),
        "france_communes": S.france_communes(bronze_communes(spark, sf_dir), prune_files=False),
        "france_departements": S.france_departements(bronze_departements(spark, sf_dir), prune_files=False),
        "france_regions": S.france_regions(bronze_regions(spark, sf_dir), prune_files=False),
    }


def model_graph_nodes(spark, sf_dir):
    """N01-N10 through ``gold.nodes``: every node file, its label, id and
    properties by name, with the header's id space and types."""
    frames = []
    for label, df in gold.nodes(graph_tables(spark, sf_dir)).items():
        header = next(c for c in df.columns if ":ID(" in c)
        frames.append(df.select(F.lit(label).alias("label"), F.lit(header).alias("header"), F.col(f"`{header}`").alias("id"), *[
            F.col(f"`{c}`").alias(c.split(":")[0]) for c in df.columns if c != header]))
    return R.union_by_name(frames)


def model_graph_relationships(spark, sf_dir):
    """E01-E14 through ``gold.relationships``: every edge with its type and
    the id spaces of its ends.  The stacked frames are written by relationship,
    as ``build_all`` does: each type reads its part instead of joining again."""
    frames = []
    for name, df in gold.relationships(graph_tables(spark, sf_dir), lambda df: shared_table(df, "relationship")).items():
        start, end = df.columns
        frames.append(df.select(F.lit(name).alias("relationship"), F.lit(f"{start} {end}").alias("header"),
                                F.col(f"`{start}`").alias("start"), F.col(f"`{end}`").alias("end")))
    return R.union_by_name(frames)


QUERIES |= {f.__name__: f for f in (model_geography, model_establishments, model_graph_nodes, model_graph_relationships)}

_COMMUNE_SQL = r"""com AS (SELECT CASE c_custkey%10 WHEN 1 THEN 'COMD' WHEN 2 THEN 'ARM' WHEN 3 THEN 'COMA' ELSE 'COM' END AS type_commune, lpad(CAST(CASE WHEN c_custkey%10=1 THEN c_custkey-1 ELSE c_custkey END AS VARCHAR),19,'0') AS code_commune, CAST(c_nationkey AS VARCHAR) AS code_reg, lpad(CAST(c_nationkey AS VARCHAR),2,'0') AS code_dep, c_name AS name_commune, CASE WHEN c_custkey%10 IN (1,2,3) THEN lpad(CAST(c_custkey-c_custkey%10 AS VARCHAR),19,'0') END AS parent_code_commune FROM customer WHERE c_custkey%9<>0)"""
_ETA_SQL = r"""eta AS (SELECT lpad(CAST(c_custkey AS VARCHAR),19,'0') AS siren, '00011' AS nic, lpad(CAST(c_custkey AS VARCHAR),14,'0') AS siret, 'true' AS siege, CASE WHEN c_custkey%6<>0 THEN lpad(CAST(c_custkey AS VARCHAR),19,'0') END AS commune FROM customer UNION ALL SELECT '9'||lpad(CAST(s_suppkey AS VARCHAR),19,'0'), '00029', '9'||lpad(CAST(s_suppkey AS VARCHAR),13,'0'), 'false', CASE WHEN s_suppkey%5<>0 THEN lpad(CAST(s_suppkey AS VARCHAR),19,'0') END FROM supplier)"""
_GEO = {  # level -> column -> SQL
    "commune": {c: c for c in ("type_commune", "code_commune", "code_reg", "code_dep", "name_commune", "parent_code_commune")},
    "departement": {"code_dep": "lpad(CAST(n_nationkey AS VARCHAR),2,'0')", "code_reg": "CAST(n_regionkey AS VARCHAR)",
                    "code_commune_prefecture": "lpad(CAST(n_nationkey AS VARCHAR),2,'0')||'001'",
                    "type_name_format": "CAST(n_nationkey%6 AS VARCHAR)", "name_dep_uppercase": "n_name",
                    "name_dep_typo_enriched": "array_to_string(list_transform(string_split(lower(n_name),' '), lambda w: upper(w[1])||w[2:]),' ')",
                    "name_dep": "'Dép. '||n_name"},
    "region": {"code_reg": "CAST(r_regionkey AS VARCHAR)", "code_commune_cheflieu": "CAST(r_regionkey AS VARCHAR)||'001'",
               "type_name_format": "'1'", "name_reg_uppercase": "r_name",
               "name_reg_typo_enriched": "array_to_string(list_transform(string_split(lower(r_name),' '), lambda w: upper(w[1])||w[2:]),' ')",
               "name_reg": "r_name"},
}
_GEO_COLUMNS = list(dict.fromkeys([*S.COMMUNE_COLUMNS.values(), *S.DEPARTEMENT_COLUMNS.values(), *S.REGION_COLUMNS.values()]))
ORACLE["model_geography"] = f"WITH {_COMMUNE_SQL}\n" + "\nUNION ALL ".join(
    "SELECT " + ", ".join(f"{_GEO[level].get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in _GEO_COLUMNS)
    + f", '2026' AS release_year, '{level}' AS level FROM {source}"
    for level, source in (("commune", "com"), ("departement", "nation"), ("region", "region")))

_ETA_COLUMNS = {"siren": "siren", "nic": "nic", "siret": "siret", "etablissement_siege": "siege",
                "code_commune_etablissement": "commune", "release_year": "'2026'"}
ORACLE["model_establishments"] = f"WITH {_ETA_SQL}\nSELECT " + ", ".join(
    f"{_ETA_COLUMNS.get(c, 'NULL')} AS {c}" for c in S.ENT_ETABLISSEMENT_COLUMNS) + " FROM eta"

_CONTRACTS_SQL = _MARKETS_SQL + r""",
mu AS (SELECT 'M'||CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) AS id, lpad(CAST(o_custkey AS VARCHAR),14,'0') AS buyer, u.t.titulaire.typeIdentifiant AS typ, u.t.titulaire.id AS tit, CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS montant, CAST(l_shipdate AS DATE) AS d, 'Ligne '||CAST(l_linenumber AS VARCHAR) AS objet FROM b, unnest(b.tits) AS u(t)),
co AS (SELECT 'C'||CAST(o_orderkey AS VARCHAR) AS id, lpad(CAST(o_custkey AS VARCHAR),14,'0') AS buyer, CASE WHEN o_orderkey%4=0 THEN 'TVA' ELSE 'SIRET' END AS typ, '9'||lpad(CAST(o_custkey AS VARCHAR),13,'0') AS tit, CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) AS montant, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS objet FROM orders),
sub AS (SELECT concat_ws(':', domaine, reference_decision, code_commune) AS id, * FROM (""" + ORACLE["model_subsidy_union"] + r"""))"""

# The headers of the node and relationship files.
ORACLE["model_graph_nodes"] = f"{_CONTRACTS_SQL},\n{_COMMUNE_SQL},\n{_ETA_SQL}" + r"""
SELECT 'unite_legale' AS label, 'siren:ID(UniteLegale)' AS header, lpad(CAST(c_custkey AS VARCHAR),19,'0') AS id, CASE WHEN c_custkey%7=0 THEN '[ND]' ELSE c_name END AS name, CAST(NULL AS VARCHAR) AS siren, CAST(NULL AS DOUBLE) AS montant, CAST(NULL AS DATE) AS date_contrat, CAST(NULL AS VARCHAR) AS objet, CAST(NULL AS DATE) AS date_subvention, CAST(NULL AS VARCHAR) AS code_reg, CAST(NULL AS VARCHAR) AS code_dep FROM customer WHERE c_custkey%10<>0
UNION ALL SELECT 'etablissement', 'siret:ID(Etablissement)', siret, NULL, siren, NULL, NULL, NULL, NULL, NULL, NULL FROM eta
UNION ALL SELECT 'commande_publique_marche', 'id:ID(CommandePubliqueMarche)', id, NULL, NULL, montant, d, objet, NULL, NULL, NULL FROM mu
UNION ALL SELECT 'commande_publique_concession', 'id:ID(CommandePubliqueConcession)', id, NULL, NULL, montant, d, objet, NULL, NULL, NULL FROM co
UNION ALL SELECT 'subvention_publique', 'id:ID(SubventionPublique)', id, NULL, NULL, montant, NULL, trim(description_projet), date_subvention, NULL, NULL FROM sub
UNION ALL SELECT 'region', 'code_reg:ID(Region)', CAST(r_regionkey AS VARCHAR), r_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM region
UNION ALL SELECT 'departement', 'code_dep:ID(Departement)', lpad(CAST(n_nationkey AS VARCHAR),2,'0'), 'Dép. '||n_name, NULL, NULL, NULL, NULL, NULL, CAST(n_regionkey AS VARCHAR), NULL FROM nation
UNION ALL SELECT 'commune', 'code_commune:ID(Commune)', code_commune, name_commune, NULL, NULL, NULL, NULL, NULL, code_reg, code_dep FROM com WHERE type_commune='COM'
UNION ALL SELECT 'commune_deleguee', 'code_commune_deleguee:ID(CommuneDeleguee)', code_commune, name_commune, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM com WHERE type_commune IN ('COMD','COMA')
UNION ALL SELECT 'arrondissement', 'code_arrondissement:ID(Arrondissement)', code_commune, name_commune, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM com WHERE type_commune='ARM'"""

ORACLE["model_graph_relationships"] = f"{_CONTRACTS_SQL},\n{_COMMUNE_SQL},\n{_ETA_SQL}" + r""",
known AS (SELECT DISTINCT siret FROM eta),
ends AS (
SELECT 'has_publique_marche' AS relationship, 'CommandePubliqueMarche' AS other, buyer AS siret, id FROM mu
UNION ALL SELECT 'has_publique_concession', 'CommandePubliqueConcession', buyer, id FROM co
UNION ALL SELECT 'gives_publique_marche', 'CommandePubliqueMarche', tit, id FROM mu WHERE typ='SIRET'
UNION ALL SELECT 'gives_publique_concession', 'CommandePubliqueConcession', tit, id FROM co WHERE typ='SIRET'
UNION ALL SELECT 'provides_subvention_publique', 'SubventionPublique', siret_crediteur, id FROM sub
UNION ALL SELECT 'receives_subvention_publique', 'SubventionPublique', siret_beneficiaire, id FROM sub)
SELECT relationship, ':START_ID(Etablissement) :END_ID('||other||')' AS header, siret AS "start", id AS "end" FROM ends WHERE siret IN (SELECT siret FROM known)
UNION ALL SELECT 'has_etablissement', ':START_ID(UniteLegale) :END_ID(Etablissement)', siren, siret FROM eta
UNION ALL SELECT 'etablissement_located_in_'||CASE type_commune WHEN 'COM' THEN 'commune' WHEN 'ARM' THEN 'arrondissement' ELSE 'commune_deleguee' END, ':START_ID(Etablissement) :END_ID('||CASE type_commune WHEN 'COM' THEN 'Commune' WHEN 'ARM' THEN 'Arrondissement' ELSE 'CommuneDeleguee' END||')', siret, code_commune FROM eta JOIN com ON commune=code_commune
UNION ALL SELECT 'has_departement', ':START_ID(Region) :END_ID(Departement)', CAST(n_regionkey AS VARCHAR), lpad(CAST(n_nationkey AS VARCHAR),2,'0') FROM nation
UNION ALL SELECT 'has_commune', ':START_ID(Departement) :END_ID(Commune)', code_dep, code_commune FROM com WHERE type_commune='COM'
UNION ALL SELECT 'has_commune_deleguee', ':START_ID(Commune) :END_ID(CommuneDeleguee)', parent_code_commune, code_commune FROM com WHERE type_commune IN ('COMD','COMA')
UNION ALL SELECT 'has_arrondissement', ':START_ID(Commune) :END_ID(Arrondissement)', parent_code_commune, code_commune FROM com WHERE type_commune='ARM'"""
