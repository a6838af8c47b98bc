"""Registers, enrichment and the geocode cache."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from adjudica.catalogue.registry import PUBLISHED, as_id, published, query, table
from adjudica.functions import geo
from adjudica.operators import joins
from adjudica.operators.versions import number_versions
from adjudica.plans import enrich as enriching
from adjudica.plans import geocache, monthly, registers
from adjudica.session import work_path


def companies(spark, sf):
    """Customers and suppliers as a company register keyed by nine digits."""
    customers = table(spark, sf, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 14, "0").substr(1, 9).alias("siren"),
        F.col("c_mktsegment"),
    )
    return customers.groupBy("siren").agg(
        F.concat(F.lit("Company "), F.min("c_mktsegment")).alias("denominationUniteLegale"),
        F.max("c_mktsegment").alias("categorieEntreprise"),
        F.lit("7210").alias("categorieJuridiqueUniteLegale"),
    )


def sites(spark, sf):
    """Customers as a site register with places from their nation and region."""
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        as_id("c_custkey").alias("siret"),
        (F.col("c_nationkey") * 2.5).alias("latitude"),
        (F.col("c_nationkey") * 1.5 - 10).alias("longitude"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("commune_code"),
        F.col("n_name").alias("commune_nom"),
        F.col("n_nationkey").cast("string").alias("departement_code"),
        F.col("n_name").alias("departement_nom"),
        F.col("n_regionkey").cast("string").alias("region_code"),
        F.col("r_name").alias("region_nom"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("etablissement_nom"),
        F.col("c_mktsegment").alias("activite_code"),
        F.lit("NAFRev2").alias("activite_nomenclature"),
    )


REGISTERS = """companies AS (SELECT substring(lpad(CAST(c_custkey AS VARCHAR), 14, '0'), 1, 9) AS siren, 'Company ' || min(c_mktsegment) AS nom,
    max(c_mktsegment) AS cat FROM customer GROUP BY 1),
sites AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret, c_nationkey * 2.5 AS latitude, c_nationkey * 1.5 - 10 AS longitude,
    lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS commune_code, n_name, r_name, CASE WHEN c_acctbal > 0 THEN c_name END AS site, c_mktsegment AS act
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("""
WITH com AS (SELECT n_name AS com, n_name AS libelle, CAST(n_regionkey AS VARCHAR) AS reg, 'D' || CAST(n_nationkey AS VARCHAR) AS dep FROM nation WHERE n_nationkey < 20
  UNION ALL SELECT 'T' || n_name, n_name, 'D' || CAST(n_nationkey AS VARCHAR), 'D' || CAST(n_nationkey AS VARCHAR) FROM nation WHERE n_nationkey >= 20),
dep AS (SELECT 'D' || CAST(n_nationkey AS VARCHAR) AS dep, 'Dept ' || n_name AS nom FROM nation),
reg AS (SELECT CAST(r_regionkey AS VARCHAR) AS reg, r_name AS nom FROM region UNION ALL SELECT dep, nom FROM dep WHERE CAST(substring(dep, 2) AS INTEGER) >= 20)
SELECT com AS commune_code, libelle AS commune_nom, com.dep AS departement_code, com.reg AS region_code, dep.nom AS departement_nom, reg.nom AS region_nom
FROM com LEFT JOIN dep ON com.dep = dep.dep LEFT JOIN reg ON com.reg = reg.reg
""")
def geo_register(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    code, overseas = F.concat(F.lit("D"), F.col("n_nationkey").cast("string")), F.col("n_nationkey") >= 20
    dept_name = F.concat(F.lit("Dept "), "n_name")
    return registers.build_geo_register(
        nation.where(~overseas).select(
            F.col("n_name").alias("COM"), F.col("n_name").alias("LIBELLE"), F.col("n_regionkey").cast("string").alias("REG"), code.alias("DEP")
        ),
        nation.where(overseas).select(
            F.concat(F.lit("T"), "n_name").alias("COM_COMER"), F.col("n_name").alias("LIBELLE"), code.alias("COMER")
        ),
        nation.where(~overseas).select(code.alias("DEP"), dept_name.alias("LIBELLE")),
        nation.where(overseas).select(code.alias("COMER"), dept_name.alias("LIBELLE")),
        region.select(F.col("r_regionkey").cast("string").alias("REG"), F.col("r_name").alias("LIBELLE")),
    )


@query("""
WITH c AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS siren, c_mktsegment AS seg, c_name, c_nationkey AS n, c_acctbal AS b FROM customer)
SELECT siren, CASE WHEN seg = 'MACHINERY' THEN '[Données personnelles non-diffusibles]' WHEN n < 5 THEN c_name
  ELSE CASE WHEN b > 0 THEN lower(seg) END || ' ' || CASE WHEN n < 10 THEN 'used ' || c_name ELSE 'born ' || c_name END END AS "denominationUniteLegale",
  seg AS "categorieEntreprise", CAST(7000 + n AS VARCHAR) AS "categorieJuridiqueUniteLegale" FROM c
""")
def prepare_companies(spark, sf):
    nation, segment, name = F.col("c_nationkey"), F.col("c_mktsegment"), F.col("c_name")
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("siren"),
        F.when(nation < 5, name).alias("denominationUniteLegale"),
        F.when(F.col("c_acctbal") > 0, F.lower(segment)).alias("prenomUsuelUniteLegale"),
        F.when(nation >= 5, F.concat(F.lit("born "), name)).alias("nomUniteLegale"),
        F.when((nation >= 5) & (nation < 10), F.concat(F.lit("used "), name)).alias("nomUsageUniteLegale"),
        F.when(segment == "MACHINERY", "P").otherwise("O").alias("statutDiffusionUniteLegale"),
        segment.alias("categorieEntreprise"),
        (nation + 7000).cast("string").alias("categorieJuridiqueUniteLegale"),
    )
    return registers.prepare_companies(raw)


@query("""
SELECT lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS siret, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS commune_code,
  coalesce(CASE WHEN s_acctbal > 5000 THEN s_name END, 'usual ' || s_name) AS etablissement_nom, n_name AS commune_nom, r_name AS region_nom,
  '01.1A' AS activite_code, 'NAFRev2' AS activite_nomenclature
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey - 3 LEFT JOIN region ON n_regionkey = r_regionkey
""")
def prepare_sites(spark, sf):
    geo_rows = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.lpad((F.col("n_nationkey") + 3).cast("string"), 5, "0").alias("commune_code"),
            F.col("n_name").alias("commune_nom"),
            F.col("r_name").alias("region_nom"),
        )
    )
    raw = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("siret"),
        F.col("s_nationkey").cast("string").alias("codeCommuneEtablissement"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("enseigne1Etablissement"),
        F.concat(F.lit("usual "), "s_name").alias("denominationUsuelleEtablissement"),
        F.lit("01.1A").alias("activitePrincipaleEtablissement"),
        F.lit("NAFRev2").alias("nomenclatureActivitePrincipaleEtablissement"),
    )
    return registers.prepare_sites(raw, geo_rows)


@query(f"""
WITH {PUBLISHED}, {REGISTERS},
full_a AS (SELECT siret, CASE WHEN site IS NOT NULL AND site <> nom THEN nom || ' (' || site || ')' ELSE nom END AS nom, cat, s.* EXCLUDE (siret, site)
  FROM sites s JOIN companies ON substring(siret, 1, 9) = siren),
j AS (SELECT p.*, b.nom AS bn, b.r_name AS br, b.latitude AS bla, b.longitude AS blo, h.nom AS hn, h.cat AS hc, h.commune_code AS hcc, h.act AS act, h.latitude AS hla, h.longitude AS hlo
  FROM published p LEFT JOIN full_a b ON acheteur_id = b.siret LEFT JOIN full_a h ON titulaire_id = h.siret AND "titulaire_typeIdentifiant" = 'SIRET')
SELECT uid, acheteur_id, titulaire_id, "titulaire_typeIdentifiant", montant, coalesce(bn, CASE WHEN acheteur_id = '00000000000007' THEN 'Seven' END) AS acheteur_nom,
  CASE WHEN bn IS NOT NULL THEN 'Commune' END AS acheteur_categorie, br AS acheteur_region_nom, hn AS titulaire_nom, hc AS titulaire_categorie, hcc AS titulaire_commune_code, act AS activite_code,
  CAST(round(2 * 6371.0 * asin(sqrt(pow(sin(radians(hla - bla) / 2), 2) + cos(radians(bla)) * cos(radians(hla)) * pow(sin(radians(hlo - blo) / 2), 2)))) AS SMALLINT) AS titulaire_distance
FROM j
""")
def enrich_contracts(spark, sf):
    rows = published(spark, sf)
    full = enriching.enrich(rows, companies(spark, sf), sites(spark, sf), {"00000000000007": "Seven"})
    return full.select(
        "uid",
        "acheteur_id",
        "titulaire_id",
        "titulaire_typeIdentifiant",
        "montant",
        "acheteur_nom",
        "acheteur_categorie",
        "acheteur_region_nom",
        "titulaire_nom",
        "titulaire_categorie",
        "titulaire_commune_code",
        "activite_code",
        "titulaire_distance",
    )


@query("""
WITH c AS (SELECT DISTINCT o_custkey FROM orders)
SELECT o_orderkey, c_name, c_mktsegment, n_name, r_name FROM orders LEFT JOIN (
  SELECT o_custkey AS k, c_name, c_mktsegment, n_name, r_name FROM c JOIN customer ON o_custkey + 100 = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) ON o_custkey = k
""")
def enrich_customer(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer")
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    known = (
        orders.select("o_custkey")
        .distinct()
        .join(customers, F.col("o_custkey") + 100 == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("o_custkey").alias("known_key"), "c_name", "c_mktsegment", "n_name", "r_name")
    )
    return joins.left_on(orders, known, [("o_custkey", "known_key")]).drop("o_custkey")


@query("""
SELECT c_custkey, CAST(round(2 * 6371.0 * asin(sqrt(pow(sin(radians(r_regionkey * 10.25 - c_nationkey * 3.1) / 2), 2)
  + cos(radians(c_nationkey * 3.1)) * cos(radians(r_regionkey * 10.25)) * pow(sin(radians((r_regionkey * 7.75) - (c_nationkey * 2.3 - 20)) / 2), 2)))) AS SMALLINT) AS km
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def haversine(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    nation, region = F.col("c_nationkey"), F.col("r_regionkey")
    return rows.select(
        "c_custkey", geo.whole_km(nation * 3.1, nation * 2.3 - 20, region * 10.25, region * 7.75).alias("km")
    )


CACHE = """cache AS (SELECT lpad(CAST(p_partkey + 300 AS VARCHAR), 14, '0') AS siret, CASE WHEN p_type = 'SMALL' THEN p_size * 1.5::DOUBLE END AS latitude,
    CASE WHEN p_type = 'SMALL' THEN p_size * 0.5::DOUBLE END AS longitude, p_brand AS source, CAST(NULL AS DOUBLE) AS score, DATE '2026-05-15' - p_size * 2 AS geocoded_at,
    CASE p_type WHEN 'SMALL' THEN 'success' WHEN 'PROMO' THEN 'not_in_sirene' ELSE 'failed' END AS status FROM part)"""
PENDING = """ids AS (SELECT DISTINCT siret FROM (SELECT lpad(CAST(l_partkey AS VARCHAR), 14, '0') AS siret FROM lineitem
    UNION ALL SELECT lpad(CAST(l_suppkey + 1900 AS VARCHAR), CASE WHEN l_returnflag = 'N' THEN 13 ELSE 14 END, '0') FROM lineitem) WHERE length(siret) = 14),
pending AS (SELECT siret FROM ids WHERE siret NOT IN (SELECT siret FROM cache WHERE status IN ('success', 'not_in_sirene')
    OR (status = 'failed' AND geocoded_at >= DATE '2026-04-15')))"""
TODAY = date(2026, 5, 15)


def cache(spark, sf):
    kind, size = F.col("p_type"), F.col("p_size")
    return table(spark, sf, "part").select(
        F.lpad((F.col("p_partkey") + 300).cast("string"), 14, "0").alias("siret"),
        F.when(kind == "SMALL", size * 1.5).alias("latitude"),
        F.when(kind == "SMALL", size * 0.5).alias("longitude"),
        F.col("p_brand").alias("source"),
        F.lit(None).cast("double").alias("score"),
        F.date_sub(F.lit(TODAY), size * 2).alias("geocoded_at"),
        F.when(kind == "SMALL", "success").when(kind == "PROMO", "not_in_sirene").otherwise("failed").alias("status"),
    )


def parties(spark, sf):
    """Order lines with a buyer and a holder id, some of them too short."""
    width = F.when(F.col("l_returnflag") == "N", 13).otherwise(14)
    return table(spark, sf, "lineitem").select(
        as_id("l_partkey").alias("acheteur_id"),
        F.lpad((F.col("l_suppkey") + 1900).cast("string"), width, F.lit("0")).alias("titulaire_id"),
    )


@query(f"WITH {CACHE}, {PENDING} SELECT siret FROM pending")
def select_pending(spark, sf):
    return geocache.select_pending(parties(spark, sf), cache(spark, sf), TODAY)


@query(f"""
WITH {CACHE}, {PENDING}, known AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret FROM customer),
fresh AS (SELECT siret, NULL AS latitude, NULL AS longitude, 'geoplateforme' AS source, NULL AS score, DATE '2026-05-15' AS geocoded_at, 'not_in_sirene' AS status, 1 AS layer
    FROM pending WHERE siret NOT IN (SELECT siret FROM known)
  UNION ALL SELECT siret, CASE WHEN score >= 0.5 THEN latitude END, CASE WHEN score >= 0.5 THEN longitude END, 'geoplateforme', score, DATE '2026-05-15',
    CASE WHEN score >= 0.5 THEN 'success' ELSE 'failed' END, 2 FROM (
      SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret, CASE WHEN c_acctbal > 0 THEN c_acctbal / 10000 END AS score, c_nationkey * 2.5::DOUBLE AS latitude, c_nationkey * 1.5::DOUBLE AS longitude FROM customer)
    WHERE siret IN (SELECT siret FROM pending))
SELECT siret, latitude, longitude, source, score, geocoded_at, status FROM (
  SELECT *, row_number() OVER (PARTITION BY siret ORDER BY layer DESC) AS rn FROM (SELECT *, 0 AS layer FROM cache UNION ALL SELECT * FROM fresh)) WHERE rn = 1
""")
def cache_upsert(spark, sf):
    customers = table(spark, sf, "customer")
    known = customers.select(as_id("c_custkey").alias("siret"))
    replies = customers.select(
        as_id("c_custkey").alias("siret"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 10000).alias("result_score"),
        (F.col("c_nationkey") * 2.5).alias("latitude"),
        (F.col("c_nationkey") * 1.5).alias("longitude"),
    )
    old = cache(spark, sf)
    pending = geocache.select_pending(parties(spark, sf), old, TODAY)
    return geocache.upsert_cache(old, pending, replies, known, TODAY)


EVENT_REPLIES = """r AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value / 100 END AS score, value AS latitude FROM events)"""


def event_replies(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("siret"),
        F.when(F.col("event_type") != "error", F.col("value") / 100).alias("result_score"),
        F.col("value").alias("latitude"),
        (-F.col("value")).alias("longitude"),
    )


@query(f"""
WITH {EVENT_REPLIES}
SELECT CAST(event_id AS VARCHAR) AS siret, CASE WHEN score >= 0.5 THEN latitude END AS latitude, CASE WHEN score >= 0.5 THEN -latitude END AS longitude,
  'geoplateforme' AS source, score, DATE '2026-05-15' AS geocoded_at, CASE WHEN score >= 0.5 THEN 'success' ELSE 'failed' END AS status FROM r
""")
def geocode_status(spark, sf):
    return geocache.parse_replies(event_replies(spark, sf), TODAY)


@query(f"""
WITH {EVENT_REPLIES}, s AS (SELECT CASE WHEN score >= 0.5 THEN 'success' ELSE 'failed' END AS status FROM r)
SELECT status, count(*) AS n, round(count(*) / (SELECT count(*) FROM s) * 100, 1) AS pct FROM s GROUP BY status
""")
def geocode_report(spark, sf):
    return geocache.reply_report(geocache.parse_replies(event_replies(spark, sf), TODAY))


@query("""
SELECT DISTINCT user_id, event_type FROM events WHERE event_type IN ('purchase', 'signup') OR (event_type = 'error' AND CAST(ts AS DATE) >= DATE '2024-01-10')
""")
def retry_selection(spark, sf):
    status = (
        F.when(F.col("event_type") == "purchase", "success")
        .when(F.col("event_type") == "signup", "not_in_sirene")
        .when(F.col("event_type") == "error", "failed")
    )
    events = table(spark, sf, "events").select(
        "user_id", "event_type", status.alias("status"), F.to_date("ts").alias("geocoded_at")
    )
    return events.where(geocache.settled(date(2024, 1, 20), 10)).select("user_id", "event_type").distinct()


@query("""
WITH l AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS a, o_custkey * 0.5::DOUBLE AS ala, CASE WHEN l_tax <> 0 THEN l_tax END AS alo,
    lpad(CAST(l_suppkey AS VARCHAR), CASE WHEN l_returnflag = 'R' THEN 9 ELSE 14 END, '0') AS t, nullif(l_discount, 0) AS tla, l_quantity AS tlo
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
u AS (SELECT a AS siret, ala AS latitude, alo AS longitude, 0 AS role FROM l UNION ALL SELECT t, tla, tlo, 1 FROM l)
SELECT siret, latitude, longitude, 'decp' AS source, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS DATE) AS geocoded_at, 'success' AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY siret ORDER BY role, latitude, longitude) AS rn FROM u
  WHERE length(siret) = 14 AND latitude IS NOT NULL AND longitude IS NOT NULL) WHERE rn = 1
""")
def seed_cache(spark, sf):
    width = F.when(F.col("l_returnflag") == "R", 9).otherwise(14)
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return registers.seed_cache(
        rows.select(
            as_id("o_custkey").alias("acheteur_id"),
            (F.col("o_custkey") * 0.5).alias("acheteur_latitude"),
            F.nullif("l_tax", F.lit(0.0)).alias("acheteur_longitude"),
            F.lpad(F.col("l_suppkey").cast("string"), width, F.lit("0")).alias("titulaire_id"),
            F.nullif("l_discount", F.lit(0.0)).alias("titulaire_latitude"),
            F.col("l_quantity").alias("titulaire_longitude"),
        )
    )


@query("""
SELECT lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS siret, trim(regexp_replace(CAST(c_nationkey AS VARCHAR) || ' ' || coalesce(CASE WHEN c_acctbal > 0 THEN 'bis' END, '') || ' RUE ' || c_name, '\\s+', ' ', 'g')) AS q,
  lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS postcode, CAST(c_nationkey AS VARCHAR) AS citycode
FROM customer WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders)
""".replace("\\\\", "\\"))
def geocoder_request(spark, sf):
    nation = F.col("c_nationkey").cast("string")
    register = table(spark, sf, "customer").select(
        as_id("c_custkey").alias("siret"),
        nation.alias("numeroVoieEtablissement"),
        F.when(F.col("c_acctbal") > 0, "bis").alias("indiceRepetitionEtablissement"),
        F.lit("RUE").alias("typeVoieEtablissement"),
        F.col("c_name").alias("libelleVoieEtablissement"),
        F.lpad(nation, 5, "0").alias("codePostalEtablissement"),
        nation.alias("commune_code"),
    )
    pending = table(spark, sf, "orders").select(as_id("o_custkey").alias("siret")).distinct()
    return geocache.geocoder_request(pending, register)


@query(f"""
WITH {PUBLISHED} SELECT uid, titulaire_id, "dateNotification" AS awarded, montant,
  CASE WHEN r > "dureeMois" THEN CAST("dureeMois" AS DOUBLE) ELSE r END AS months_left,
  CASE WHEN CAST(substring(titulaire_id, 13, 2) AS TINYINT) = 45 THEN 'Travaux' WHEN CAST(substring(titulaire_id, 13, 2) AS TINYINT) BETWEEN 1 AND 44
    OR CAST(substring(titulaire_id, 13, 2) AS TINYINT) = 48 THEN 'Fournitures' WHEN CAST(substring(titulaire_id, 13, 2) AS TINYINT) BETWEEN 50 AND 98 THEN 'Services' ELSE 'Non catégorisé' END AS type
FROM (SELECT *, CASE WHEN raw < 0 THEN 0 ELSE raw END AS r FROM (
  SELECT *, round(date_diff('day', DATE '1999-06-30', "dateNotification" + CAST(trunc("dureeMois" * 30.5) AS INTEGER)) / 30, 1) AS raw FROM published))
""")
def derived_columns(spark, sf):
    from adjudica.catalogue.registry import AS_OF

    rows = published(spark, sf).withColumn("codeCPV", F.substring("titulaire_id", 13, 2))
    return enriching.derive(rows, AS_OF).select(
        "uid",
        "titulaire_id",
        F.col("dateNotification").alias("awarded"),
        "montant",
        F.col("dureeRestanteMois").alias("months_left"),
        "type",
    )


@query("""
WITH geo AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code, n_name,
    CASE WHEN n_nationkey < 20 THEN 'Dept ' || r_name ELSE 'Terr ' || n_name END AS dep, CASE WHEN n_nationkey < 20 THEN r_name ELSE 'Terr ' || n_name END AS reg
  FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS siret, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS commune_code, s_name AS etablissement_nom,
  n_name AS commune_nom, dep AS departement_nom, reg AS region_nom, CASE WHEN s_acctbal > 0 THEN CAST(s_acctbal AS DOUBLE) END AS latitude,
  c_name AS company
FROM supplier LEFT JOIN geo ON code = lpad(CAST(s_nationkey AS VARCHAR), 5, '0') LEFT JOIN customer ON c_custkey = s_suppkey
""")
def monthly_registers(spark, sf):
    """Registers of one month as one job, read again: suppliers as sites, customers as companies."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    overseas, territory = F.col("n_nationkey") >= 20, F.concat(F.lit("T"), F.col("n_nationkey").cast("string"))
    supplier, customer = table(spark, sf, "supplier"), table(spark, sf, "customer")
    code, dept = F.col("n_regionkey").cast("string"), F.concat(F.lit("D"), F.col("r_regionkey").cast("string"))
    commune = F.lpad(F.col("n_nationkey").cast("string"), 5, "0")
    raw = monthly.RawRegisters(
        companies=customer.select(
            F.col("c_custkey").cast("string").alias("siren"),
            F.col("c_name").alias("denominationUniteLegale"),
            *[F.lit(None).cast("string").alias(c) for c in ("prenomUsuelUniteLegale", "nomUniteLegale", "nomUsageUniteLegale")],
            F.lit("O").alias("statutDiffusionUniteLegale"),
            F.col("c_mktsegment").alias("categorieEntreprise"),
            F.lit("7210").alias("categorieJuridiqueUniteLegale"),
        ),
        sites=supplier.select(
            F.col("s_suppkey").cast("string").alias("siret"),
            F.col("s_nationkey").cast("string").alias("codeCommuneEtablissement"),
            F.lit(None).cast("string").alias("enseigne1Etablissement"),
            F.col("s_name").alias("denominationUsuelleEtablissement"),
            F.lit("01.1A").alias("activitePrincipaleEtablissement"),
            F.lit("NAFRev2").alias("nomenclatureActivitePrincipaleEtablissement"),
        ),
        communes=nation.where(~overseas).select(
            commune.alias("COM"), F.col("n_name").alias("LIBELLE"), code.alias("REG"), F.concat(F.lit("D"), code).alias("DEP")
        ),
        overseas_communes=nation.where(overseas).select(commune.alias("COM_COMER"), F.col("n_name").alias("LIBELLE"), territory.alias("COMER")),
        departments=region.select(dept.alias("DEP"), F.concat(F.lit("Dept "), "r_name").alias("LIBELLE")),
        overseas_departments=nation.where(overseas).select(territory.alias("COMER"), F.concat(F.lit("Terr "), "n_name").alias("LIBELLE")),
        regions=region.select(F.col("r_regionkey").cast("string").alias("REG"), F.col("r_name").alias("LIBELLE")),
        coordinates=supplier.where("s_acctbal > 0").select(as_id("s_suppkey").alias("siret"), F.col("s_acctbal").cast("double").alias("latitude")),
    )
    folder = work_path(spark, "registers")
    monthly.refresh(spark, raw, folder, "2026-05")
    made = monthly.read_registers(spark, folder, "2026-05")
    named = made["companies"].select(F.lpad("siren", 14, "0").alias("siret"), F.col("denominationUniteLegale").alias("company"))
    return made["sites"].join(named, "siret", "left").select(
        "siret", "commune_code", "etablissement_nom", "commune_nom", "departement_nom", "region_nom", "latitude", "company"
    )
