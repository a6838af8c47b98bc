"""Counts, medians, overlaps and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from adjudica.catalogue.registry import NUMBERED, PUBLISHED, published, query, table
from adjudica.operators import counts, overlap
from adjudica.operators.versions import number_versions
from adjudica.plans import stats
from adjudica.session import materialise, work_path
from adjudica.sinks import files

CURRENT = """current_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY acheteur_id NULLS LAST, "dateNotification" NULLS LAST,
    "datePublicationDonnees" NULLS LAST, "donneesActuelles", montant NULLS LAST, "sourceDataset" NULLS LAST, "sourceFile" NULLS LAST) AS rn
  FROM numbered WHERE "donneesActuelles") WHERE rn = 1)"""
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber) AS uid"
CURRENT_COLUMNS = [
    "uid",
    "acheteur_id",
    "dateNotification",
    "datePublicationDonnees",
    "montant",
    "donneesActuelles",
    "sourceDataset",
    "sourceFile",
]


@query("SELECT o_orderpriority AS priority, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL")
def group_counts(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    return counts.counted(orders, ["priority", "status"], "n")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, CAST(trunc(sum(CAST(o_totalprice AS DECIMAL(18, 2)))) AS BIGINT) AS total,
  round(median(o_totalprice), 4) AS middle, count(DISTINCT o_custkey) AS n_buyers FROM orders GROUP BY 1
""")
def yearly_amounts(spark, sf):
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice", "o_custkey")
    sums = orders.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"),
        stats.whole(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).alias("total"),
        F.countDistinct("o_custkey").alias("n_buyers"),
    )
    middles = counts.exact_median(orders, ["year"], "o_totalprice", "middle")
    return sums.join(middles.withColumn("middle", F.round("middle", 4)), "year")


@query("""
SELECT l_returnflag AS flag, round(median(l_quantity), 4) AS middle_quantity FROM lineitem GROUP BY 1
""")
def median_with_ties(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_quantity")
    return counts.exact_median(lines, ["flag"], "l_quantity", "middle_quantity").withColumn(
        "middle_quantity", F.round("middle_quantity", 4)
    )


@query("""
SELECT o_orderpriority AS priority, count(DISTINCT o_custkey) AS n_buyers FROM orders GROUP BY 1
""")
def distinct_per_group(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "priority")
    return counts.distinct_per_group(orders, "priority", "o_custkey", "n_buyers")


@query("""
SELECT event_type AS kind, count(*) AS n, round(count(*) / (SELECT count(*) FROM events) * 100, 1) AS pct FROM events GROUP BY 1
""")
def shares_of_total(spark, sf):
    return counts.shares(table(spark, sf, "events").select(F.col("event_type").alias("kind")), "kind")


@query("""
WITH s AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS uid, l_returnflag AS src FROM lineitem),
c AS (SELECT uid, count(*) AS k FROM s GROUP BY 1),
t AS (SELECT src, count(*) AS n_total, count(*) FILTER (k = 1) AS alone FROM s JOIN c USING (uid) GROUP BY 1)
SELECT a.src AS source, b.src AS other, count(*) AS n_both, any_value(n_total) AS n_total, round(count(*) / any_value(n_total), 9) AS share,
  round(any_value(alone) / any_value(n_total), 9) AS "unique" FROM s a JOIN s b ON a.uid = b.uid JOIN t ON t.src = a.src GROUP BY 1, 2
""")
def source_overlap(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.expr(LINE_ID), F.col("l_returnflag").alias("source"))
    return overlap.overlap_pairs(lines, "uid", "source").withColumns(
        {c: F.round(c, 9) for c in ("share", "unique")}
    )


@query("""
WITH s AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS uid, l_returnflag || l_linestatus AS src FROM lineitem),
m AS (SELECT uid, max((src = 'AF')::INT) AS af, max((src = 'AO')::INT) AS ao, max((src = 'NF')::INT) AS nf, max((src = 'NO')::INT) AS no, max((src = 'RF')::INT) AS rf,
  max((src = 'RO')::INT) AS ro, count(*) AS k FROM s GROUP BY 1)
SELECT s.src AS source, round(count(*) FILTER (k = 1) / count(*), 9) AS "unique",
  CASE WHEN s.src <> 'AF' THEN round(sum(af) / count(*), 9) END AS "AF", CASE WHEN s.src <> 'AO' THEN round(sum(ao) / count(*), 9) END AS "AO",
  CASE WHEN s.src <> 'NF' THEN round(sum(nf) / count(*), 9) END AS "NF", CASE WHEN s.src <> 'NO' THEN round(sum(no) / count(*), 9) END AS "NO",
  CASE WHEN s.src <> 'RF' THEN round(sum(rf) / count(*), 9) END AS "RF", CASE WHEN s.src <> 'RO' THEN round(sum(ro) / count(*), 9) END AS "RO"
FROM s JOIN m USING (uid) GROUP BY 1
""")
def source_overlap_matrix(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.expr(LINE_ID), F.concat("l_returnflag", "l_linestatus").alias("source"))
    sources = ["AF", "AO", "NF", "NO", "RF", "RO"]
    wide = overlap.overlap_matrix(lines, sources, "uid", "source")
    return wide.withColumns({c: F.round(c, 9) for c in ("unique", *sources)})


@query("SELECT l_partkey AS uid, count(DISTINCT l_returnflag) AS n_sources FROM lineitem GROUP BY 1")
def sources_per_key(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("uid"), F.col("l_returnflag").alias("source"))
    return overlap.sources_per_key(lines, "uid", "source")


@query("""
SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
  count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1
""")
def pivot_counts(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "priority")
    return orders.groupBy("priority").pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)


YEARLY = f"""
WITH {NUMBERED}, {CURRENT},
y AS (SELECT CAST(range AS INTEGER) AS annee FROM range(1994, 2004)),
p AS (SELECT year("datePublicationDonnees") AS annee, count(*) AS n FROM current_rows GROUP BY 1),
a AS (SELECT year("dateNotification") AS annee, count(*) AS n, sum(CAST(montant AS DECIMAL(18, 2))) AS s, median(montant) AS m, count(DISTINCT acheteur_id) AS b FROM current_rows GROUP BY 1),
h AS (SELECT year("dateNotification") AS annee, count(DISTINCT titulaire_id) AS t FROM numbered GROUP BY 1)
SELECT y.annee, coalesce(p.n, 0) AS nb_publications_marches, coalesce(a.n, 0) AS nb_notifications_marches, CAST(trunc(s) AS BIGINT) AS somme_montant_marches_notifies,
  CAST(trunc(m) AS BIGINT) AS mediane_montant_marches_notifies, b AS nb_acheteurs_uniques, CASE WHEN a.n IS NOT NULL THEN t END AS nb_titulaires_uniques
FROM y LEFT JOIN p USING (annee) LEFT JOIN a USING (annee) LEFT JOIN h USING (annee)
"""
LAST_DAY, FIRST_YEAR = date(2003, 6, 30), 1994


@query(YEARLY)
def yearly_stats(spark, sf):
    rows = materialise(number_versions(published(spark, sf)), "numbered")
    current = materialise(stats.current_records(rows.select(*CURRENT_COLUMNS)), "current")
    return stats.yearly_stats(rows, current, LAST_DAY, FIRST_YEAR)


@query(YEARLY.replace("SELECT y.annee,", "SELECT (SELECT count(*) FROM current_rows) AS nb_marches, (SELECT count(*) FROM numbered) AS nb_lignes, y.annee,"))
def stats_json(spark, sf):
    """The statistics document, written and read back: its totals beside each year."""
    rows = materialise(number_versions(published(spark, sf)), "numbered")
    path = work_path(spark, "statistics")
    files.write_document(stats.contract_stats(rows, LAST_DAY, FIRST_YEAR), path)
    names = ["nb_publications_marches", "nb_notifications_marches", "somme_montant_marches_notifies", "mediane_montant_marches_notifies",
             "nb_acheteurs_uniques", "nb_titulaires_uniques"]
    figures = ",".join(f"{n}:bigint" for n in names)
    years = range(FIRST_YEAR, LAST_DAY.year + 1)
    document = spark.read.schema("nb_marches bigint, nb_lignes bigint, " + ", ".join(f"`{y}` struct<{figures}>" for y in years)).json(path)
    each = F.explode(F.array(*[F.struct(F.lit(y).alias("annee"), F.col(f"`{y}`").alias("year")) for y in years]))
    return document.select("nb_marches", "nb_lignes", each.alias("y")).select("nb_marches", "nb_lignes", "y.annee", "y.year.*")


@query(f"""
WITH {NUMBERED}, {CURRENT}
SELECT count(DISTINCT "sourceFile") AS nb_resources, string_agg(DISTINCT "sourceDataset", ',' ORDER BY "sourceDataset") AS sources, count(*) AS nb_marches,
  count(DISTINCT acheteur_id) - 1 AS nb_acheteurs_uniques, (SELECT count(*) FROM numbered) AS nb_lignes,
  (SELECT count(*) - 1 FROM (SELECT DISTINCT titulaire_id, "titulaire_typeIdentifiant" FROM numbered)) AS nb_titulaires_uniques, CAST(12 AS INTEGER) AS nb_colonnes FROM current_rows
""")
def global_counts(spark, sf):
    rows = materialise(number_versions(published(spark, sf)), "numbered")
    current = materialise(stats.current_records(rows.select(*CURRENT_COLUMNS)), "current")
    return stats.overall_stats(rows, current).withColumn("sources", F.array_join("sources", ",")).drop("colonnes_triees")


@query(f"""
WITH {NUMBERED}, one AS (SELECT * FROM (SELECT uid, montant, acheteur_id, row_number() OVER (PARTITION BY uid ORDER BY acheteur_id NULLS LAST, montant NULLS LAST) AS rn
  FROM numbered WHERE "donneesActuelles") WHERE rn = 1)
SELECT CAST(trunc(sum(CAST(montant AS DECIMAL(18, 2)))) AS BIGINT) AS amount, count(*) AS n_records, count(DISTINCT acheteur_id) AS n_buyers,
  (SELECT count(*) FROM numbered WHERE "donneesActuelles") AS n_rows, (SELECT count(DISTINCT titulaire_id) FROM numbered WHERE "donneesActuelles") AS n_holders FROM one
""")
def totals(spark, sf):
    return stats.totals(number_versions(published(spark, sf)))


@query(f'WITH {PUBLISHED} SELECT "sourceDataset" AS source, count(DISTINCT uid) AS n_records FROM published GROUP BY 1')
def records_per_source(spark, sf):
    return stats.records_per_source(published(spark, sf)).withColumnRenamed("sourceDataset", "source")


@query("""
WITH d AS (SELECT doc_id, md5(text) AS uid, lang || '_' || source AS src FROM documents), reg AS (SELECT DISTINCT lang AS code FROM documents WHERE lang <> 'es' UNION ALL SELECT DISTINCT lang || '_src12' FROM documents),
k AS (SELECT src, count(DISTINCT uid) AS n, count(DISTINCT quality) + max(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS b FROM d LEFT JOIN labels USING (doc_id) GROUP BY 1),
u AS (SELECT src, round(count(*) FILTER (times = 1) / count(*), 9) AS alone FROM (SELECT DISTINCT src, uid FROM d) JOIN (SELECT uid, count(DISTINCT src) AS times FROM d GROUP BY 1) USING (uid) GROUP BY 1)
SELECT 'Name ' || r AS nom, 'Owner ' || r AS organisation, 'https://www.data.gouv.fr/datasets/' || r AS url, n AS "nb_marchés", b AS nb_acheteurs, src AS code, alone AS "unique"
FROM (SELECT *, (SELECT max(code) FROM reg WHERE code <= src AND code IN (SELECT src FROM k)) AS r FROM k) JOIN u USING (src)
""")
def source_stats(spark, sf):
    documents = table(spark, sf, "documents")
    rows = (
        documents.join(table(spark, sf, "labels"), "doc_id", "left")
        .select(
            F.md5("text").alias("uid"),  # copies are one record that several sources have
            F.col("quality").alias("acheteur_id"),
            F.concat_ws("_", "lang", "source").alias("sourceDataset"),
        )
    )
    codes = documents.where("lang <> 'es'").select(F.col("lang").alias("code")).distinct()
    codes = codes.unionByName(documents.select(F.concat("lang", F.lit("_src12")).alias("code")).distinct())
    register = codes.select(
        F.col("code").alias("id"), F.concat(F.lit("Name "), "code").alias("name"), F.concat(F.lit("Owner "), "code").alias("owner_org_name"), "code"
    )
    alone = overlap.overlap_pairs(rows).where("sourceDataset = other").select("sourceDataset", "unique")
    return stats.source_stats(rows, register, alone).withColumn("unique", F.round("unique", 9))


@query("""
SELECT source AS resource, count(*) AS row_number, CASE WHEN count(CASE WHEN source <> 'src3' THEN 1 END) > 0 THEN 'doc_id,lang,size,text' ELSE 'doc_id,lang,text' END AS data_fields,
  CAST(CASE WHEN source <> 'src3' THEN 4 ELSE 3 END AS BIGINT) AS data_fields_number FROM documents GROUP BY source
""")
def resource_profile(spark, sf):
    documents = table(spark, sf, "documents").select(
        F.col("source").alias("resource"),
        "doc_id",
        "text",
        "lang",
        F.when(F.col("source") != "src3", F.col("n_chars")).alias("size"),
    )
    return stats.resource_profile(documents, "resource").withColumn("data_fields", F.array_join("data_fields", ","))
