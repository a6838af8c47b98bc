"""Flat readers and writers, the list of resources, related tables and the column contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudica.catalogue.registry import PUBLISHED, NUMBERED, published, query, table
from adjudica.operators import dedup
from adjudica.operators.versions import number_versions
from adjudica.session import materialise, work_path
from adjudica.sinks import contract, files, relational
from adjudica.sources import manifest, tables

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority"
ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"


def dated_orders(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 30")
def scan_pruned(spark, sf):
    return tables.read_parquet(spark, f"{sf}/lineitem.parquet", columns=["l_orderkey", "l_quantity"]).where("l_quantity > 30")


@query(f"SELECT {ORDERS} FROM orders")
def write_read_parquet(spark, sf):
    return files.write_parquet(dated_orders(spark, sf), work_path(spark, "orders"))


@query(f"SELECT {ORDERS} FROM orders")
def materialised(spark, sf):
    return materialise(dated_orders(spark, sf), "orders")


@query(f"SELECT {ORDERS} FROM orders")
def write_read_csv(spark, sf):
    path = work_path(spark, "orders")
    files.write_table(dated_orders(spark, sf), path)
    return tables.read_csv(spark, f"{path}.csv", schema=ORDERS_SCHEMA)


@query("SELECT c_custkey, 'é;' || c_name AS label, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
def read_csv_latin1(spark, sf):
    path = work_path(spark, "customers")
    segment = F.replace("c_mktsegment", F.lit("BUILDING"), F.lit("[ND]"))
    rows = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("é;"), "c_name").alias("label"), segment.alias("segment"), "c_name")
    rows.write.options(header=True, sep=";", encoding="ISO-8859-1").csv(path)
    return tables.read_csv(
        spark, path, schema="c_custkey bigint, label string, segment string, c_name string",
        columns=["c_custkey", "label", "segment"], separator=";", encoding="ISO-8859-1", null_value="[ND]",
    )


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def read_csv_columns(spark, sf):
    path = work_path(spark, "orders-csv")
    files.write_csv(dated_orders(spark, sf), path)
    return tables.read_csv_texts(spark, path, columns=["o_orderkey", "o_orderpriority"])


@query("SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS absent FROM events")
def read_json_lines(spark, sf):
    path = work_path(spark, "events")
    table(spark, sf, "events").select("event_id", "event_type", "value").write.json(path)
    return tables.read_lines(spark, path, schema="event_id bigint, event_type string, absent string")


@query("""
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month, 'collector' AS source FROM orders
""")
def months_json(spark, sf):
    path = work_path(spark, "months")
    files.write_by_month(dated_orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderdate"), path, "o_orderdate", "collector")
    schema = "o_orderkey bigint, o_totalprice double, source string, month string"
    return spark.read.schema(schema).json(path)


LISTED = """listed AS (SELECT lang || '_' || source AS dataset_id, CAST(doc_id AS VARCHAR) AS id, 'Doc.' || CAST(doc_id AS VARCHAR) || CASE WHEN lang = 'fr' THEN '.JSON' ELSE '.xml' END AS title,
    CASE lang WHEN 'fr' THEN 'json' WHEN 'es' THEN 'csv' ELSE 'xml' END AS format, CASE WHEN lang <> 'de' THEN md5(text) END AS checksum,
    CASE WHEN source <> 'src1' THEN 'a' || md5(text) END AS analysis, CASE WHEN lang = 'fr' THEN 0 WHEN source = 'src2' THEN NULL ELSE n_chars END AS filesize,
    CASE WHEN source <> 'src2' THEN n_chars + 7 END AS analysis_size FROM documents)
, kept AS (SELECT dataset_id, id, dataset_id || '_' || replace(replace(replace(lower(title), '.json', ''), '.xml', ''), '.', '_') || '_' || substring(id, 1, 3) AS filename,
    format, coalesce(checksum, analysis, id) AS checksum, coalesce(nullif(filesize, 0), nullif(analysis_size, 0), 1000) AS filesize
  FROM listed WHERE format IN ('json', 'xml') AND id <> '0' AND coalesce(nullif(filesize, 0), nullif(analysis_size, 0), 1000) > 180)"""


def listed_resources(spark, sf):
    lang, source, size = F.col("lang"), F.col("source"), F.col("n_chars")
    key = F.col("doc_id").cast("string")
    return table(spark, sf, "documents").select(
        F.concat_ws("_", "lang", "source").alias("dataset_id"),
        source.alias("dataset_name"),
        lang.alias("dataset_code"),
        key.alias("id"),
        F.concat(F.lit("Doc."), key, F.when(lang == "fr", ".JSON").otherwise(".xml")).alias("title"),
        F.when(lang == "fr", "json").when(lang == "es", "csv").otherwise("xml").alias("format"),
        F.concat(F.lit("https://site.example/"), key).alias("url"),
        F.lit(None).cast("string").alias("created_at"),
        F.lit(None).cast("string").alias("last_modified"),
        F.when(lang != "de", F.md5("text")).alias("checksum"),
        F.when(source != "src1", F.concat(F.lit("a"), F.md5("text"))).alias("analysis_checksum"),
        F.when(lang == "fr", 0).when(source == "src2", None).otherwise(size).alias("filesize"),
        F.when(source != "src2", size + 7).alias("analysis_filesize"),
        F.lit(None).cast("bigint").alias("views"),
    )


def selected(spark, sf):
    return manifest.large_enough(manifest.resources(listed_resources(spark, sf), excluded=["0"]))


@query(f"WITH {LISTED} SELECT * FROM kept")
def manifest_select(spark, sf):
    return selected(spark, sf).select("dataset_id", "id", "filename", "format", "checksum", "filesize")


@query(f"WITH {LISTED} SELECT id, checksum FROM kept WHERE checksum NOT IN (SELECT checksum FROM kept WHERE format = 'json')")
def manifest_incremental(spark, sf):
    every = selected(spark, sf).select("id", "checksum", "format")
    done = every.where("format = 'json'").select("checksum")
    return manifest.not_yet_ingested(every, done).drop("format")


@query("""
SELECT DISTINCT lang || '_' || source AS id FROM documents WHERE lang <> 'es' AND source <> 'src4'
""")
def tracked_datasets(spark, sf):
    datasets = table(spark, sf, "documents").select(
        F.concat_ws("_", "lang", "source").alias("id"),
        F.when(F.col("lang") == "es", True).alias("skip"),
        F.when(F.col("source") == "src4", "2024-01-01").alias("deleted_date"),
    )
    return manifest.tracked(datasets.distinct()).select("id")


def related(spark, sf):
    rows = number_versions(published(spark, sf)).withColumns(
        {"titulaire_nom": F.concat(F.lit("Supplier "), "titulaire_id"), "titulaire_distance": F.col("dureeMois")}
    )
    return relational.related_tables(rows)


ONE_VERSION = """one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid, modification_id ORDER BY "dateNotification" NULLS LAST, "datePublicationDonnees" NULLS LAST,
  "donneesActuelles" NULLS LAST, "dureeMois" NULLS LAST, montant NULLS LAST, "sourceDataset" NULLS LAST, "sourceFile" NULLS LAST) AS rn FROM numbered) WHERE rn = 1)"""


@query(f"""
WITH {NUMBERED}, {ONE_VERSION}
SELECT uid, "dateNotification", "datePublicationDonnees", montant, "dureeMois", "sourceDataset", "sourceFile", modification_id, "donneesActuelles" FROM one
""")
def normalised_contracts(spark, sf):
    return related(spark, sf)["marches"].df


@query(f"WITH {PUBLISHED} SELECT DISTINCT acheteur_id AS id FROM published")
def normalised_buyers(spark, sf):
    return related(spark, sf)["acheteurs"].df


@query(f"""
WITH {PUBLISHED} SELECT DISTINCT titulaire_id AS id, "titulaire_typeIdentifiant" AS "typeIdentifiant", 'Supplier ' || titulaire_id AS nom FROM published
""")
def normalised_companies(spark, sf):
    return related(spark, sf)["entreprises"].df


@query(f"""
WITH {NUMBERED} SELECT uid, modification_id, titulaire_id, "titulaire_typeIdentifiant", "dureeMois" AS titulaire_distance FROM numbered
""")
def normalised_contract_holders(spark, sf):
    return related(spark, sf)["marches_titulaires"].df


@query(f"WITH {NUMBERED} SELECT DISTINCT uid, modification_id, acheteur_id FROM numbered")
def normalised_contract_buyers(spark, sf):
    return related(spark, sf)["marches_acheteurs"].df


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def key_violations(spark, sf):
    return dedup.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT * FROM (VALUES ('uid', 'Identifiant unique', 'string', 'string', 0), ('montant', 'Montant attribué', 'number', 'number', 15000),
  ('dateNotification', 'Date notification', 'date', 'date', 15000)) AS t(name, title, type, actual_type, n0)
""".replace(", 0)", ", (SELECT count(*) FROM orders))").replace("15000", "(SELECT count(*) FROM orders)").replace("n0", "n_filled"))
def schema_contract(spark, sf):
    """Declared and actual types of the columns of a table, with the number of values each holds."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("uid"),
        F.col("o_totalprice").alias("montant"),
        F.to_date("o_orderdate").alias("dateNotification"),
        F.col("o_custkey").alias("unexpected"),
    )
    filled = orders.agg(*[F.count(c).alias(c) for c in orders.columns]).unpivot([], orders.columns, "name", "n_filled")
    described = contract.described(orders, contract.base_contract(orders)).where(F.col("actual_type").isNotNull())
    return described.join(filled, "name").drop("position")
