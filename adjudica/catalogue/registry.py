"""Registration of queries, and the tables they share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
AS_OF = date(1999, 6, 30)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_id(name: str, width: int = 14):
    return F.lpad(F.col(name).cast("string"), width, "0")


def published(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines in the shape of published contract rows."""
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("uid"),
        as_id("o_custkey").alias("acheteur_id"),
        as_id("l_suppkey").alias("titulaire_id"),
        F.when(F.col("l_returnflag") == "R", "TVA").otherwise("SIRET").alias("titulaire_typeIdentifiant"),
        F.when(F.col("l_tax") != 0, F.to_date("l_shipdate")).alias("dateNotification"),
        F.to_date("o_orderdate").alias("datePublicationDonnees"),
        F.nullif("l_extendedprice", F.lit(0.0)).alias("montant"),
        F.col("l_quantity").cast("smallint").alias("dureeMois"),
        F.concat("l_returnflag", "l_linestatus").alias("sourceDataset"),
        F.concat(F.lit("file_"), F.col("l_linenumber").cast("string")).alias("sourceFile"),
    )


PUBLISHED = """published AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS uid,
         lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS acheteur_id,
         lpad(CAST(l_suppkey AS VARCHAR), 14, '0') AS titulaire_id,
         CASE WHEN l_returnflag = 'R' THEN 'TVA' ELSE 'SIRET' END AS "titulaire_typeIdentifiant",
         CASE WHEN l_tax <> 0 THEN CAST(l_shipdate AS DATE) END AS "dateNotification",
         CAST(o_orderdate AS DATE) AS "datePublicationDonnees",
         nullif(l_extendedprice, 0) AS montant,
         CAST(l_quantity AS SMALLINT) AS "dureeMois",
         l_returnflag || l_linestatus AS "sourceDataset",
         'file_' || CAST(l_linenumber AS VARCHAR) AS "sourceFile"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
# The same rows with version numbers; ``current_rows`` has one current row per record.
NUMBERED = (
    PUBLISHED
    + """, numbered0 AS (
  SELECT *, CASE WHEN "dateNotification" IS NOT NULL THEN CAST(dense_rank() OVER (
    PARTITION BY uid ORDER BY "dateNotification" NULLS LAST) - 1 AS SMALLINT) END AS modification_id
  FROM published), numbered AS (
  SELECT *, modification_id = max(modification_id) OVER (PARTITION BY uid) AS "donneesActuelles" FROM numbered0)"""
)
