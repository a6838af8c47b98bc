"""Versions, deduplication and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudica.catalogue.registry import NUMBERED, published, query, table
from adjudica.operators import dedup, scores, versions
from adjudica.operators.sets import stack, stack_diagonal
from adjudica.plans.consolidate import consolidate_tables
from adjudica.plans.stats import current_records

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_tax <> 0 THEN CAST(l_shipdate AS DATE) END AS shipped FROM lineitem),
r AS (SELECT *, CASE WHEN shipped IS NOT NULL THEN CAST(dense_rank() OVER (
    PARTITION BY l_orderkey ORDER BY shipped NULLS LAST) - 1 AS SMALLINT) END AS version_number FROM l)
SELECT *, version_number = max(version_number) OVER (PARTITION BY l_orderkey) AS is_current FROM r
""")
def version_numbering(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        *LINE_KEYS, F.when(F.col("l_tax") != 0, F.to_date("l_shipdate")).alias("shipped")
    )
    return versions.number_versions(lines, "l_orderkey", "shipped", "version_number", "is_current")


@query("""
WITH base AS (SELECT CAST(o_orderkey AS VARCHAR) AS uid, strftime(o_orderdate, '%Y-%m-%d') AS awarded,
    strftime(o_orderdate, '%Y-%m-%d') AS published, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS amount,
    CAST(NULL AS DOUBLE) AS months, o_custkey, o_orderpriority FROM orders),
v AS (SELECT uid, awarded, published, amount, months, 0 AS amended FROM base
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), strftime(l_shipdate, '%Y-%m-%d'), CAST(NULL AS VARCHAR),
    nullif(CASE WHEN l_tax <> 0 THEN l_extendedprice END, 0), CASE WHEN l_discount <> 0 THEN l_quantity END, 1 FROM lineitem),
f AS (SELECT uid, awarded, published, last_value(amount IGNORE NULLS) OVER w AS amount,
    last_value(months IGNORE NULLS) OVER w AS months FROM v
  WINDOW w AS (PARTITION BY uid ORDER BY awarded NULLS FIRST, amended, published NULLS FIRST, amount NULLS FIRST,
    months NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT f.*, base.o_custkey, base.o_orderpriority FROM f JOIN base USING (uid)
""")
def apply_versions_ffill(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("modification_awardedModification"),
        F.nullif(F.when(F.col("l_tax") != 0, F.col("l_extendedprice")), F.lit(0.0)).alias("modification_amount"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity")).alias("modification_months"),
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("uid"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("awarded"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("amount"),
        F.lit(None).cast("double").alias("months"),
        "o_custkey",
        "o_orderpriority",
    )
    rows = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("o_orderkey", "l_orderkey")
    return versions.apply_versions(
        rows, ["uid"], changing=["awarded", "published", "amount", "months"], carry=["amount", "months"]
    )


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS shipped,
    nullif(l_tax, 0) AS tax, nullif(l_discount, 0) AS discount FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, shipped, last_value(tax IGNORE NULLS) OVER w AS tax,
    last_value(discount IGNORE NULLS) OVER w AS discount FROM l
WINDOW w AS (PARTITION BY l_orderkey ORDER BY shipped, l_linenumber, l_partkey, l_suppkey, tax NULLS FIRST,
    discount NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def carry_forward(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        *LINE_KEYS,
        F.to_date("l_shipdate").alias("shipped"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
    )
    order = ["shipped", "l_linenumber", "l_partkey", "l_suppkey"]
    return versions.forward_fill(lines, ["l_orderkey"], order, ["tax", "discount"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS shipped FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey) AS rn FROM lineitem WHERE l_linestatus = 'O') WHERE rn = 1
""")
def current_rows_dedup(spark, sf):
    lines = (
        table(spark, sf, "lineitem")
        .withColumn("open", F.col("l_linestatus") == "O")
        .where("open")
        .select(*LINE_KEYS, F.to_date("l_shipdate").alias("shipped"))
    )
    return dedup.keep_first(lines, ["l_orderkey", "l_linenumber"], [F.col("shipped").desc()])


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_returnflag, l_suppkey) AS rn FROM lineitem) WHERE rn = 1
""")
def consolidate_union(spark, sf):
    lines = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_returnflag")
    slices = [lines.where(F.col("l_returnflag") == flag) for flag in ("A", "N", "R")]
    return consolidate_tables(slices, ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey AS order_key, CAST(NULL AS VARCHAR) AS priority, l_quantity AS quantity, 'line' AS origin FROM lineitem
UNION ALL
SELECT o_orderkey, o_orderpriority, CAST(NULL AS DOUBLE), 'order' FROM orders
""")
def union_diagonal(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_quantity").alias("quantity"), F.lit("line").alias("origin")
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderpriority").alias("priority"), F.lit("order").alias("origin")
    )
    return stack_diagonal([lines, orders])


@query("""
SELECT 'supplier' AS kind, s_suppkey AS party_key, s_name AS party_name, s_nationkey AS nation_key FROM supplier
UNION ALL SELECT 'customer', c_custkey, c_name, c_nationkey FROM customer
""")
def append_renamed(spark, sf):
    from adjudica.operators.sets import append_as

    suppliers = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"),
        F.col("s_suppkey").alias("party_key"),
        F.col("s_name").alias("party_name"),
        F.col("s_nationkey").alias("nation_key"),
    )
    customers = table(spark, sf, "customer").withColumn("kind", F.lit("customer"))
    return append_as(
        suppliers, customers, {"party_key": "c_custkey", "party_name": "c_name", "nation_key": "c_nationkey"}
    )


@query("""
WITH base AS (SELECT l_orderkey AS uid, p_type AS cpv, upper(trim(p_brand)) AS act, 'N' || CAST(p_size // 10 AS VARCHAR) AS nom
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'O' AND p_type <> 'PROMO'),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY nom, act, cpv) AS rn FROM base) WHERE rn = 1),
n AS (SELECT nom, act, cpv, count(*) AS nb FROM one GROUP BY ALL),
s AS (SELECT *, nb / sum(nb) OVER (PARTITION BY nom, act) AS score FROM n),
r AS (SELECT *, dense_rank() OVER (PARTITION BY nom, act ORDER BY score DESC) AS rk FROM s)
SELECT nom AS activite_nomenclature, act AS activite_code, cpv, round(score, 9) AS score, CAST(rk AS INTEGER) AS rank,
  nb AS nb_marches FROM r WHERE rk <= 10
""")
def activity_product_scores(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.nullif("p_type", F.lit("PROMO")).alias("codeCPV"),
        F.concat(F.lit(" "), F.lower("p_brand"), F.lit(" ")).alias("activite_code"),
        F.concat(F.lit("n"), F.floor(F.col("p_size") / 10).cast("string")).alias("activite_nomenclature"),
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("uid"), "l_partkey", (F.col("l_linestatus") == "O").alias("donneesActuelles")
    )
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return scores.activity_product_scores(joined).withColumn("score", F.round("score", 9))


@query("""
WITH n AS (SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS nb_marches
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
s AS (SELECT *, nb_marches / sum(nb_marches) OVER (PARTITION BY segment) AS score FROM n),
r AS (SELECT *, dense_rank() OVER (PARTITION BY segment ORDER BY score DESC) AS rk FROM s)
SELECT segment, priority, nb_marches, round(score, 9) AS score, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= 3
""")
def top_ranks_per_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderpriority").alias("priority"))
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    pairs = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("segment", "priority")
    return scores.ranked_shares(pairs, "segment", "priority", top=3).withColumn("score", F.round("score", 9))


@query(f"""
WITH {NUMBERED}, one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY acheteur_id NULLS LAST,
  "dateNotification" NULLS LAST, "datePublicationDonnees" NULLS LAST, "dureeMois" NULLS LAST, modification_id NULLS LAST, montant NULLS LAST,
  "sourceDataset" NULLS LAST, "sourceFile" NULLS LAST, titulaire_id NULLS LAST, "titulaire_typeIdentifiant" NULLS LAST) AS rn
  FROM numbered WHERE "donneesActuelles") WHERE rn = 1)
SELECT uid, modification_id, "dateNotification" AS awarded, montant, titulaire_id FROM one
""")
def current_records_single(spark, sf):
    rows = versions.number_versions(published(spark, sf))
    return current_records(rows).select(
        "uid", "modification_id", F.col("dateNotification").alias("awarded"), "montant", "titulaire_id"
    )
