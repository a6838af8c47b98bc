"""Joins, filters, column operators and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudica.catalogue.registry import query, table
from adjudica.operators import columns, counts, dedup, joins, sets


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_anti_join(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@query("""
SELECT doc_id, quality, origin FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY layer DESC) AS rn FROM (
    SELECT doc_id, CAST(NULL AS INTEGER) AS quality, 'document' AS origin, 0 AS layer FROM documents
    UNION ALL SELECT doc_id, quality, 'label', 1 FROM labels)) WHERE rn = 1
""")
def upsert_by_layer(spark, sf):
    known = table(spark, sf, "documents").select(
        "doc_id", F.lit(None).cast("int").alias("quality"), F.lit("document").alias("origin")
    )
    newer = table(spark, sf, "labels").select("doc_id", "quality", F.lit("label").alias("origin"))
    return dedup.keep_last_added([known, newer], ["doc_id"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name, p_name FROM lineitem
LEFT JOIN supplier ON CAST(substring(s_name, 10) AS BIGINT) = l_suppkey AND l_returnflag <> 'R'
LEFT JOIN part ON l_partkey = p_partkey
""")
def composite_left_join(spark, sf):
    suppliers = table(spark, sf, "supplier").select(
        "s_name", F.substring("s_name", 10, 9).cast("bigint").alias("l_suppkey"), F.lit(True).alias("by_site")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_returnflag") != "R").alias("by_site")
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    matched = lines.join(suppliers, ["l_suppkey", "by_site"], "left")
    return joins.left_on(matched, parts, [("l_partkey", "p_partkey")]).drop("by_site")


@query("""
SELECT o_orderkey, substring(c_name, 10) AS customer_number, c_mktsegment FROM orders
JOIN customer ON lpad(CAST(o_custkey AS VARCHAR), 9, '0') = substring(c_name, 10, 9)
""")
def inner_join_derived_key(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.substring("c_name", 10, 9).alias("customer_number"), "c_mktsegment"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("customer_number"))
    return orders.join(customers, "customer_number")


@query("""
WITH s AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1),
c AS (SELECT c_nationkey + 10 AS k, count(DISTINCT c_mktsegment) AS n FROM customer GROUP BY 1)
SELECT coalesce(s.k, c.k) AS nation_key, coalesce(s.n, 0) AS n_suppliers, coalesce(c.n, 0) AS n_segments
FROM s FULL JOIN c ON s.k = c.k
""")
def full_outer_counts(spark, sf):
    suppliers = counts.counted(
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation_key")), ["nation_key"], "n_suppliers"
    )
    customers = counts.distinct_per_group(
        table(spark, sf, "customer").withColumn("nation_key", F.col("c_nationkey") + 10),
        "nation_key",
        "c_mktsegment",
        "n_segments",
    )
    return suppliers.join(customers, "nation_key", "full").fillna(0, ["n_suppliers", "n_segments"])


@query("""
WITH a AS (SELECT DISTINCT l_orderkey FROM lineitem), b AS (SELECT DISTINCT o_orderkey * 2 AS o_orderkey FROM orders)
SELECT count(*) AS n_keys, count(o_orderkey) AS n_known, round(count(o_orderkey) / count(*) * 100, 2) AS pct_known
FROM a LEFT JOIN b ON l_orderkey = o_orderkey
""")
def key_coverage(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    orders = table(spark, sf, "orders").select((F.col("o_orderkey") * 2).alias("order_key"))
    return joins.key_coverage(lines, orders, "order_key")


@query("SELECT DISTINCT CAST(k AS VARCHAR) AS party FROM (SELECT l_partkey AS k FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem)")
def stacked_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    return sets.stacked_values(lines, ["l_partkey", "l_suppkey"], "party").distinct()


@query("""
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'MACHINERY'), CASE c_name WHEN 'Customer#000000001' THEN 'first'
  WHEN 'Customer#000000005' THEN 'fifth' END) AS segment, c_name FROM customer
""")
def literal_fallback(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"), "c_name"
    )
    known = {"Customer#000000001": "first", "Customer#000000005": "fifth"}
    return joins.filled_from_literals(customers, "c_name", "segment", known)


@query("""
SELECT l_orderkey, l_linenumber, nullif(l_tax, 0) AS tax, nullif(l_discount, 0) AS discount, nullif(o_orderstatus, 'P') AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus <> 'P' AND (l_tax <> 0 OR l_discount <> 0) AND l_quantity <> 1
""")
def null_key_filters(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.replace("o_orderstatus", F.lit("P"), F.lit("")).alias("status")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_quantity", F.lit(1.0)).alias("quantity"),
    )
    rows = lines.join(orders, "l_orderkey").where(columns.any_filled(["tax", "discount"]))
    return columns.require_keys(rows.dropna(subset=["quantity"]), "status").drop("quantity")


@query("""
SELECT o_orderpriority AS priority, o_orderkey AS "order_key", o_orderstatus AS "order_status", o_totalprice AS extra_totalprice,
  'orders' AS origin, o_custkey AS "order_custkey" FROM orders
""")
def contract_order(spark, sf):
    orders = table(spark, sf, "orders")
    named = columns.add_prefix(columns.strip_prefix(orders.drop("o_orderdate", "absent"), "o_"), ["totalprice"], "extra_")
    named = named.withColumnsRenamed({"orderpriority": "priority", "orderkey": "order_key", "orderstatus": "order_status", "custkey": "order_custkey"})
    ordered = columns.in_contract_order(named.withColumn("origin", F.lit("orders")), ["order_key", "priority"])
    return columns.published_order(ordered, "order_key", "priority")


@query("""
SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#1'), p_type) AS label,
  CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small' WHEN p_size > 40 THEN 'large' ELSE 'medium' END AS size_class FROM part
""")
def conditional_columns(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.coalesce(F.nullif("p_brand", F.lit("Brand#1")), F.col("p_type")).alias("label"),
        F.when(size.between(1, 10), "small").when(size > 40, "large").otherwise("medium").alias("size_class"),
    )
