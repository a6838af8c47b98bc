"""Scalar functions and the cleaning chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudica.catalogue.registry import AS_OF, query, table
from adjudica.functions import nested, rules, text, typing
from adjudica.operators.columns import on_columns, text_columns
from adjudica.plans import cleaning


@query(r"""
SELECT p_partkey, regexp_replace(p_name || '. ' || p_brand || '/' || p_type, '[ ,\\./]', '_', 'g') AS tidy,
  CASE WHEN p_size > 10 THEN p_name || p_type END AS both_or_none,
  rpad(split_part(CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size AS VARCHAR), '-', 1), 8, '0') AS product_code,
  lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(3, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS padded,
  substring(p_name, 1, 4) AS head, upper(trim('  ' || p_name || chr(9), ' ' || chr(9))) AS shouted,
  CAST(length(p_name) AS INTEGER) AS name_length, starts_with(p_brand, 'Brand#1') AS brand_one FROM part
""")
def clean_ids(spark, sf):
    part = table(spark, sf, "part")
    name, kind, key = F.col("p_name"), F.col("p_type"), F.col("p_partkey").cast("string")
    return part.select(
        "p_partkey",
        text.tidy_id(F.concat(name, F.lit(". "), "p_brand", F.lit("/"), kind)).alias("tidy"),
        F.concat(name, F.when(F.col("p_size") > 10, kind)).alias("both_or_none"),
        text.product_code(F.concat(key, F.lit("-"), F.col("p_size").cast("string"))).alias("product_code"),
        text.pad_left(key, 3).alias("padded"),
        F.substring(name, 1, 4).alias("head"),
        F.upper(text.strip(F.concat(F.lit("  "), name, F.lit("\t")))).alias("shouted"),
        F.length(name).alias("name_length"),
        F.col("p_brand").startswith("Brand#1").alias("brand_one"),
    )


@query(r"""
SELECT doc_id, lang,
  regexp_replace(replace(text, ' the ', ' th''e '), '([\p{L}\p{N}_])''([\p{L}\p{N}_])', '\1’\2', 'g') AS apostrophes,
  replace(replace(text, 'Marche', 'Marché'), 'subsequent', 'subséquent') AS spelled,
  nullif(CASE WHEN source = 'src1' THEN '' ELSE source END, '') AS source_or_null,
  nullif(upper(CASE lang WHEN 'de' THEN 'nc' ELSE lang END), 'NC') AS lang_or_null,
  trim(regexp_replace(text, '\s+', ' ', 'g')) AS on_one_line
FROM documents
""")
def clean_text(spark, sf):
    documents = table(spark, sf, "documents")
    body = F.col("text")
    return documents.select(
        "doc_id",
        "lang",
        text.typographic_apostrophes(F.replace(body, F.lit(" the "), F.lit(" th'e "))).alias("apostrophes"),
        text.replace_words(body, text.NATURE_SPELLING).alias("spelled"),
        text.blank_to_null(F.when(F.col("source") == "src1", "").otherwise(F.col("source"))).alias("source_or_null"),
        text.not_communicated_to_null(
            F.upper(F.when(F.col("lang") == "de", "nc").otherwise(F.col("lang")))
        ).alias("lang_or_null"),
        text.one_line(body).alias("on_one_line"),
    )


@query("""
WITH o AS (SELECT o_orderkey, o_orderpriority AS p, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
t AS (SELECT o_orderkey, CASE p WHEN '1-URGENT' THEN '0002-11-30' WHEN '2-HIGH' THEN 'September, 16 2021 00:00:00'
  WHEN '3-MEDIUM' THEN d || '+02:00' WHEN '5-LOW' THEN '5021-02-18' ELSE d END AS raw FROM o)
SELECT o_orderkey, raw, CASE raw WHEN '0002-11-30' THEN '' WHEN 'September, 16 2021 00:00:00' THEN '2021-09-16'
  WHEN '5021-02-18' THEN '2021-02-18' ELSE split_part(raw, '+', 1) END AS repaired FROM t
""")
def date_repairs(spark, sf):
    day, priority = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority")
    raw = (
        F.when(priority == "1-URGENT", "0002-11-30")
        .when(priority == "2-HIGH", "September, 16 2021 00:00:00")
        .when(priority == "3-MEDIUM", F.concat(day, F.lit("+02:00")))
        .when(priority == "5-LOW", "5021-02-18")
        .otherwise(day)
    )
    rows = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"), raw.alias("dateNotification"))
    return cleaning.repair_dates(rows).withColumnRenamed("dateNotification", "repaired")


@query("""
WITH e AS (SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS d, user_id FROM events),
t AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'NC' ELSE CAST(value AS VARCHAR) END AS amount,
  CASE event_type WHEN 'click' THEN CAST(event_id * 100 AS VARCHAR) WHEN 'view' THEN '11.0' ELSE CAST(user_id AS VARCHAR) END AS months,
  CASE event_type WHEN 'signup' THEN substring(d, 1, 7) WHEN 'error' THEN d || 'T00:00' ELSE d END AS day,
  CASE event_type WHEN 'view' THEN 'Oui' WHEN 'click' THEN 'FALSE' WHEN 'signup' THEN '1' WHEN 'error' THEN 'non' ELSE 'x' END AS flag FROM e)
SELECT event_id, TRY_CAST(amount AS DOUBLE) AS amount, CASE WHEN months NOT LIKE '%.%' THEN TRY_CAST(months AS SMALLINT) END AS months,
  CASE WHEN CAST(try_strptime(day, '%Y-%m-%d') AS DATE) <= DATE '2024-01-15' THEN CAST(try_strptime(day, '%Y-%m-%d') AS DATE) END AS day,
  CASE WHEN lower(flag) IN ('true', '1', 'oui') THEN true WHEN lower(flag) IN ('false', '0', 'non') THEN false END AS flag FROM t
""")
def lenient_types(spark, sf):
    from datetime import date

    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    raw = table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", "NC").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(kind == "click", (F.col("event_id") * 100).cast("string"))
        .when(kind == "view", "11.0")
        .otherwise(F.col("user_id").cast("string"))
        .alias("months"),
        F.when(kind == "signup", F.substring(day, 1, 7))
        .when(kind == "error", F.concat(day, F.lit("T00:00")))
        .otherwise(day)
        .alias("day"),
        F.when(kind == "view", "Oui")
        .when(kind == "click", "FALSE")
        .when(kind == "signup", "1")
        .when(kind == "error", "non")
        .otherwise("x")
        .alias("flag"),
    )
    return raw.select(
        "event_id",
        typing.decimal_number(F.col("amount")).alias("amount"),
        typing.whole_number(F.col("months")).alias("months"),
        typing.not_after(typing.iso_date(F.col("day")), date(2024, 1, 15)).alias("day"),
        typing.flag_word(F.col("flag")).alias("flag"),
    )


@query("""
WITH o AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) || '000000000000.50'
  WHEN '2-HIGH' THEN '1.0E17' WHEN '3-MEDIUM' THEN 'on demand only' ELSE CAST(o_totalprice AS VARCHAR) END AS raw FROM orders)
SELECT o_orderkey, CASE WHEN length(split_part(raw, '.', 1)) > 11 OR coalesce(TRY_CAST(raw AS DOUBLE), 0) >= 100000000000
  THEN 12311111111 ELSE TRY_CAST(raw AS DOUBLE) END AS amount FROM o
""")
def amount_outliers(spark, sf):
    key, priority = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    raw = (
        F.when(priority == "1-URGENT", F.concat(key, F.lit("000000000000.50")))
        .when(priority == "2-HIGH", "1.0E17")
        .when(priority == "3-MEDIUM", "on demand only")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", typing.decimal_number(typing.plausible_amount(raw)).alias("amount")
    )


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS shipped,
    CAST(l_quantity AS INTEGER) - 5 AS months FROM lineitem),
r AS (SELECT *, round(date_diff('day', DATE '1999-06-30', shipped + CAST(trunc(months * 30.5) AS INTEGER)) / 30, 1) AS raw FROM l)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, shipped, CASE WHEN greatest(raw, 0) > months THEN CAST(months AS DOUBLE) ELSE greatest(raw, 0) END AS months_left FROM r
""")
def remaining_months(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.to_date("l_shipdate").alias("shipped"),
        (F.col("l_quantity").cast("int") - 5).alias("months"),
    )
    left = typing.remaining_months(F.col("shipped"), F.col("months"), AS_OF)
    return lines.withColumn("months_left", left).drop("months")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def year_of_award(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))


@query("""
SELECT p_partkey, CASE WHEN TRY_CAST(d AS TINYINT) = 45 THEN 'Travaux' WHEN TRY_CAST(d AS TINYINT) BETWEEN 1 AND 44 OR TRY_CAST(d AS TINYINT) = 48
  THEN 'Fournitures' WHEN TRY_CAST(d AS TINYINT) BETWEEN 50 AND 98 THEN 'Services' ELSE 'Non catégorisé' END AS type
FROM (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN 'ab' ELSE substring(CAST(p_partkey AS VARCHAR) || '99', 1, 2) END AS d FROM part)
""")
def contract_types(spark, sf):
    code = (
        F.when(F.col("p_type") == "PROMO", None)
        .when(F.col("p_type") == "SMALL", "abc")
        .otherwise(F.concat(F.col("p_partkey").cast("string"), F.lit("99")))
    )
    return table(spark, sf, "part").select("p_partkey", rules.contract_type(code).alias("type"))


@query("""
WITH c AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '217500016' WHEN 'FURNITURE' THEN '200076958' ELSE '111111111' END
    || CAST(c_custkey AS VARCHAR) AS id, CASE c_nationkey WHEN 1 THEN '7110' WHEN 2 THEN '4140' WHEN 3 THEN '7210' WHEN 4 THEN '7345'
    WHEN 5 THEN '7354' WHEN 6 THEN '7220' WHEN 7 THEN '7225' WHEN 8 THEN '7230' WHEN 9 THEN '7364' WHEN 10 THEN '7312' WHEN 11 THEN '4110'
    ELSE '5499' END AS form FROM customer)
SELECT c_custkey, CASE WHEN starts_with(id, '217500016') THEN 'Commune' WHEN starts_with(form, '71') THEN 'État' WHEN form IN ('4140', '4110', '4120') THEN 'EPIC'
  WHEN form IN ('7210', '7312') THEN 'Commune' WHEN starts_with(form, '734') THEN 'Groupement de communes' WHEN form IN ('7354', '7355') THEN 'Syndicat mixte'
  WHEN form = '7220' THEN 'Département' WHEN form = '7225' THEN 'Département outre-mer' WHEN form = '7230' THEN 'Région'
  WHEN form = '7364' THEN 'Établissement hospitalier' WHEN starts_with(id, '200076958') THEN 'Région' END AS category FROM c
""")
def category_rules(spark, sf):
    company = (
        F.when(F.col("c_mktsegment") == "BUILDING", "217500016")
        .when(F.col("c_mktsegment") == "FURNITURE", "200076958")
        .otherwise("111111111")
    )
    forms = {1: "7110", 2: "4140", 3: "7210", 4: "7345", 5: "7354", 6: "7220", 7: "7225", 8: "7230", 9: "7364", 10: "7312", 11: "4110"}
    form = rules.first_match([(F.col("c_nationkey") == k, F.lit(v)) for k, v in forms.items()])
    return table(spark, sf, "customer").select(
        "c_custkey",
        rules.buyer_category(
            F.coalesce(form, F.lit("5499")), F.concat(company, F.col("c_custkey").cast("string"))
        ).alias("category"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_type IS NOT NULL AND lower(p_type) <> split_part(p_name, ' ', 1) THEN split_part(p_name, ' ', 1) || ' (' || lower(p_type) || ')'
  ELSE split_part(p_name, ' ', 1) END AS shown FROM part
""")
def site_names(spark, sf):
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    return table(spark, sf, "part").select("p_partkey", rules.with_site_name(first, F.lower("p_type")).alias("shown"))


@query("""
SELECT s_suppkey, split_part(s_name || '__' || CAST(s_nationkey AS VARCHAR), '__', 1) AS left_part,
  split_part(s_name || '__' || CAST(s_nationkey AS VARCHAR), '__', 2) AS right_part FROM supplier
""")
def split_composite_key(spark, sf):
    both = table(spark, sf, "supplier").select(
        "s_suppkey", text.composite(F.col("s_name"), F.col("s_nationkey").cast("string")).alias("both")
    )
    return both.select(
        "s_suppkey",
        text.composite_part(F.col("both"), 0).alias("left_part"),
        text.composite_part(F.col("both"), 1).alias("right_part"),
    )


@query("""
SELECT c_custkey, trim(regexp_replace(coalesce(CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END, '') || ' '
  || coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(c_mktsegment) END, '') || '  ' || c_name, '\\s+', ' ', 'g')) AS q FROM customer
""".replace("\\\\", "\\"))
def address_lines(spark, sf):
    nation = F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string"))
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.lower("c_mktsegment"))
    return table(spark, sf, "customer").select(
        "c_custkey", text.address_line(nation, segment, F.concat(F.lit(" "), "c_name")).alias("q")
    )


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, CAST(l_suppkey AS VARCHAR) AS s, CAST(l_partkey AS VARCHAR) AS p FROM lineitem),
h AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s AS holder_id, 'SIRET' AS holder_type FROM l WHERE l_returnflag <> 'N'
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p, 'TVA' FROM l WHERE l_returnflag <> 'N' AND l_linestatus = 'F'
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULL, NULL FROM l WHERE l_returnflag = 'N')
SELECT * FROM h
""")
def holders_explode(spark, sf):
    paid = F.col("l_returnflag") != "N"

    def holder(id_, kind, when):
        inner = F.struct(F.when(when, kind).alias("typeIdentifiant"), F.when(when, id_).alias("id"))
        return F.struct(inner.alias("titulaire"))

    supplier = holder(F.col("l_suppkey").cast("string"), F.lit("SIRET"), paid)
    part = holder(F.col("l_partkey").cast("string"), F.lit("TVA"), paid & (F.col("l_linestatus") == "F"))
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array(supplier, part).alias("titulaires")
    )
    spread = cleaning.spread_holders(cleaning.clean_holders(rows, "2022"))
    return spread.withColumnsRenamed({"titulaire_id": "holder_id", "titulaire_typeIdentifiant": "holder_type"})


@query("""
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN p_name ELSE p_brand || ', ' || p_type END AS techniques,
  CASE WHEN p_size < 20 THEN 'Sans objet' ELSE p_name END AS ccag FROM part
""")
def list_columns(spark, sf):
    promo = F.col("p_type") == "PROMO"
    lists = table(spark, sf, "part").select(
        "p_partkey",
        F.when(promo, F.array().cast("array<string>")).otherwise(F.array("p_brand", F.lit(None), "p_type")).alias("techniques"),
        F.array("p_name").alias("techniques_technique"),
        F.when(F.col("p_size") < 20, "Pas de CCAG").otherwise(F.col("p_name")).alias("ccag"),
    )
    return cleaning.name_no_object(cleaning.flatten_lists(lists))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'none' ELSE o_orderstatus END AS status,
  coalesce(nullif(o_totalprice, 0), 0) AS price, coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END, 0) AS buyer FROM orders
""")
def filled_nulls(spark, sf):
    return (
        table(spark, sf, "orders")
        .select(
            "o_orderkey",
            F.nullif("o_orderstatus", F.lit("P")).alias("status"),
            F.nullif("o_totalprice", F.lit(0.0)).alias("price"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("buyer"),
        )
        .fillna("none", ["status"])
        .fillna(0, ["price", "buyer"])
    )


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_type, p_name, o_orderpriority AS pr, strftime(l_shipdate, '%Y-%m-%d') AS d,
    CAST(l_extendedprice AS VARCHAR) AS price, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty, l_returnflag AS rf, l_linestatus AS ls, o_custkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderpriority <> '2-HIGH')
SELECT 'b' || CAST(o_custkey AS VARCHAR) || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '_' || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) || '_' || d AS uid,
  CASE WHEN pr = '1-URGENT' THEN 12311111111 ELSE CAST(price AS DOUBLE) END AS montant,
  CASE WHEN ls = 'F' THEN CAST(qty AS SMALLINT) END AS "dureeMois",
  CASE WHEN CAST(d AS DATE) <= DATE '1999-06-30' THEN CAST(d AS DATE) END AS "dateNotification",
  CASE WHEN p_type = 'PROMO' THEN 'Marché subséquent' ELSE nullif(nullif(p_type, 'SMALL'), '') END AS nature,
  rpad(CAST(l_partkey AS VARCHAR), 8, '0') AS "codeCPV",
  CASE WHEN pr = '3-MEDIUM' THEN 'Sans objet' ELSE p_name END AS ccag,
  CASE WHEN rf <> 'N' THEN lpad(CAST(l_suppkey AS VARCHAR), 14, '9') END AS titulaire_id,
  CASE rf WHEN 'A' THEN 'SIRET' WHEN 'R' THEN 'TVA' END AS "titulaire_typeIdentifiant",
  CASE rf WHEN 'A' THEN true WHEN 'R' THEN false END AS "marcheInnovant",
  replace(p_name, ' ', '’') AS objet
FROM r
""")
def clean_chain(spark, sf):
    lines, orders, part = (table(spark, sf, n) for n in ("lineitem", "orders", "part"))
    priority, flag = F.col("o_orderpriority"), F.col("l_returnflag")

    def txt(name):
        return F.col(name).cast("string")

    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    holder = F.struct(
        F.when(flag == "R", "TVA").alias("typeIdentifiant"),
        F.when(flag != "N", F.concat(F.lit("  "), F.lpad(txt("l_suppkey"), 14, "9"))).alias("id"),
    )
    no_text = F.lit(None).cast("string")
    raw = (
        lines
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("/", txt("l_orderkey"), txt("l_linenumber"), txt("l_partkey"), txt("l_suppkey"), day).alias("id"),
            F.when(priority == "2-HIGH", "").otherwise(F.concat(F.lit("b"), txt("o_custkey"))).alias("acheteur_id"),
            F.lit("").alias("acheteur.id"),
            F.when(priority == "1-URGENT", "1000000000000.00").otherwise(txt("l_extendedprice")).alias("montant"),
            F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int").cast("string")).otherwise("NC").alias("dureeMois"),
            F.concat(day, F.when(flag == "A", "+01:00").otherwise("")).alias("dateNotification"),
            day.alias("datePublicationDonnees"),
            F.when(F.col("p_type") == "PROMO", "Marche subsequent")
            .when(F.col("p_type") == "SMALL", "")
            .otherwise(F.col("p_type"))
            .alias("nature"),
            F.concat(txt("l_partkey"), F.lit("-1")).alias("codeCPV"),
            F.when(priority == "3-MEDIUM", "Pas de CCAG").otherwise(F.col("p_name")).alias("ccag"),
            F.array(holder).alias("titulaires"),
            F.when(flag == "A", "oui").when(flag == "R", "FALSE").otherwise("?").alias("marcheInnovant"),
            F.replace("p_name", F.lit(" "), F.lit("'")).alias("objet"),
            no_text.alias("modification_montant"),
            F.lit(None).cast(nested.HOLDERS["2019"]).alias("modification_titulaires"),
        )
    )
    cleaned = cleaning.clean(raw, "2019", AS_OF)
    return cleaned.drop("id", "acheteur_id", "datePublicationDonnees")


@query("""
SELECT o_orderkey, nullif(nullif(o_orderstatus, 'P'), 'F') AS status, nullif(o_orderpriority, '5-LOW') AS priority FROM orders
""")
def blank_text_columns(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.replace(F.replace("o_orderstatus", F.lit("P"), F.lit("")), F.lit("F"), F.lit("NC")).alias("status"),
        F.replace("o_orderpriority", F.lit("5-LOW"), F.lit("NC")).alias("priority"),
    )
    blanked = on_columns(rows, text_columns(rows), text.blank_to_null)
    return on_columns(blanked, text_columns(blanked), text.not_communicated_to_null)
