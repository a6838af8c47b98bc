"""Nested documents: written from the given tables to the shared folder, then read back as a sender's file would be.

One file is written per task of the writing job, so files and work grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from adjudica.catalogue.registry import AS_OF, query, table
from adjudica.functions import nested, text
from adjudica.plans import nightly
from adjudica.session import materialise, work_path
from adjudica.sources import documents, elements, large_json, manifest, pages, repair

KEYS_PER_DOCUMENT = 20_000


def _holder(kind: str, column):
    return F.struct(F.lit(kind).alias("typeIdentifiant"), column.cast("string").alias("id"))


def _orders_with_lines(spark, sf):
    """Orders as records; the line that ships last stands for their one amendment."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.struct("l_shipdate", "l_partkey", "l_extendedprice")).alias("line")
    )
    return table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def _record(layout: str):
    """A record of one layout as a struct, with its amendment in a shape that depends on the order."""
    buyer, priority = F.col("o_custkey"), F.col("o_orderpriority")
    holders = F.array(_holder("SIRET", buyer), _holder("TVA", F.col("o_orderkey")))
    amendment = F.struct(
        F.date_format("line.l_shipdate", "yyyy-MM-dd").alias("dateNotificationModification"),
        F.col("line.l_extendedprice").alias("montant"),
    )
    some = F.col("line").isNotNull()
    as_list = F.to_json(F.array(F.struct(amendment.alias("modification"))))
    as_object = F.to_json(F.struct(amendment.alias("modification")))
    modifications = (
        F.when(~some, F.lit("null")).when(priority == "1-URGENT", as_list).when(priority == "2-HIGH", as_object)
        .when(priority == "3-MEDIUM", F.to_json(amendment)).when(priority == "5-LOW", F.lit('""'))
        .otherwise(F.to_json(F.array(amendment)))
    )
    if layout == "2019":
        titulaires = F.when(priority == "2-HIGH", F.to_json(F.array(F.array(F.array(holders))))).otherwise(F.to_json(holders))
        owner = F.concat(F.lit('"acheteur.id":"b'), buyer.cast("string"), F.lit('"'))
        social = F.to_json(F.array("o_orderstatus", "o_orderpriority"))
    else:
        titulaires = F.to_json(F.transform(holders, lambda h: F.struct(h.alias("titulaire"))))
        owner = F.concat(F.lit('"acheteur":{"id":"b'), buyer.cast("string"), F.lit('"}'))
        social = F.concat(F.lit('{"considerationSociale":'), F.to_json(F.array("o_orderstatus", "o_orderpriority")), F.lit("}"))
    return F.concat(
        F.lit('{"id":"'), F.col("o_orderkey").cast("string"), F.lit('",'), owner,
        F.lit(',"montant":'), F.col("o_totalprice").cast("string"),
        F.lit(',"dateNotification":"'), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit('","ignored":{"a":[1]},"considerationsSociales":'), social,
        F.lit(',"titulaires":'), titulaires, F.lit(',"modifications":'), modifications, F.lit("}"),
    )


FLAT_SQL = """
WITH l AS (SELECT l_orderkey, max(struct_pack(d := l_shipdate, p := l_partkey, e := l_extendedprice)) AS line FROM lineitem GROUP BY 1),
o AS (SELECT orders.*, line FROM orders LEFT JOIN l ON o_orderkey = l_orderkey),
r AS (SELECT *, NULL AS d, NULL AS e FROM o UNION ALL
  SELECT *, strftime(line.d, '%Y-%m-%d'), line.e FROM o WHERE line IS NOT NULL AND o_orderpriority <> '5-LOW')
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'b' || CAST(o_custkey AS VARCHAR) AS buyer, CAST(o_totalprice AS DOUBLE) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS awarded,
  o_orderstatus || ', ' || o_orderpriority AS social, 'SIRET:' || CAST(o_custkey AS VARCHAR) || ',TVA:' || CAST(o_orderkey AS VARCHAR) AS holders, d AS amended, e AS amended_amount FROM r
"""


def _flat_view(rows, layout: str):
    social = "considerationsSociales" + ("_considerationSociale" if layout == "2022" else "")
    buyer = F.coalesce("acheteur_id", F.col("`acheteur.id`")) if layout == "2019" else F.col("acheteur_id")
    holders = F.transform(
        nested.tidy_holders(F.col("titulaires"), layout),
        lambda h: F.concat(h["titulaire_typeIdentifiant"], F.lit(":"), h["titulaire_id"]),
    )
    return rows.select(
        "id",
        buyer.alias("buyer"),
        F.col("montant").try_cast("double").alias("amount"),
        F.col("dateNotification").alias("awarded"),
        text_list(social).alias("social"),
        F.array_join(holders, ",").alias("holders"),
        F.col("modification_dateNotificationModification").alias("amended"),
        F.col("modification_montant").try_cast("double").alias("amended_amount"),
    )


def text_list(name: str):
    return nested.list_text(F.col(name))


def _write_documents(spark, rows, name: str, opening: str, closing: str, separator: str = ",") -> str:
    """Documents from rows with ``o_orderkey`` and ``member``; each is one file."""
    # A document covers a fixed range of order keys, so the list of its members is bounded.
    numbered = rows.select(F.floor(F.col("o_orderkey") / KEYS_PER_DOCUMENT).alias("document"), "member")
    whole = numbered.groupBy("document").agg(
        F.concat(F.lit(opening), F.array_join(F.collect_list("member"), separator), F.lit(closing)).alias("value")
    )
    path = work_path(spark, name)
    whole.select("value", "document").repartition("document").write.partitionBy("document").text(path)
    return path


def _read_documents(spark, sf, layout: str):
    opening, closing = ('{"marches": [', ",null]}") if layout == "2019" else ('{"marches": {"marche": [', ",null]}}")
    members = _orders_with_lines(spark, sf).select("o_orderkey", _record(layout).alias("member"))
    path = _write_documents(spark, members, f"documents-{layout}", "\ufeff" + opening, closing)
    payloads = documents.read_payloads(spark, path)
    good = materialise(repair.checked(payloads), "payloads").where("readable").drop("readable")
    return _flat_view(documents.flatten(documents.records(good, layout), layout), layout)


@query(FLAT_SQL)
def json_layout_2019(spark, sf):
    return _read_documents(spark, sf, "2019")


@query(FLAT_SQL)
def json_layout_2022(spark, sf):
    return _read_documents(spark, sf, "2022")


@query(FLAT_SQL)
def json_in_blocks(spark, sf):
    """Documents read the way of those that are too large for one text: in pieces that many tasks share."""
    members = _orders_with_lines(spark, sf).select("o_orderkey", _record("2022").alias("member"))
    path = _write_documents(spark, members, "documents-blocks", '\ufeff{"meta": {"marche": [{"id": "}"}]}, "marches": {"version": {}, "marche": [', "]}}")
    small, files = large_json.read_large_documents(spark, path)
    good = small.where("readable").drop("readable").join(files.select("path", "layout"), "path")
    return _flat_view(documents.flatten(documents.records(good, "2022"), "2022"), "2022")


DOCUMENTS_PER_RESOURCE = 20


@query(f"""
SELECT 'r' || CAST(n AS VARCHAR) AS id, CASE n % 5 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'no records' WHEN 3 THEN 'missing' ELSE 'taken' END AS outcome
FROM (SELECT DISTINCT doc_id // {DOCUMENTS_PER_RESOURCE} AS n FROM documents)
""")
def ingest_outcomes(spark, sf):
    """Resources that are sound, cut off, without records or not there: each is taken or refused for its own reason."""
    number = F.floor(F.col("doc_id") / DOCUMENTS_PER_RESOURCE)
    record = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("nature"), F.col("text").alias("objet")))
    lists = table(spark, sf, "documents").groupBy(number.alias("n")).agg(F.array_join(F.collect_list(record), ",").alias("records"))
    kind = F.col("n") % 5
    layout_2022 = F.concat(F.lit('{"meta":{"marches":["x"]},"marches":{"version":"2","marche":['), "records", F.lit("]}}"))
    whole = (
        F.when(kind == 1, F.concat(F.lit('{"marches":['), "records"))
        .when(kind == 2, F.concat(F.lit('{"contracts":['), "records", F.lit("]}")))
        .when(kind == 4, F.concat(F.lit('{"marches":['), "records", F.lit("]}")))
        .otherwise(layout_2022)
    )
    lists = materialise(lists.select("n", whole.alias("value")), "lists")
    path = work_path(spark, "resources")
    lists.where(kind != 3).repartition("n").write.partitionBy("n").text(path)
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    there = there.select(F.regexp_extract("path", r"/n=(\d+)/", 1).alias("n"), F.col("path").alias("url"))
    gone = lists.where(kind == 3).select(F.col("n").cast("string").alias("n"), F.concat(F.lit(f"{path}/absent-"), F.col("n").cast("string")).alias("url"))
    listed = there.unionByName(gone).select(
        F.lit("d").alias("dataset_id"), F.lit("code").alias("dataset_code"), F.concat(F.lit("r"), "n").alias("id"), "url",
        F.lit("json").alias("format"), F.concat(F.lit("sum-"), "n").alias("checksum"), F.lit(900).cast("bigint").alias("filesize"),
    )
    result = nightly.ingest(spark, materialise(listed, "listed"), None, work_path(spark, "clean"), AS_OF)
    return result.taken.select("id", F.lit("taken").alias("outcome")).unionByName(result.refused.select("id", F.col("reason").alias("outcome")))


ORDERS_PER_RESOURCE = 500


def _listing(files, run: int):
    """The list of resources of one run; a replaced file has another checksum."""
    state = F.when((F.col("n") % 3 == 0) & (F.lit(run) == 2), "new").otherwise("old")
    return files.where((F.col("state") == state) & ((F.col("n") % 3 != 1) | (F.lit(run) == 1))).select(
        F.lit("d").alias("dataset_id"), F.lit("code").alias("dataset_code"), F.concat(F.lit("r"), F.col("n").cast("string")).alias("id"), "url",
        F.lit("json").alias("format"), F.concat("state", F.lit("-"), F.col("n").cast("string")).alias("checksum"), F.lit(900).cast("bigint").alias("filesize"),
    )


@query(f"""
SELECT 'b' || CAST(o_custkey AS VARCHAR) || CAST(o_orderkey AS VARCHAR) AS uid, o_totalprice + CASE WHEN o_orderkey // {ORDERS_PER_RESOURCE} % 3 = 0 THEN 1 ELSE 0 END AS amount
FROM orders WHERE CASE o_orderkey // {ORDERS_PER_RESOURCE} % 3 WHEN 0 THEN o_orderkey % 2 = 0 WHEN 1 THEN false ELSE true END
""")
def superseded_resources(spark, sf):
    """Two nightly runs: of the resources of the first, one in three is corrected and shortened, one withdrawn, one unchanged."""
    number = F.floor(F.col("o_orderkey") / ORDERS_PER_RESOURCE)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", number.alias("n"))
    newer = orders.where("n % 3 = 0 and o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    both = orders.withColumn("state", F.lit("old")).unionByName(newer.withColumn("state", F.lit("new")))
    record = F.concat(
        F.lit('{"id":"'), F.col("o_orderkey").cast("string"), F.lit('","acheteur":{"id":"b'), F.col("o_custkey").cast("string"),
        F.lit('"},"dateNotification":"1995-01-01","montant":'), F.col("o_totalprice").cast("string"),
        F.lit(',"titulaires":[{"titulaire":{"typeIdentifiant":"TVA","id":"x"}}]}'),
    )
    # A resource covers a fixed range of order keys, so its list of records is bounded.
    lists = both.select("state", "n", record.alias("record")).groupBy("state", "n").agg(F.array_join(F.collect_list("record"), ",").alias("records"))
    whole = F.concat(F.lit('{"marches":{"marche":['), "records", F.lit("]}}"))
    path, out = work_path(spark, "states"), work_path(spark, "clean")
    lists.select("state", "n", whole.alias("value")).repartition("state", "n").write.partitionBy("state", "n").text(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    files = files.select(F.regexp_extract("path", r"/state=(\w+)/", 1).alias("state"), F.regexp_extract("path", r"/n=(\d+)/", 1).cast("int").alias("n"), F.col("path").alias("url"))
    files, done = materialise(files, "files"), None
    for run in (1, 2):
        listed = _listing(files, run)
        taken = nightly.ingest(spark, listed, done, out, AS_OF).taken
        done = materialise(taken.select("dataset_id", "id", "checksum"), "done")
    rows = manifest.only_current(spark.read.parquet(out), listed)
    return rows.select("uid", F.col("montant").alias("amount"))


@query(FLAT_SQL)
def json_lines(spark, sf):
    path = work_path(spark, "lines")
    _orders_with_lines(spark, sf).select(_record("2022").alias("value")).write.text(path)
    return _flat_view(documents.flatten(documents.read_record_lines(spark, path), "2022"), "2022")


def _xml_element(name: str, value):
    return F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))


@query(FLAT_SQL)
def xml_layout(spark, sf):
    order = F.col("o_orderkey")
    holder = F.concat(
        F.lit("<titulaires><titulaire><typeIdentifiant>SIRET</typeIdentifiant>"), _xml_element("id", F.col("o_custkey")),
        F.lit("</titulaire><titulaire><typeIdentifiant>TVA</typeIdentifiant>"), _xml_element("id", order), F.lit("</titulaire></titulaires>"),
    )
    amendment = F.when(
        F.col("line").isNotNull() & (F.col("o_orderpriority") != "5-LOW"),
        F.concat(
            F.lit("<modifications><modification>"),
            _xml_element("dateNotificationModification", F.date_format("line.l_shipdate", "yyyy-MM-dd")),
            _xml_element("montant", F.col("line.l_extendedprice")),
            F.lit("</modification></modifications>"),
        ),
    ).otherwise("")
    social = F.concat(
        F.lit("<considerationsSociales>"), _xml_element("considerationSociale", F.col("o_orderstatus")),
        _xml_element("considerationSociale", F.col("o_orderpriority")), F.lit("</considerationsSociales>"),
    )
    element = F.concat(
        F.lit("<marche>"), _xml_element("id", order), F.lit("<acheteur><id>b"), F.col("o_custkey").cast("string"), F.lit("</id></acheteur>"),
        _xml_element("montant", F.col("o_totalprice")), _xml_element("dateNotification", F.date_format("o_orderdate", "yyyy-MM-dd")),
        social, holder, amendment, F.lit("</marche>"),
    )
    members = _orders_with_lines(spark, sf).select("o_orderkey", element.alias("member"))
    path = _write_documents(spark, members, "xml", '<?xml version="1.0" encoding="ISO-8859-15"?><marches>', "</marches>", "")
    return _flat_view(documents.flatten_xml(elements.read_xml_records(spark, path)), "2022")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS id, CASE doc_id % 7 WHEN 3 THEN 'rejected' WHEN 5 THEN 'cut' ELSE 'read' END AS verdict, CASE WHEN doc_id % 7 NOT IN (3, 5) THEN length(trim(regexp_replace("text", '[^A-Za-zÀ-ÿ ]', '', 'g'), ' ')) END AS n FROM documents
""")
def xml_recovery(spark, sf):
    """Broken elements, and elements without an end, between sound ones: all others are read, those are rejects."""
    kind = F.col("doc_id") % 7
    body = F.regexp_replace("text", "[^A-Za-zÀ-ÿ ]", "")
    element = F.concat(
        F.lit("<marche><id>"), F.col("doc_id").cast("string"), F.lit("</id><objet>"), body,
        F.when(kind == 3, "</nature></marche>").when(kind == 5, "</objet>").otherwise("</objet></marche>"),
    )
    docs = table(spark, sf, "documents").select(F.floor(F.col("doc_id") / 500).alias("document"), element.alias("member"), "doc_id")
    # A document holds a fixed range of ids, and ends with an element that has no end in it only where a file is cut.
    whole = docs.groupBy("document").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "member"))), lambda m: m["member"]), "\n").alias("members"))
    path = work_path(spark, "broken")
    opened = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><marches>'), "members", F.lit("</marches>"))
    whole.select(opened.alias("value"), "document").repartition("document").write.partitionBy("document").text(path)
    found = elements.judged(elements.read_elements(spark, path)[0])
    bad = F.col(elements.REJECTED)
    number = F.coalesce("id", F.regexp_extract(bad, r"<id>(\d+)</id>", 1))
    return found.select(
        number.alias("id"), F.when(bad.isNull(), "read").when(bad.endswith("</marche>"), "rejected").otherwise("cut").alias("verdict"),
        F.when(bad.isNull(), F.char_length(F.coalesce("objet", F.lit("")))).cast("long").alias("n"),
    )


@query("""
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value FROM events
""")
def props_json(spark, sf):
    events = table(spark, sf, "events")
    parsed = events.withColumn("p", F.from_json("props", "k string, absent string"))
    return parsed.select("event_id", "event_type", F.col("p.k").try_cast("int").alias("k"), "value")


@query("""
SELECT doc_id, CASE WHEN lang = 'fr' THEN 'fixed' WHEN lang = 'de' THEN 'lost' ELSE 'fine' END AS outcome, CASE WHEN lang <> 'de' THEN length(text) END AS n FROM documents
""")
def payload_repair(spark, sf):
    """Titles with bare quotation marks, NaN and byte order marks are mended; broken payloads stay out."""
    body = F.regexp_replace("text", r'[\\"\x00-\x1f]', "_")
    title = F.when(F.col("lang") == "fr", F.concat(F.lit('a "b" '), body)).otherwise(body)
    payload = F.concat(
        F.lit('\ufeff{"objet":"'), title, F.lit('","x":NaN,"doc_id":'), F.col("doc_id").cast("string"),
        F.when(F.col("lang") == "de", "").otherwise("}"),
    )
    rows = table(spark, sf, "documents").select("doc_id", "lang", "text").select("doc_id", payload.alias("payload"))
    unmended = rows.withColumn("before", repair.json_text(F.col("payload")))
    checked = repair.checked(unmended).withColumn("changed", F.col("payload") != F.col("before"))
    title = F.from_json("payload", "objet string")["objet"]
    return checked.select(
        "doc_id",
        F.when(~F.col("readable"), "lost").when(F.col("changed"), "fixed").otherwise("fine").alias("outcome"),
        F.when(F.col("readable"), F.length(title) - F.when(F.col("changed"), 6).otherwise(0)).cast("bigint").alias("n"),
    )


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag || l_linestatus AS shape FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS amount FROM l WHERE shape <> 'NF'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 1 FROM l WHERE shape IN ('AF', 'RF')
""")
def amendment_shapes(spark, sf):
    """Lists, wrapped lists, bare objects, wrapped objects and texts of amendments."""
    def item(value):
        return F.struct(value.alias("montant"))

    one, two = item(F.col("l_quantity")), item(F.col("l_quantity") + 1)
    shape = F.concat("l_returnflag", "l_linestatus")
    raw = (
        F.when(shape == "AF", F.to_json(F.array(one, two)))
        .when(shape == "RF", F.to_json(F.struct(F.array(one, two).alias("modification"))))
        .when(shape == "AO", F.to_json(one))
        .when(shape == "RO", F.to_json(F.struct(one.alias("modification"))))
        .when(shape == "NO", F.to_json(F.array(F.struct(one.alias("modification")))))
        .otherwise('"none"')
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem").select(*keys, "l_quantity", "l_returnflag", "l_linestatus")
    rows = lines.select(*keys, F.explode(nested.amendments(raw)).alias("a"))
    return rows.select(*keys, F.col("a.montant").try_cast("double").alias("amount"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'SIRET:' || CAST(l_suppkey AS VARCHAR) END AS holders FROM lineitem
""")
def nested_holders(spark, sf):
    """Holder lists nested one to four times, and a text in place of a list."""
    holders = F.array(_holder("SIRET", F.col("l_suppkey")))
    twice = F.array(holders)
    raw = (
        F.when(F.col("l_returnflag") == "N", '"unknown"')
        .when(F.col("l_linestatus") == "O", F.to_json(holders))
        .when(F.col("l_quantity") > 25, F.to_json(twice))
        .otherwise(F.to_json(F.array(F.array(twice))))
    )
    tidy = nested.tidy_holders(nested.parse_holders(raw, "2019"), "2019")
    shown = F.array_join(
        F.transform(tidy, lambda h: F.concat(h["titulaire_typeIdentifiant"], F.lit(":"), h["titulaire_id"])), ","
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem").select(*keys, "l_quantity", "l_returnflag", "l_linestatus")
    return lines.select(*keys, shown.alias("holders"))


@query("""
SELECT page_id, url, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages
""")
def page_links(spark, sf):
    return pages.all_links(table(spark, sf, "pages").select("page_id", "url", "html"))


@query("""
WITH p AS (SELECT page_id, replace(html, '<a href="/the', '<a title="Télécharger au format Json" class="x" href="/the') AS html FROM pages)
SELECT page_id, 'https://site.example' || unnest(regexp_extract_all(html, '<a title="Télécharger au format Json" class="x" href="([^"]*)"', 1)) AS link FROM p
""")
def titled_page_links(spark, sf):
    marked = F.replace(
        "html", F.lit('<a href="/the'), F.lit('<a title="Télécharger au format Json" class="x" href="/the')
    )
    rows = table(spark, sf, "pages").select("page_id", marked.alias("html"))
    return pages.titled_links(rows, site="https://site.example")


@query("""
SELECT CASE WHEN o_orderstatus = 'P' THEN 'https://k.example/xml/' ELSE 'https://k.example/json/' END || CAST(o_orderkey AS VARCHAR) AS url,
  CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m') END AS month FROM orders WHERE o_orderpriority <> '1-URGENT'
""")
def catalogue_urls(spark, sf):
    key = F.col("o_orderkey").cast("string")
    xml_link = F.concat(F.lit("<rdfs:ressource> https://k.example/xml/"), key, F.lit(" </rdfs:ressource>"))
    json_link = F.when(
        F.col("o_orderstatus") != "P", F.concat(F.lit("<rdfs:ressource>https://k.example/json/"), key, F.lit("</rdfs:ressource>"))
    ).otherwise("")
    links = F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(F.concat(xml_link, json_link))
    issued = F.when(
        F.col("o_orderpriority") != "5-LOW",
        F.concat(F.lit("<dct:issued>"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</dct:issued>")),
    ).otherwise("")
    entry = F.concat(F.lit("<dcat:dataset>"), issued, links, F.lit("</dcat:dataset>"))
    members = table(spark, sf, "orders").select("o_orderkey", entry.alias("member"))
    opening = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" '
    opening += 'xmlns:dcat="http://www.w3.org/ns/dcat#" xmlns:dct="http://purl.org/dc/terms/">'
    path = _write_documents(spark, members, "catalogue", opening, "</rdf:RDF>", "")
    return pages.catalogue_urls(pages.read_catalogue(spark, path))


@query("""
SELECT 'b' || CAST(o_custkey AS VARCHAR) || CAST(o_orderkey AS VARCHAR) AS uid, CAST(o_orderkey AS VARCHAR) AS id, 'b' || CAST(o_custkey AS VARCHAR) AS buyer,
  o_totalprice AS amount, o_orderpriority AS technique, o_orderstatus AS innovative, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS holder,
  'scrap_aife_dume' AS source FROM orders
""")
def record_mapping(spark, sf):
    key, buyer = F.col("o_orderkey").cast("string"), F.concat(F.lit("b"), F.col("o_custkey").cast("string"))
    no_text = F.lit(None).cast("string")
    plain = ["idAccordCadre", "codeCPV", "dateNotification", "attributionAvance", "tauxAvance", "origineUE", "origineFrance", "ccag",
             "offresRecues", "formePrix", "typeGroupementOperateurs", "sousTraitanceDeclaree", "modaliteExecution", "typePrix",
             "lieuExecutionCode", "lieuExecutionTypeCode"]
    inner = F.struct(
        buyer.alias("idAcheteur"), F.col("o_totalprice").alias("montant"), F.col("o_orderpriority").alias("technique"),
        F.col("o_orderstatus").alias("marchesInnovant"),
        F.when(F.col("o_orderstatus") != "P", F.array(_holder("SIRET", F.col("o_custkey")))).alias("titulaires"),
        *[no_text.alias(n) for n in plain],
    )
    rows = table(spark, sf, "orders").select(
        key.alias("id"), *[no_text.alias(n) for n in ("objet", "nature", "procedure", "dureeMois", "datePublicationDonnees", "modifications")],
        inner.alias("donneesMP"),
    )
    return pages.interface_records(rows).select(
        "uid", "id", F.col("acheteur.id").alias("buyer"), F.col("montant").alias("amount"),
        F.array_join("techniques.technique", ",").alias("technique"), F.col("marcheInnovant").alias("innovative"),
        F.array_join(F.transform("titulaires", lambda t: t["titulaire"]["id"]), ",").alias("holder"), "source",
    )
