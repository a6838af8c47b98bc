"""The whole chain: documents in, published tables and reports out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adjudica.operators.columns import in_contract_order, published_order, starting_with
from adjudica.operators.dedup import keep_first
from adjudica.operators.overlap import overlap_pairs
from adjudica.operators.scores import activity_product_scores
from adjudica.operators.sets import stack_diagonal
from adjudica.operators.versions import number_versions
from adjudica.plans import geocache
from adjudica.plans.cleaning import clean
from adjudica.plans.consolidate import ROW_KEY
from adjudica.plans.enrich import CACHE_DETAILS, derive, enrich
from adjudica.plans.stats import MERGED_SOURCE, contract_stats, current_records, source_stats
from adjudica.session import materialise
from adjudica.sinks import files
from adjudica.sinks.contract import base_contract, contract_document
from adjudica.sources import documents, elements, large_json, manifest, repair, tables
from adjudica.sources.layouts import CONTRACT_COLUMNS, LAYOUTS

# Address of a resource's page, and the data set that doubles its backslashes.
RESOURCE_PAGE = "https://www.data.gouv.fr/datasets/{}/#/resources/{}"
CARELESS_WITH_BACKSLASHES = ["68caf6b135f19236a4f37a32"]
CARELESS_ADDRESS = "/aws/"
PER_RESOURCE = ["checksum", "resource", "sourceFile"]
# Why a resource wasn't taken.
MISSING, UNREADABLE, WITHOUT_RECORDS = "missing", "unreadable", "no records"
LARGEST_TEXT = 2**31 - 1 - 2**20  # bytes that one text can hold


def resource_link(dataset: str = "dataset_id", resource: str = "id") -> Column:
    before, between, _ = RESOURCE_PAGE.split("{}")
    return F.concat(F.lit(before), F.col(dataset), F.lit(between), F.col(resource))


def _plain_path(c: Column) -> Column:
    """One spelling of a path, for the list of resources as for Spark's own file names."""
    return F.regexp_replace(F.coalesce(F.try_url_decode(c), c), "^file:/+", "/")


def _with_origin(files_or_records: DataFrame, resources: DataFrame) -> DataFrame:
    """Add the data set, page and checksum of the resource a path belongs to."""
    origins = resources.select(
        _plain_path(F.col("url")).alias("_path"),
        F.col("dataset_id").alias("_dataset_id"),
        F.col("dataset_code").alias("_dataset"),
        resource_link().alias("_link"),
        manifest.resource_key().alias("resource"),
        "checksum",
    )
    return files_or_records.withColumn("_path", _plain_path(F.col("path"))).drop("path").join(origins, "_path")


def _placed(records: DataFrame) -> DataFrame:
    """Name the data set and the resource on every record; a merged data set is told apart by sender."""
    sender = F.concat(F.col("_dataset"), F.lit("_"), F.col("source"))
    code = F.when(F.col("_dataset") == MERGED_SOURCE, sender).otherwise(F.col("_dataset"))
    return documents.with_source(records, code, F.col("_link")).drop("_dataset", "_link", "_dataset_id")


def _paths(resources: DataFrame, kind: str) -> list[str]:
    """Paths of the listed files: as many as the list has rows, as in any read of many files."""
    return [r[0] for r in resources.where(F.col("format") == kind).select("url").collect()]


def _read_json(
    spark: SparkSession, resources: DataFrame, paths: list[str], replacements: dict[str, str] | None
) -> tuple[dict[str, DataFrame], DataFrame]:
    # Origins join the documents, of which there are far fewer than records.
    payloads = _with_origin(documents.read_payloads(spark, *paths), resources)
    payload = F.col("payload")
    careless = F.col("_dataset_id").isin(*CARELESS_WITH_BACKSLASHES) | F.contains("_path", F.lit(CARELESS_ADDRESS))
    payloads = payloads.withColumn("payload", F.when(careless, repair.stray_backslashes(payload)).otherwise(payload))
    checked = repair.checked(payloads, replacements=replacements)
    layout = F.when(F.col("readable"), documents.layout_of(payload))
    # Written by layout, so that checking is done once and each layout reads its own documents only.
    stored = materialise(checked.withColumn("layout", layout), "payloads", ["layout"])
    flat = {n: _placed(documents.flatten(documents.records(stored.drop("readable"), n), n)) for n in LAYOUTS}
    reason = F.when(~F.col("readable"), UNREADABLE).when(F.col("layout").isNull(), WITHOUT_RECORDS)
    return flat, stored.select("_path", reason.alias("reason"))


def _read_large_json(spark: SparkSession, resources: DataFrame, paths: list[str]) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Flat records of JSON files that are too large for one text, what came of each, and records that can't be read."""
    small, files = large_json.read_large_documents(spark, *paths)
    stored = materialise(small.join(files.select("path", "layout"), "path"), "large-payloads", ["layout"])
    payloads = _with_origin(stored, resources)
    flat = {n: _placed(documents.flatten(documents.records(payloads.where("readable").drop("readable"), n), n)) for n in LAYOUTS}
    bad = stored.where("not readable")
    reason = F.when(~F.col("whole"), UNREADABLE).when(F.col("layout").isNull(), WITHOUT_RECORDS)
    counts = bad.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    outcomes = files.join(counts, "path", "left").select(
        _plain_path(F.col("path")).alias("_path"), reason.alias("reason"), F.coalesce("n", F.lit(0)).alias("n_rejects")
    )
    rejects = _with_origin(bad.select("path", F.col(documents.PAYLOAD).alias("record")), resources)
    return flat, outcomes, rejects.select(F.col("_dataset_id").alias("dataset_id"), "resource", "checksum", "record")


def _read_xml(spark: SparkSession, resources: DataFrame, paths: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Flat records of XML files, what came of each file, and the elements that can't be read."""
    found, files = elements.read_elements(spark, *paths)
    stored = materialise(elements.judged(found), "elements")
    bad = F.col(elements.REJECTED).isNotNull()
    good = stored.where(~bad).drop(elements.REJECTED)
    counts = stored.groupBy("path").agg(F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_bad"))
    reason = (
        F.when(~F.col("whole") | ((F.col("n_good") == 0) & (F.col("n_bad") > 0)), UNREADABLE)
        .when(F.coalesce("n_good", F.lit(0)) == 0, WITHOUT_RECORDS)
    )
    outcomes = files.join(counts, "path", "left").select(
        _plain_path(F.col("path")).alias("_path"), reason.alias("reason"), F.coalesce("n_bad", F.lit(0)).alias("n_rejects")
    )
    rejects = stored.where(bad).select("path", F.col(elements.REJECTED).alias("record"))
    rejects = _with_origin(rejects, resources).select(F.col("_dataset_id").alias("dataset_id"), "resource", "checksum", "record")
    return _placed(_with_origin(documents.flatten_xml(good), resources)), outcomes, rejects


@dataclass(frozen=True)
class Read:
    """Flat records per layout; what came of each file; records that can't be read, of files whose others are taken."""

    flat: dict[str, DataFrame]
    outcomes: DataFrame
    rejects: DataFrame


def read_resources(
    spark: SparkSession, resources: DataFrame, replacements: dict[str, str] | None = None, largest_text: int = LARGEST_TEXT
) -> Read:
    """Flat records from all listed files, written once.

    Outcomes have the columns ``_path``, ``reason`` and ``n_rejects``; the reason is null where the file was taken. A file that is
    missing, unreadable or without records is reported there and stops no other. Where only some records of an XML file, or
    of a JSON file of more than ``largest_text`` bytes, can't be read, they are rejects and the others are taken.
    """
    flat: dict[str, list[DataFrame]] = {name: [] for name in LAYOUTS}
    listed = {kind: _paths(resources, kind) for kind in ("json", "xml")}
    # One look at each listed file, as Spark takes before any read of many files.
    sizes = tables.file_sizes(spark, [p for paths in listed.values() for p in paths])
    refused = [(p, MISSING) for p, n in sizes.items() if n is None]
    # A file without a byte has no chunk that could be seen.
    refused += [(p, WITHOUT_RECORDS) for p in listed["xml"] if sizes[p] == 0]
    gone = {p for p, _ in refused}
    every_json, xml = ([p for p in listed[kind] if p not in gone] for kind in ("json", "xml"))
    json_files, large = ([p for p in every_json if (sizes[p] > largest_text) == is_large] for is_large in (False, True))
    outcomes = spark.createDataFrame(refused, "_path string, reason string").select(
        _plain_path(F.col("_path")).alias("_path"), "reason", F.lit(0).cast("long").alias("n_rejects")
    )
    rejects = spark.createDataFrame([], "dataset_id string, resource string, checksum string, record string")
    if json_files:
        found, seen = _read_json(spark, resources, json_files, replacements)
        outcomes = outcomes.unionByName(seen.withColumn("n_rejects", F.lit(0).cast("long")))
        for name, df in found.items():
            flat[name].append(df)
    if large:
        found, seen, more = _read_large_json(spark, resources, large)
        outcomes, rejects = outcomes.unionByName(seen), rejects.unionByName(more)
        for name, df in found.items():
            flat[name].append(df)
    if xml:
        found, seen, more = _read_xml(spark, resources, xml)
        outcomes, rejects = outcomes.unionByName(seen), rejects.unionByName(more)
        flat["2022"].append(found)
    written = {n: materialise(stack_diagonal(t), f"flat-{n}") for n, t in flat.items() if t}
    return Read({n: df.drop("_path") for n, df in written.items()}, outcomes, rejects)


def clean_resources(flat: dict[str, DataFrame], as_of: date) -> DataFrame:
    """Typed rows of all layouts in one table."""
    return stack_diagonal([clean(df, name, as_of, PER_RESOURCE) for name, df in flat.items()])


@dataclass(frozen=True)
class Ingested:
    """Resources of one run: those taken, to be added to ``done``, and those refused, with the reason, to be tried again.

    ``taken`` tells in ``n_rejects`` how many records of a file could not be read; ``rejects`` has these, with their resource.
    """

    taken: DataFrame
    refused: DataFrame
    rejects: DataFrame


def ingest(
    spark: SparkSession, resources: DataFrame, done: DataFrame | None, out: str, as_of: date, largest_text: int = LARGEST_TEXT
) -> Ingested:
    """Clean the resources that are new, and tell what was taken and what was not.

    Every content of a resource has its own folder, which a repeated run replaces, so that a run that fails half-way
    leaves no second copy. A file that was replaced gets another folder; ``publish`` reads those that are valid by its list.
    Rebalancing gives a large resource several tasks and small ones a common one.
    """
    fresh = manifest.current(resources)
    if done is not None:
        fresh = manifest.not_yet_ingested(fresh, done, [*manifest.RESOURCE, "checksum"])
    read = read_resources(spark, fresh, largest_text=largest_text)
    if read.flat:
        cleaned = clean_resources(read.flat, as_of).hint("rebalance", "checksum", "resource")
        writer = cleaned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("checksum", "resource")
        writer.parquet(out, compression="zstd")
    # A file of a format that isn't read, or that vanished while it was, has no outcome at all.
    kept = materialise(read.outcomes.groupBy("_path").agg(F.max("reason").alias("reason"), F.max("n_rejects").alias("n_rejects"), F.lit(True).alias("_seen")), "outcomes")
    judged = fresh.withColumn("_path", _plain_path(F.col("url"))).join(kept, "_path", "left").drop("_path")
    judged = judged.withColumn("reason", F.when(F.col("_seen").isNull(), UNREADABLE).otherwise(F.col("reason"))).drop("_seen")
    return Ingested(judged.where("reason is null").drop("reason"), judged.where("reason is not null").drop("n_rejects"), read.rejects)


@dataclass(frozen=True)
class Published:
    """Tables and reports of one run."""

    contracts: DataFrame
    cache: DataFrame
    scores: DataFrame
    stats: DataFrame
    sources: DataFrame
    overlap: DataFrame


def publish(
    cleaned: Sequence[DataFrame],
    companies: DataFrame,
    sites: DataFrame,
    cache: DataFrame,
    registry: DataFrame,
    as_of: date,
    replies: DataFrame | None = None,
    listed: DataFrame | None = None,
) -> Published:
    """From cleaned rows of all sources to the published tables.

    ``listed`` is the list of resources as it is now. Rows of ``ingest`` count only while their resource is listed with the
    checksum they were read under, so a correction replaces what it corrects and a withdrawn file is gone. Tables
    without these columns, and all rows where there is no list, are taken as they are.
    """
    if listed is not None:
        cleaned = [manifest.only_current(t, listed) if {"resource", "checksum"} <= set(t.columns) else t for t in cleaned]
    rows = stack_diagonal(list(cleaned)).drop("checksum", "resource")
    overlap = materialise(overlap_pairs(rows), "overlap")
    # Written, since enrichment reads it for the buyers, the holders and the rows themselves.
    numbered = materialise(number_versions(keep_first(rows, list(ROW_KEY))), "numbered")
    enriched = materialise(enrich(numbered, companies, sites).drop(*CACHE_DETAILS), "enriched")

    pending = geocache.select_pending(enriched, cache, as_of)
    new_cache = geocache.upsert_cache(cache, pending, replies, sites, as_of)

    derived = derive(enriched, as_of)
    contracts = derived.drop(*starting_with(derived, "activite"))
    missing = {c: F.lit(None).cast("string") for c in CONTRACT_COLUMNS if c not in contracts.columns}
    ordered = published_order(in_contract_order(contracts.withColumns(missing), CONTRACT_COLUMNS))
    alone = overlap.where(F.col("sourceDataset") == F.col("other")).select("sourceDataset", "unique")
    return Published(
        contracts=ordered,
        cache=new_cache,
        scores=activity_product_scores(derived),
        stats=contract_stats(contracts, as_of),
        sources=source_stats(current_records(contracts.select("uid", "acheteur_id", "sourceDataset", "donneesActuelles")), registry, alone),
        overlap=overlap,
    )


def write_published(result: Published, folder: str, described: DataFrame | None = None) -> DataFrame:
    """Write all tables and reports; returns the written contracts.

    ``described`` is a column description read with ``read_contract``; all it says of the columns (description, short
    title, format, allowed values) is published. Without it the titles and types at hand are.
    """
    contracts = files.write_table(result.contracts, f"{folder}/contracts")
    files.write_parquet(result.cache, f"{folder}/geocode_cache.parquet")
    files.write_csv(result.scores, f"{folder}/activity_product_scores.csv")
    files.write_document(result.stats, f"{folder}/statistics.json")
    files.write_csv(result.sources, f"{folder}/source_statistics.csv")
    files.write_parquet(result.overlap, f"{folder}/source_overlap.parquet")
    files.write_document(contract_document(contracts, base_contract(contracts) if described is None else described), f"{folder}/schema.json")
    return contracts
