"""From raw documents to packed training sequences: five stages, each of which works on all the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adjudica.llm.common import documents, ship
from adjudica.llm.language import UNKNOWN, held_out, identify, train
from adjudica.llm.minhash import near_duplicates
from adjudica.llm.packing import pack
from adjudica.llm.secrets import find_secrets
from adjudica.llm.substrings import remove_repeats
from adjudica.session import materialise

LEAST_SCORE = 0.5


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name in docs.columns:
        name += "_"
    return name


def _with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The columns of the documents with a new text, and the number of its characters where they have one."""
    kinds = dict(docs.dtypes)
    new = {"text": F.col(text)}
    if "n_chars" in columns:
        new["n_chars"] = F.char_length(F.col(text)).cast(kinds["n_chars"])
    return docs.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without a letter or too unlike all languages go.

    Where no document has a language, nothing can be learned and nothing is rejected.
    """
    ship(spark)
    model = train(docs.where(~held_out(F.col("doc_id"))))
    if model is None:
        return docs
    lang, score = _fresh(docs, "lang_pred"), _fresh(docs, "score")
    found = identify(docs, model, predicted=lang, score=score)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id. A row that is repeated stays once."""
    ship(spark)
    kept = near_duplicates(docs).where("kept").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    kept = materialise(kept.agg(F.count(F.lit(1)).alias("_times")), "kept")
    key = _fresh(docs, "text_key")
    rows = docs.withColumn(key, F.xxhash64("text"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col(key) == F.col("_key"))
    # Texts are shuffled once for both joins; only those of repeated rows move again.
    once = rows.join(kept.where("_times = 1"), same, "left_semi")
    again = rows.join(kept.where("_times > 1"), same, "left_semi").dropDuplicates(["doc_id", key])
    return once.unionByName(again).select(*[F.col(f"`{c}`") for c in docs.columns])


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of 20 or more words that stand earlier in the corpus; those left without a word go."""
    ship(spark)
    names = {c: _fresh(docs, c) for c in ("n_words", "n_removed", "kept") if c in docs.columns}
    safe = docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns])  # results don't replace columns
    done = remove_repeats(safe, as_is=True).where("n_words > n_removed")
    back = done.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns if c != "text"], F.col("kept").alias("_text"))
    return _with_text(back, docs.columns, "_text")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mark."""
    ship(spark)
    spans, masked = _fresh(docs, "spans"), _fresh(docs, "masked")
    return _with_text(find_secrets(docs, spans=spans, masked=masked), docs.columns, masked)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of all documents packed into sequences of 1024: one row per piece."""
    ship(spark)
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicate),
    ("repeats", repeats),
    ("secrets", secrets),
    ("packing", packing),
]
# Neither the network nor the token ids can be had in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage returns is written to the shared folder and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
