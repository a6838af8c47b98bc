"""Which products an activity sells: conditional shares and their ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from adjudica.functions.text import strip
from adjudica.operators.counts import counted
from adjudica.operators.dedup import keep_first
from adjudica.operators.joins import null_safe_left
from adjudica.session import materialise

# Fixed value: ranks kept per activity.
TOP_RANKS = 10


def ranked_shares(df: DataFrame, group: str | Sequence[str], item: str, top: int = TOP_RANKS) -> DataFrame:
    """Share of each item in its group, ranked densely, ties and all; ranks above ``top`` go.

    Rows are counted once and the counts written, since three steps read them. Ranks are given to the distinct counts
    of a group, of which there are few even where very many items tie, and then meet the items by count. A group may
    be named by several columns.
    """
    keys = [group] if isinstance(group, str) else list(group)
    counts = materialise(counted(df, [*keys, item], "nb_marches"), "counts")
    totals = counts.groupBy(*keys).agg(F.sum("nb_marches").alias("_total"))
    largest_first = Window.partitionBy(*keys).orderBy(F.col("nb_marches").desc())
    ranks = (
        counts.select(*keys, "nb_marches")
        .distinct()
        .withColumn("rank", F.dense_rank().over(largest_first))
        .where(F.col("rank") <= top)
    )
    ranks = null_safe_left(ranks, totals, keys)
    return null_safe_left(counts, ranks, [*keys, "nb_marches"]).where(F.col("rank").isNotNull()).select(
        *keys, item, "nb_marches", (F.col("nb_marches") / F.col("_total")).alias("score"), "rank"
    )


def activity_product_scores(
    df: DataFrame,
    key: str = "uid",
    product: str = "codeCPV",
    activity: str = "activite_code",
    nomenclature: str = "activite_nomenclature",
    current: str = "donneesActuelles",
    top: int = TOP_RANKS,
) -> DataFrame:
    """P(product | activity) over the current version of every record, one holder per record."""
    usable = df.where(F.col(current)).select(key, product, activity, nomenclature)
    usable = usable.dropna(subset=[product, activity, nomenclature])
    single = keep_first(usable, [key], [F.col(nomenclature).asc(), F.col(activity).asc(), F.col(product).asc()])
    pairs = single.select(
        F.upper(strip(F.col(nomenclature))).alias("activite_nomenclature"),
        F.upper(strip(F.col(activity))).alias("activite_code"),
        strip(F.col(product)).alias("cpv"),
    )
    return ranked_shares(pairs, ["activite_nomenclature", "activite_code"], "cpv", top).select(
        "activite_nomenclature", "activite_code", "cpv", "score", "rank", "nb_marches"
    )
