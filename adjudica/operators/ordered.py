"""Running values over rows in one global order, for keys of any size.

A window over a key is one task, however many rows the key has. Here rows are dealt by ranges of the whole order, so a
large key spans many partitions; each works out its own part, and what is carried from one to the next is a table
with no more than a few rows per partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from adjudica.session import materialise

PART, PLACE = "_part", "_place"


@dataclass(frozen=True)
class Fold:
    """An associative way to put values together: over rows, and of two results, either of which may be null."""

    over: Callable[[Column], Column]
    both: Callable[[Column, Column], Column]


SUM = Fold(F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b))
MAX = Fold(F.max, lambda a, b: F.greatest(a, b))
XOR = Fold(F.bit_xor, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a.bitwiseXOR(b)))
# The last value that is not null; the first argument comes first in order.
LAST = Fold(lambda c: F.last(c, ignorenulls=True), lambda a, b: F.coalesce(b, a))


def placed(df: DataFrame, by: Sequence[Column | str], name: str = "ordered") -> DataFrame:
    """The rows dealt by ranges of an order and written, with the partition and the place of each in that order.

    Rows that are equal in all of ``by`` stay in one partition, so ``by`` should tell rows apart.
    """
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    place = F.monotonically_increasing_id()
    # The upper bits of the place are the number of the partition.
    return materialise(ranged.withColumn(PLACE, place).withColumn(PART, F.shiftright(PLACE, 33)), name)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    found = F.col(f"{left}.{PART}") == F.col(f"{right}.{PART}")
    for k in keys:
        found = found & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return found


def _edges(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys at the two ends of every partition: one row each."""
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    return rows.groupBy(PART).agg(F.min_by(key, F.col(PLACE)).alias("first"), F.max_by(key, F.col(PLACE)).alias("last"))


def _carried(valued: DataFrame, edges: DataFrame, keys: Sequence[str], folds: dict[str, Fold], ahead: bool) -> DataFrame:
    """What enters each partition for the key at its near end: the values of all partitions that come before it."""
    leaving, entering = ("first", "last") if ahead else ("last", "first")
    names = [F.col(f"`{k}`") for k in keys]
    # Each partition hands on its values for the key that reaches its far end.
    handed = (
        valued.alias("r")
        .join(F.broadcast(edges.select(PART, f"{leaving}.*")).alias("e"), _same("r", "e", keys))
        .select("r.*")
        .groupBy(PART, *names)
        .agg(*[
            (F.min_by if ahead else F.max_by)(n, F.when(F.col(n).isNotNull(), F.col(PLACE))).alias(n) if fold is LAST else fold.over(F.col(n)).alias(n)
            for n, fold in folds.items()
        ])
    )
    # Bounded by the number of partitions, so one small table holds what they hand on.
    asked = handed.withColumn("_asks", F.lit(0)).unionByName(edges.select(PART, f"{entering}.*").withColumn("_asks", F.lit(1)), allowMissingColumns=True)
    step = F.col(PART).desc() if ahead else F.col(PART).asc()
    earlier = Window.partitionBy(*names).orderBy(step).rangeBetween(Window.unboundedPreceding, -1)
    values = [(F.last(n, ignorenulls=True) if fold is LAST else fold.over(F.col(n))).over(earlier).alias(f"{n}c") for n, fold in folds.items()]
    return asked.select(PART, *names, "_asks", *values).where("_asks = 1").drop("_asks")


def running(
    rows: DataFrame, keys: Sequence[str], out: dict[str, tuple[Fold, Column]], ahead: dict[str, tuple[Fold, Column]] | None = None
) -> DataFrame:
    """Add running values per key to rows from ``placed``, each row included: from the start of the key, and from its end.

    ``rows`` must be in an order that begins with the keys. Only the key at an end of a partition can go on in the next,
    so one row per partition is carried, and broadcast.
    """
    columns, ahead = rows.columns, ahead or {}
    sides = [(False, out, "_f"), (True, ahead, "_b")]
    named = {side: {f"{prefix}{i}": v for i, v in enumerate(spec.values())} for side, spec, prefix in sides}
    every = {n: value for found in named.values() for n, (_, value) in found.items()}
    valued = rows.select(*[F.col(f"`{c}`") for c in columns], *[v.alias(n) for n, v in every.items()])
    edges = _edges(rows, keys)
    here = Window.partitionBy(PART, *[F.col(f"`{k}`") for k in keys]).orderBy(PLACE)
    forward, backward = here.rowsBetween(Window.unboundedPreceding, Window.currentRow), here.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    local = [fold.over(F.col(n)).over(forward).alias(n) for n, (fold, _) in named[False].items()]
    # Towards the end, the last value in order of reading is the first one that is not null.
    local += [(F.first(n, ignorenulls=True) if fold is LAST else fold.over(F.col(n))).over(backward).alias(n) for n, (fold, _) in named[True].items()]
    joined = valued.select(*[F.col(f"`{c}`") for c in columns], *local).alias("l")
    results = []
    for side, spec, prefix in sides:
        if spec:
            carried = _carried(valued, edges, keys, {n: fold for n, (fold, _) in named[side].items()}, side).alias(prefix)
            joined = joined.join(F.broadcast(carried), _same("l", prefix, keys), "left")
            results += [fold.both(F.col(f"{prefix}.{n}c"), F.col(f"l.{n}")).alias(name) for name, (n, (fold, _)) in zip(spec, named[side].items())]
    return joined.select(*[F.col(f"l.`{c}`") for c in columns], *results)


def following(rows: DataFrame, keys: Sequence[str], out: dict[str, Column]) -> DataFrame:
    """Add values of the next row of the same key, for rows from ``placed``; null on the last one of a key."""
    columns = rows.columns
    values = {f"_v{i}": value for i, value in enumerate(out.values())}
    valued = rows.select(*[F.col(f"`{c}`") for c in columns], F.struct(*[v.alias(n) for n, v in values.items()]).alias("_next"))
    frame = Window.partitionBy(PART, *[F.col(f"`{k}`") for k in keys]).orderBy(PLACE)
    # The first row of each partition follows the last one of the partition before: one row per partition.
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    firsts = valued.groupBy(PART).agg(F.min_by(F.struct(key.alias("k"), F.col("_next").alias("n")), F.col(PLACE)).alias("f"))
    heads = firsts.select(F.lag(PART).over(Window.orderBy(PART)).alias(PART), *[F.col(f"f.k.`{k}`").alias(k) for k in keys], F.col("f.n").alias("_head"))
    local = valued.withColumn("_next", F.lead("_next").over(frame))
    joined = local.alias("l").join(F.broadcast(heads).alias("c"), _same("l", "c", keys), "left")
    # The last row of a key in its partition is the only one without a next row there.
    found = F.coalesce(F.col("l._next"), F.col("c._head"))
    return joined.select(*[F.col(f"l.`{c}`") for c in columns], *[found[n].alias(name) for name, n in zip(out, values)])
