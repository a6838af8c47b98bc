"""Balanced contiguous shards from global prefix sums of byte sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from adjudica.llm.common import documents, query
from adjudica.session import materialise

_PLACED = "doc_id long, size long, text_crc32 long, group_id long, part int, rows_before long, bytes_before long"


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and bytes that stand before each row in its partition."""
    part, rows, size = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        upto = np.cumsum(sizes) + size
        n = batch.num_rows
        new = {"part": np.full(n, part, np.int32), "rows_before": np.arange(rows, rows + n), "bytes_before": upto - sizes}
        yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, new.values())], [*batch.schema.names, *new])
        rows, size = rows + n, int(upto[-1]) if n else size


def cut_of(before: Column, total: Column, shards: int) -> Column:
    """The shard, from 0 to ``shards`` - 1, of a row before which ``before`` of ``total`` bytes stand.

    Whole numbers are divided: a decimal quotient is rounded to a few digits before any floor, which puts the last
    bytes of a large table past the last shard.
    """
    return F.call_function("div", before.cast("decimal(38,0)") * shards, total.cast("decimal(38,0)")).cast("int")


def shard_by_bytes(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", slack: float = 0.01) -> DataFrame:
    """Put documents into shards of nearly equal bytes that are contiguous in one global order.

    The order is that of a 64-bit hash of the text, then of the key, so equal texts are neighbours. A range
    shuffle of narrow rows brings it about; every partition adds up its own sizes; the totals of the partitions
    (one row each) give the global prefix sums, and the sums are cut at equal targets. A group of equal texts that
    a cut would part goes whole to the shard it begins in if it holds no more than ``slack`` of a shard; larger
    groups are cut, so one text that a third of all rows have doesn't unbalance the shards. Shards differ by
    two such groups and one row at most.

    A size is the UTF-8 bytes of the text (none for a null text) plus 1; extra columns are left out. Rows with
    a null key take part like others. Repeated rows each get their own slot. An empty table gives no rows.

    Returns doc_id, size, text_crc32, group_id, shard and slot, the gapless place within the shard.
    """
    sized = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.xxhash64(F.col(text)).alias("group_id"),
    )
    order = ["group_id", "doc_id", "text_crc32"]
    narrow = materialise(sized, "sizes")
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ranged.mapInArrow(_running, _PLACED), "placed")

    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: bounded by the number of partitions, so one task and a broadcast hold it.
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_offset"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_offset"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    cut = placed.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32", "group_id",
        (F.col("rows_before") + F.col("rows_offset")).alias("place"),
        cut_of(F.col("bytes_before") + F.col("bytes_offset"), F.col("all_bytes"), shards).alias("cut"),
        "all_bytes",
    )
    # At most one group for each of the shards - 1 cuts.
    parted = (
        cut.groupBy("group_id")
        .agg(F.min("cut").alias("whole"), F.max("cut").alias("last"), F.sum("size").alias("bytes"), F.first("all_bytes").alias("all"))
        .where((F.col("whole") < F.col("last")) & (F.col("bytes") * shards <= F.col("all") * slack))
        .select("group_id", "whole")
    )
    settled = cut.join(F.broadcast(parted), "group_id", "left").withColumn("shard", F.coalesce("whole", "cut"))
    firsts = settled.groupBy("shard").agg(F.min("place").alias("first_place"))  # one row per shard
    return settled.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "group_id", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )


@query
def op1_prefix_sum_shards(spark, sf):
    """All documents in 16 shards whose bytes are nearly equal."""
    return shard_by_bytes(documents(spark, sf)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
