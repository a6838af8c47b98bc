"""Near-duplicates by circulant MinHash, banding and exact Jaccard similarity."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from adjudica.llm.common import ORACLE, by_bytes, documents, give_back, mix, query, small_batches, text_buffer
from adjudica.llm.graph import components
from adjudica.llm.shingles import common, shingle_sets
from adjudica.session import materialise

BATCH_BYTES = 4 << 20
ROWS_PER_BAND = 5
LEADER_GROWTH = 32
MOST_LEADERS = 512  # nodes of a bucket that its members are compared with in one round
FIRST_BUCKETS = 8  # the first round is for one bucket in so many
PARITY_BITS = 1024  # of a node's set; sets of up to some thousand shingles are told apart by them


def permuted(x: np.ndarray, seed: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, worked out in place."""
    x += np.uint32(seed)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` minima for each non-empty set.

    Two permutations of a universe of 2**32 places: the first scatters the shingles over the places, the
    second gives every place its value. Coordinate k is the smallest value over the set after the second one
    is shifted circularly by k.
    """
    starts = np.cumsum([0, *map(len, sets[:-1])])
    places = permuted((np.concatenate(sets) >> np.uint64(32)).astype(np.uint32), 0x9E3779B9)
    out = np.empty((coordinates, len(sets)), np.uint32)
    for k in range(coordinates):
        out[k] = np.minimum.reduceat(permuted(places - np.uint32(k), 0x85EBCA6B), starts)
    return out.T


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for every band of ``rows`` coordinates, different bands having different keys."""
    bands = minima.shape[1] // rows
    keys = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = np.broadcast_to(keys, (len(minima), bands)).copy()
    for j in range(rows):
        keys = mix(keys ^ minima[:, j : bands * rows : rows].astype(np.uint64))
    return keys.view(np.int64)


def bands_for(similarity: float, miss: float, rows: int = ROWS_PER_BAND) -> int:
    """Bands after which a pair at the threshold shares none with a probability below ``miss``."""
    hit = similarity**rows
    return 1 if hit >= 1 else math.ceil(math.log(miss) / math.log1p(-hit))


def _sketch(words: int, bands: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_bytes(batches, "text", BATCH_BYTES):
            sets = list(shingle_sets(*text_buffer(table.column("text")), words))
            full = [s for s in sets if len(s)]
            keys = band_keys(signatures(full, bands * ROWS_PER_BAND), ROWS_PER_BAND) if full else np.zeros((0, bands), np.int64)
            has = np.array([len(s) > 0 for s in sets])
            offsets = np.zeros(len(sets) + 1, np.int32)
            np.cumsum(np.where(has, bands, 0), out=offsets[1:])
            nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            columns = {
                "doc_id": table.column("doc_id").combine_chunks(),
                "text_key": table.column("text_key").combine_chunks(),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array(nodes, pa.binary()),
                "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
            }
            yield from pa.table(columns).to_batches()
            give_back()

    return run


def parities(shingles: np.ndarray) -> np.ndarray:
    """For each of ``PARITY_BITS`` classes of shingles, whether a set has an odd number of them; in 64-bit words.

    A class in which two sets differ has a shingle that one of them alone has. So the bits in which they differ are no more
    than the shingles that are in one of them only.
    """
    odd = np.bincount((shingles % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_bytes(batches, "text", BATCH_BYTES):
            sets = list(shingle_sets(*text_buffer(table.column("text")), words))
            bits = np.concatenate([parities(s) for s in sets])
            columns = {
                "node": table.column("node").combine_chunks(),
                "members": pa.array([s.tobytes() for s in sets], pa.binary()),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "bits": pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (PARITY_BITS // 64)), pa.array(bits)),
            }
            yield from pa.table(columns).to_batches()
            give_back()

    return run


def _confirm(similarity: Fraction) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                both = common(x, y)
                keep.append(both * similarity.denominator >= (len(x) + len(y) - both) * similarity.numerator)
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))
            give_back()

    return run


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shingle of a node."""
    for batch in batches:
        sets = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column("members")]
        for a in range(0, len(sets), 64):
            some = sets[a : a + 64]
            owner = pa.array(np.repeat(np.arange(a, a + len(some)), [len(s) for s in some]))
            yield pa.record_batch({"node": batch.column("node").take(owner), "shingle": pa.array(np.concatenate(some))})


def _able(sets: DataFrame, members: DataFrame, similarity: Fraction) -> DataFrame:
    """The nodes among ``members`` that may be linked with another of them: their ``n`` and ``bits``, ``lone``, the share of
    their shingles that no other has, and the two numbers by which pairs are excluded, ``need`` and ``room``.

    What two sets have in common is no more than what either of them has in common with all others, ``left``. So sets of
    n and m shingles are linked only if the smaller ``left`` is at least p (n + m) / (p + q), the similarity being p / q:
    ``need`` = p m is at most ``room`` = (p + q) left - p n, both ways.
    """
    p, q = similarity.numerator, similarity.denominator
    held = sets.join(members.select("node").distinct(), "node")
    counts = held.mapInArrow(_shingles, "node binary, shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
    lone = counts.where("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("_lone"))
    sized = held.select("node", "n", "bits").join(lone, "node", "left")
    left, size = F.col("n") - F.coalesce("_lone", F.lit(0)), F.col("n")
    fits = left * q >= size * p
    numbers = [(1 - left / size).alias("lone"), (size * p).alias("need"), (left * (p + q) - size * p).alias("room")]
    return materialise(sized.where(fits).select("node", "n", "bits", *numbers), "able")


def _near(similarity: Fraction) -> Column:
    """Whether a pair may be linked by the parities of its sets.

    Sets of n and m shingles are linked if those that one of them alone has are at most (q - p) / (q + p) of n + m, the
    similarity being p / q, and the bits in which their parities differ are no more than these.
    """
    p, q = similarity.numerator, similarity.denominator
    differ = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("head_bits")[i])) for i in range(PARITY_BITS // 64)), F.lit(0))
    return differ.cast("long") * (p + q) <= (F.col("n") + F.col("head_n")) * (q - p)


def _partnered(able: DataFrame) -> DataFrame:
    """The members of buckets, but those that every member of their bucket is excluded for."""
    best = able.groupBy("bucket").agg(F.max("room").alias("_room"), F.min("need").alias("_need"))
    return able.join(best, "bucket").where("_room >= need and room >= _need").drop("_room", "_need")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: the links are drawn between the labels their ends have by now, which are few."""
    ends = labels.select(F.col("node").alias("at"), "label")
    between = links.join(ends, F.col("a") == F.col("at")).select("b", F.col("label").alias("x"))
    between = between.join(ends, F.col("b") == F.col("at")).select("x", F.col("label").alias("y")).where("x <> y")
    merged = components(between).select(F.col("node").alias("was"), F.col("label").alias("now"))
    return materialise(
        labels.join(merged, F.col("label") == F.col("was"), "left").select("node", F.coalesce("now", "label").alias("label")), "labels"
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, miss: float = 1e-6) -> DataFrame:
    """Groups of documents whose sets of word shingles are linked by a Jaccard similarity of ``similarity`` or more.

    Documents with equal sets are one node from the start, so copies cost one row each. The other nodes meet in
    buckets, one for each band of their signature. Links are confirmed on the full sets, never estimated. A bucket
    doesn't form all its pairs: in each round some of its nodes are compared with those of its members that are in
    another component by then, and leave the bucket; it is done when the rest is one component. The first round is for
    one bucket in eight. After it, shingles which none of the others has tell which nodes and pairs can't be linked:
    such pairs aren't compared, nodes without any other pair leave, and those with the fewest such shingles are
    compared first. Of the rest, pairs whose parities differ in too many bits are excluded inside the join of a bucket, so
    they aren't rows either; in a bucket that isn't connected their number is the square of its size, at 16 words of 64 bits each.
    So a group of n near copies takes about n comparisons, and yet no two members of a
    bucket stay unlinked without a proof or being connected. Two nodes at the threshold share no bucket with a probability below ``miss``.

    Returns one row per row of the input: doc_id, text_key (a hash of the text), n_shingles, component_id (the smallest id of the component) and kept
    (its own id is that one). Null texts and those without words are linked with nothing. A row with a null id
    takes part; where a component has no id at all, component_id is null and its rows are kept. Repeated rows have equal
    results. Other columns aren't returned. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark, 1000)
    exact = Fraction(str(similarity))
    bands = bands_for(similarity, miss)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    rows = materialise(
        texts.mapInArrow(_sketch(words, bands), "doc_id long, text_key long, n_shingles long, node binary, bands array<long>"), "sketch"
    )
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_key")).alias("pick"), F.min("doc_id").alias("least_id"), F.first("bands").alias("bands")
    )
    nodes = materialise(nodes, "nodes")
    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = materialise(placed.join(shared, "bucket").select("bucket", "node"), "members")

    # Full sets of the nodes that share a bucket, from one document each.
    wanted = members.select("node").distinct().join(nodes, "node").select(
        "node", F.col("pick.doc_id").alias("at"), F.col("pick.text_key").alias("text_at")
    )
    picked = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("text_key") == F.col("text_at")))
    picked = picked.dropDuplicates(["node"])  # a repeated row is there several times
    sets = picked.select("node", "text").mapInArrow(_sets(words), "node binary, members binary, n long, bits array<long>")
    sets = materialise(sets, "sets")

    labels = materialise(members.select("node").distinct().select("node", F.col("node").alias("label")), "labels")
    leaders, first_round = 1, True
    while not members.isEmpty():
        if first_round:  # most near copies meet in few buckets; the others then are of one component already
            able = members.where(F.pmod(F.col("bucket"), F.lit(FIRST_BUCKETS)) == 0).withColumns(
                {"lone": F.lit(0.0), "need": F.lit(0).cast("long"), "room": F.lit(0).cast("long")}
            ).join(sets.select("node", "n", "bits"), "node")
        else:
            able = _partnered(members.join(_able(sets, members, exact), "node"))
        known = materialise(able.join(labels, "node").select("bucket", "node", "lone", "need", "room", "n", "bits", "label"), "known")
        first = F.row_number().over(Window.partitionBy("bucket").orderBy("lone", "node"))
        heads = materialise(known.withColumn("_n", first).where(F.col("_n") <= leaders).drop("_n", "lone"), "heads")
        other = heads.select("bucket", *[F.col(c).alias(f"head_{c}") for c in ("node", "label", "need", "room", "n", "bits")])
        pairs = (
            known.join(other, "bucket")
            .where(F.expr("label <> head_label and need <= head_room and head_need <= room") & _near(exact))
            .select(F.least("node", "head_node").alias("a"), F.greatest("node", "head_node").alias("b"))
            .distinct()
        )
        with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("set_a")), "a")
        with_both = with_a.join(sets.select(F.col("node").alias("b"), F.col("members").alias("set_b")), "b")
        found = materialise(with_both.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(exact), "a binary, b binary"), "links")
        if not found.isEmpty():
            labels = _joined(labels, found)
        rest = (members if first_round else known).select("bucket", "node")
        rest = rest.join(heads.select("bucket", "node"), ["bucket", "node"], "left_anti").join(labels, "node")
        open_buckets = rest.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("bucket")
        members = materialise(rest.join(open_buckets, "bucket").select("bucket", "node"), "members")
        leaders = 1 if first_round else min(LEADER_GROWTH * leaders, MOST_LEADERS)
        first_round = False

    tied = labels.join(nodes.select("node", "least_id"), "node")
    least = tied.groupBy("label").agg(F.min("least_id").alias("group_id"))
    named = labels.join(least, "label").select("node", "group_id")
    found_ids = nodes.join(named, "node", "left").select("node", F.coalesce("group_id", "least_id").alias("least_id"))
    return rows.join(found_ids, "node", "left").select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


@query
def op3_circulant_minhash(spark, sf):
    """Groups of near copies among all documents: three-word shingles, similarity 0.85 or more."""
    return near_duplicates(documents(spark, sf), words=3, similarity=0.85).drop("text_key")


ORACLE["op3_circulant_minhash"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 2, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY 1),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n p ON p.doc_id = a.doc_id JOIN n q ON q.doc_id = b.doc_id
  GROUP BY 1, 2, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x)
SELECT n.doc_id, n.n AS n_shingles, min(other) AS component_id, n.doc_id = min(other) AS kept
FROM n JOIN reached r ON r.doc_id = n.doc_id GROUP BY 1, 2
"""
