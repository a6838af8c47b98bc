"""Best-fit packing of tokenised documents into sequences under several capacities."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from adjudica.llm.common import by_bytes, documents, query, small_batches
from adjudica.llm.vocabulary import DEFAULT, PIECES, UNSURE, Coder, loaded, shipped
from adjudica.session import materialise

BATCH_BYTES = 8 << 20
END_ID = 2


class Run(NamedTuple):
    """Items of one length, by rank among their equals, that go into bins in a row, ``each`` to a bin."""

    length: int
    first_rank: int
    each: int
    first_bin: int
    offset: int


class Bins(NamedTuple):
    """Bins in a row that hold the same amounts of tokens, documents and attention cost."""

    first: int
    stop: int
    used: tuple[int, int, int]


def plan(counts: dict[int, int], capacity: tuple[int, int, int], weights: Sequence[float]) -> tuple[list[Run], int]:
    """Where all items of each length go, and the number of bins.

    An item of length l needs (l, 1, l * l) of the capacities. Lengths are taken from the longest down. An item goes
    to the bin, among those with room in every capacity, whose residual has the smallest weighted norm once it is in,
    each capacity counting as 1. The bin chosen for an item is also the best one for the next of its length while
    it has room, so equal items and bins in the same state are placed together: the work depends on the number of
    lengths, not on the number of items.
    """
    runs, groups, bins = [], [], 0
    limits = np.array(capacity, float)
    scale = np.array(weights, float)
    for length in sorted(counts, reverse=True):
        need = (length, 1, length * length)
        if any(n > c for n, c in zip(need, capacity)):
            raise ValueError(f"an item of {length} tokens exceeds a capacity alone")
        left, rank = counts[length], 0
        while left:
            room = np.array([[c - u for c, u in zip(capacity, g.used)] for g in groups]).reshape(-1, 3)
            open_ = (room >= need).all(axis=1)
            if open_.any():
                rest = ((room - need) / limits) ** 2 @ scale
                at = int(np.argmin(np.where(open_, rest, np.inf)))
                group = groups.pop(at)
                each = int(min(r // n for r, n in zip(room[at].tolist(), need)))
            else:
                each = int(min(c // n for c, n in zip(capacity, need)))
                group = Bins(bins, bins + -(-left // each), (0, 0, 0))
                bins = group.stop
            full = min(group.stop - group.first, left // each)
            parts = [(full, each), (int(full < group.stop - group.first and left % each > 0), left - full * each)]
            first = group.first
            for n, items in parts if full < group.stop - group.first else parts[:1]:
                if n and items:
                    runs.append(Run(length, rank, items, first, group.used[0]))
                    used = tuple(u + items * x for u, x in zip(group.used, need))
                    groups.append(Bins(first, first + n, used))
                    first, rank, left = first + n, rank + n * items, left - n * items
            if first < group.stop:
                groups.append(Bins(first, group.stop, group.used))
    return runs, bins


LONG_BLANKS = re.compile(r"\s{4096}")  # the cut of one text keeps a state for each blank of a run


class Encoder:
    """Ids of whole texts as a buffer, by tiktoken on the merges of the given vocabulary.

    A text in which another version of the character classes, a special token or a very long run of blanks could lead
    to another cut goes through the pieces of ``Coder``.
    """

    def __init__(self, data: bytes) -> None:
        import tiktoken

        vocabulary = loaded(data)
        ranks = {b: i for i, b in vocabulary.bytes_of.items()}
        self.engine = tiktoken.Encoding("texts", pat_str=PIECES.pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.specials = re.compile("|".join(map(re.escape, vocabulary.specials)) or "(?!)")
        self.coder = Coder(vocabulary, self._pieces, b"".join, lambda i: np.uint32(i).tobytes(), limit=100_000)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        return [np.array(self.engine.encode_single_piece(p.encode()), np.uint32).tobytes() for p in pieces]

    def ids(self, texts: Sequence[str | None]) -> list[bytes]:
        odd = [t is not None and any(p.search(t) for p in (UNSURE, self.specials, LONG_BLANKS)) for t in texts]
        slow = iter(self.coder.code([t for t, o in zip(texts, odd) if o]))
        return [b"".join(next(slow)) if o else bytes(memoryview(self.engine.encode_to_tiktoken_buffer(t or "", set()))) for t, o in zip(texts, odd)]


@lru_cache(2)
def _encoder(data: bytes) -> Encoder:
    return Encoder(data)


_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, rank long"


def _cut(data, capacity: int, keep_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pieces of documents, each with its rank among those of equal length in its partition."""
    end = np.uint32(END_ID).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = _encoder(data.value), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64).tolist()
        for table in by_bytes(batches, "text", BATCH_BYTES):
            rows, held = [], []
            for doc, ids in zip(table.column("doc_id").to_pylist(), encoder.ids(table.column("text").to_pylist())):
                ids += end
                n = len(ids) // 4
                start = 0
                for piece in range(-(-n // capacity)):
                    stop = start + capacity if piece else (n - 1) % capacity + 1  # the first piece takes the remainder
                    some = ids[4 * start : 4 * stop]
                    length = stop - start
                    rows.append((doc, piece, start, length, zlib.crc32(some), part, seen[length]))
                    if keep_ids:
                        held.append(np.frombuffer(some, np.uint32))
                    seen[length] += 1
                    start = stop
            if rows:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
                if keep_ids:
                    columns.append(pa.array([h.astype(np.int32) for h in held], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _placed(runs: list[Run]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Bin and offset of every item from the run that its length and rank fall into."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            _, first, each, bin_, offset = table[np.searchsorted(keys, length << 48 | rank, side="right") - 1].T
            more = {"sequence_id": bin_ + (rank - first) // each, "offset": offset + (rank - first) % each * length}
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, more.values())], [*batch.schema.names, *more])

    return run


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    most_documents: int | None = None,
    most_attention: int | None = None,
    weights: Sequence[float] = (1.0, 0.01, 0.01),
    keep_ids: bool = False,
    path: str = DEFAULT,
) -> DataFrame:
    """Pack the tokens of all documents, an end id after each, into few sequences.

    Only a document longer than ``capacity`` tokens is cut: its first piece takes the remainder, all others are
    full. A sequence holds at most ``capacity`` tokens, ``most_documents`` pieces and ``most_attention`` squared
    tokens over its pieces; left out, the last two don't bind. Bins are chosen by the weighted norm of the residual.

    The bins are planned for counts of lengths, of which there are ``capacity`` at most, so what the driver gets and
    sends doesn't grow with the documents. Each piece finds its place from its rank among those of its length, which
    is put together from ranks within partitions and counts per partition; no group is ever in one task.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with ``keep_ids``).
    A null or empty text is the end id alone. Repeated rows and null ids are packed like others. Other columns are left
    out. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cut = _cut(shipped(spark, path), capacity, keep_ids)
    pieces = materialise(texts.mapInArrow(cut, _PIECES + (", ids array<int>" if keep_ids else "")), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(lengths, (capacity, most_documents or capacity, most_attention or capacity * capacity), weights)
    ranked = pieces.join(offsets, ["part", "length"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("rank") + F.col("before")).alias("rank"), *(["ids"] if keep_ids else []),
    )
    schema = ", ".join(f"{n} {t}" for n, t in ranked.dtypes)
    return ranked.mapInArrow(_placed(runs), f"{schema}, sequence_id long, offset long").drop("rank")


@query
def op8_vector_best_fit_packing(spark, sf):
    """All documents packed into sequences of at most 1024 tokens."""
    return pack(documents(spark, sf))
