"""Byte-pair encoding with a pair occurrence index, and decoding."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adjudica.llm.common import by_bytes, documents, query, small_batches
from adjudica.llm.vocabulary import DEFAULT, Coder, Vocabulary, loaded, shipped

BATCH_BYTES = 8 << 20
_NEVER = np.iinfo(np.int32).max


class PairIndex:
    """Merges all pieces of a batch at once.

    The pieces stand in one row of symbols with links to their neighbours. Every pair that has a rank is indexed
    by its positions. Active ranks are taken in ascending order; a rank is applied at all its positions together,
    and the lists of the pairs that arise or vanish beside them are brought up to date.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        pairs = np.array(list(vocabulary.merges), np.int64).reshape(-1, 2)
        results = np.array(list(vocabulary.merges.values()), np.int64).reshape(-1, 2)
        self.base = 1 + max([*vocabulary.bytes_of, *vocabulary.id_of_byte])
        keys = pairs[:, 0] * self.base + pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], results[order, 0].astype(np.int32)
        self.pair_of, self.id_of = pairs, results[:, 1].astype(np.int32)  # by rank
        self.byte_ids = np.array(vocabulary.id_of_byte, np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; none where a piece ends (symbol -1)."""
        keys = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.key_rank[at], _NEVER)

    def encode(self, pieces: list[str]) -> list[np.ndarray]:
        coded = [p.encode() for p in pieces]
        # A border before, between and after the pieces.
        lengths = np.array([len(c) for c in coded], np.int64)
        starts = np.cumsum(lengths + 1) - lengths
        n = int(lengths.sum()) + len(coded) + 1
        symbols = np.full(n, -1, np.int32)
        inside = np.ones(n, bool)
        inside[0] = False
        inside[starts + lengths] = False
        symbols[inside] = self.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        rank = np.full(n, _NEVER, np.int32)
        rank[:-1] = self._ranks(symbols[:-1], symbols[1:])

        index: dict[int, list[np.ndarray]] = defaultdict(list)

        def enter(positions: np.ndarray) -> None:
            positions = positions[rank[positions] != _NEVER]
            order = np.argsort(rank[positions], kind="stable")
            positions = positions[order]
            found = rank[positions]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            heads = found[np.concatenate(([0], cuts))].tolist() if len(found) else []
            for r, where in zip(heads, np.split(positions, cuts)):
                if r not in index:
                    heapq.heappush(active, r)
                index[r].append(where)

        active: list[int] = []
        enter(np.flatnonzero(rank != _NEVER).astype(np.int32))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            where = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            where = where[rank[where] == r]
            if not len(where):
                continue
            if self.pair_of[r, 0] == self.pair_of[r, 1]:
                where = self._apart(where, after)
            gone = after[where]
            symbols[where] = self.id_of[r]
            rank[gone] = _NEVER
            symbols[gone] = -2
            beyond = after[gone]
            after[where] = beyond
            before[beyond] = where
            changed = np.unique(np.concatenate((where, before[where])))
            rank[changed] = self._ranks(symbols[changed], symbols[after[changed]])
            enter(changed)
        alive = inside & (symbols >= 0)
        counts = np.add.reduceat(np.append(alive, False).astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
        return np.split(symbols[alive], np.cumsum(counts)[:-1]) if len(starts) else []

    @staticmethod
    def _apart(where: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of a symbol's run only every second place begins a pair of equal symbols, from the left."""
        follows = np.zeros(len(where), bool)
        follows[1:] = after[where[:-1]] == where[1:]
        run_start = np.maximum.accumulate(np.where(follows, 0, np.arange(len(where))))
        return where[(np.arange(len(where)) - run_start) % 2 == 0]


@lru_cache(2)
def _coder(data: bytes) -> Coder:
    vocabulary = loaded(data)
    index = PairIndex(vocabulary)
    return Coder(
        vocabulary,
        lambda pieces: [ids.tobytes() for ids in index.encode(pieces)],
        b"".join,
        lambda i: np.int32(i).tobytes(),
        limit=200_000,
    )


def _table(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes of every id, special tokens included; nothing for ids that aren't used."""
    specials = {i: s.encode() for s, i in vocabulary.specials.items()}
    size = 1 + max([*vocabulary.bytes_of, *specials])
    return [vocabulary.bytes_of.get(i) or specials.get(i, b"") for i in range(size)]


def _text(ids: np.ndarray, table: list[bytes]) -> str:
    return b"".join([table[i] for i in ids.tolist() if 0 <= i < len(table)]).decode(errors="replace")


def _encoder(data, text: str, decoded: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, bytes_of = _coder(data.value), _table(loaded(data.value))
        for table in by_bytes(batches, text, BATCH_BYTES):
            table = table.combine_chunks()
            blobs = [b"".join(v) for v in coder.code(table.column(text).to_pylist())]
            table = table.drop_columns([text])
            ends = np.zeros(len(blobs) + 1, np.int32)
            np.cumsum([len(b) // 4 for b in blobs], out=ends[1:])
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(blobs), np.int32)))
            table = table.append_column("ids", ids)
            if decoded:
                table = table.append_column("text", pa.array([_text(np.frombuffer(b, np.int32), bytes_of) for b in blobs], pa.string()))
            yield from table.to_batches()

    return run


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str | None = None, path: str = DEFAULT) -> DataFrame:
    """Add the token ids of whole texts in ``ids``, an array of ints, and in ``decoded``, if it is named, the text
    that these ids stand for. The text itself isn't returned, all other columns stay as they are.

    Special tokens that occur in a text get their ids, none are added. A null text is empty and has no ids.
    A column that already has the name of a result is replaced. Each partition works through its texts in
    batches of ``BATCH_BYTES``, so very long texts and large partitions need no more memory than the longest text.
    """
    small_batches(docs.sparkSession)
    others = {f"c{i}": c for i, c in enumerate(docs.columns) if c not in (text, ids, decoded)}
    kept = docs.select(*[F.col(f"`{c}`").alias(name) for name, c in others.items()], F.col(f"`{text}`").alias("t"))
    schema = [f"{n} {t}" for n, t in kept.dtypes if n != "t"] + ["ids array<int>"] + ["text string"] * bool(decoded)
    done = kept.mapInArrow(_encoder(shipped(docs.sparkSession, path), "t", bool(decoded)), ", ".join(schema))
    named = [F.col(name).alias(c) for name, c in others.items()]
    return done.select(*named, F.col("ids").alias(ids), *([F.col("text").alias(decoded)] if decoded else []))


def decode(coded: DataFrame, ids: str = "ids", text: str = "decoded", path: str = DEFAULT) -> DataFrame:
    """Add the text that ids stand for, special tokens included; bytes that are no UTF-8 become U+FFFD.

    Null ids give an empty text, ids the vocabulary lacks add nothing. A column with the result's name is replaced.
    """
    data = shipped(coded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(loaded(data.value))
        for batch in batches:
            place = batch.schema.get_field_index("ids")
            texts = [_text(row, table) for row in _lists(batch.column(place))]
            columns = [c for i, c in enumerate(batch.columns) if i != place]
            names = [n for i, n in enumerate(batch.schema.names) if i != place]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, "text"])

    others = {f"c{i}": c for i, c in enumerate(coded.columns) if c != text}
    kept = coded.select(*[F.col(f"`{c}`").alias(name) for name, c in others.items()], F.col(f"`{ids}`").alias("ids"))
    schema = ", ".join(f"{n} {t}" for n, t in kept.dtypes if n != "ids")
    done = kept.mapInArrow(run, f"{schema}, text string" if schema else "text string")
    return done.select(*[F.col(name).alias(c) for name, c in others.items()], F.col("text").alias(text))


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The rows of a list column, without a Python object per element; null elements are marked -1."""
    ends = column.offsets.to_numpy()
    values = column.values.fill_null(-1).to_numpy(zero_copy_only=False)
    missing = column.is_null().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield values[:0] if missing[i] else values[ends[i] : ends[i + 1]]


@query
def op2_pair_index_bpe(spark, sf):
    """Token ids of all documents and the texts they decode to, as digests."""
    return encode(documents(spark, sf).select("doc_id", "text"), decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
