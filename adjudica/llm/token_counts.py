"""Token counts by merging pieces with a heap and a linked list; no ids are made."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adjudica.llm.common import by_bytes, documents, query, small_batches
from adjudica.llm.vocabulary import DEFAULT, Coder, Vocabulary, loaded, shipped

BATCH_BYTES = 8 << 20


def merged_count(piece: bytes, vocabulary: Vocabulary) -> int:
    """Tokens of one piece: its bytes less the merges made.

    Adjacent pairs wait in a heap by rank, then place. The pair on top is merged if both its symbols are still
    what they were, which links the left one to the symbol after the right one and lays the new pairs in the heap.
    """
    n = len(piece)
    if n < 2:
        return n
    merges, id_of_byte = vocabulary.merges, vocabulary.id_of_byte
    symbols = [id_of_byte[b] for b in piece]
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    heap = []
    for i, pair in enumerate(zip(symbols, symbols[1:])):
        found = merges.get(pair)
        if found:
            heap.append((found[0], i, pair, found[1]))
    heapq.heapify(heap)
    pop, push, count = heapq.heappop, heapq.heappush, n
    while heap:
        _, i, pair, new = pop(heap)
        j = after[i]
        if j < 0 or symbols[i] != pair[0] or symbols[j] != pair[1]:
            continue
        count -= 1
        symbols[i], symbols[j] = new, -1
        k = after[i] = after[j]
        after[j] = -1
        if k >= 0:
            before[k] = i
            found = merges.get((new, symbols[k]))
            if found:
                push(heap, (found[0], i, (new, symbols[k]), found[1]))
        h = before[i]
        if h >= 0:
            found = merges.get((symbols[h], new))
            if found:
                push(heap, (found[0], h, (symbols[h], new), found[1]))
    return count


@lru_cache(2)
def _coder(data: bytes) -> Coder:
    vocabulary = loaded(data)
    return Coder(vocabulary, lambda pieces: [merged_count(p.encode(), vocabulary) for p in pieces], sum, lambda i: 1)


def count_tokens(docs: DataFrame, text: str = "text", count: str = "n_tokens", path: str = DEFAULT) -> DataFrame:
    """Add the number of tokens of every whole text; other columns stay.

    A special token that occurs in a text counts as one, none are added. A null or empty text has none. A column
    with the result's name is replaced. Distinct pieces of a batch are merged once and remembered within a bound.
    """
    small_batches(docs.sparkSession)
    data = shipped(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(data.value)
        for table in by_bytes(batches, place, BATCH_BYTES):
            counts = [sum(v) for v in coder.code(table.column(place).to_pylist())]
            yield from table.drop_columns([place]).append_column("n", pa.array(counts, pa.int64())).combine_chunks().to_batches()

    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col(f"`{text}`").alias("t"))
    place = "t"
    schema = ", ".join(f"{n} {t}" for n, t in kept.dtypes if n != place)
    done = kept.mapInArrow(run, f"{schema}, n long")
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c != count]
    return done.select(*named, F.col("n").alias(count))


@query
def op5_heap_token_counts(spark, sf):
    """Bytes and tokens of all documents, and whether they exceed 512 tokens."""
    sized = documents(spark, sf).select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    # The text isn't wanted in the result, so only its counts come back from Python.
    counted = count_tokens(sized)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
