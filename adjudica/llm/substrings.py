"""Exact repeats of word runs, found from fixed blocks as anchors."""

from __future__ import annotations

from inspect import signature
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adjudica.llm.common import ORACLE, chunk_bounds, chunk_of, documents, give_back, mix, query, shuffle_partitions, small_batches, text_buffer, word_hashes

CHUNKS_PER_PARTITION = 4
LEAST_CHUNK_BYTES = 1 << 19  # of text; with less, a partition is one chunk
_STEP = 0xC6A4A7935BD1E995


class Words:
    """The words of a chunk's documents in the order of their ids, with hashes of every run of ``length`` words."""

    def __init__(self, table: pa.Table) -> None:
        ids, texts = table.column("doc_id").to_pylist(), table.column("text")
        plain = texts.to_pylist() if len(set(ids)) < len(ids) else None  # texts tell repeated ids apart
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, (plain[i] or "") if plain else ""))
        self.ids = [ids[i] for i in self.order]
        self.flat, self.ends = text_buffer(texts.take(pa.array(self.order, pa.int64())))
        self.hashes, _, _, self.rows = word_hashes(self.flat, self.ends, lower=False)
        self._row_end = np.repeat(self.rows[1:], np.diff(self.rows))
        self.place = np.arange(len(self.hashes)) - np.repeat(self.rows[:-1], np.diff(self.rows))

    def runs(self, length: int) -> np.ndarray:
        """A hash for the run that begins at each word; those beyond the last whole run of the chunk are left out."""
        size, have, total = 1, None, self.hashes
        left, done = length, 0
        while left:
            # Runs of 1, 2, 4, ... words are put together as the bits of the length ask for.
            if left & 1:
                if have is None:
                    have = total
                else:
                    n = len(total) - done
                    have = have[:n] * np.uint64(pow(_STEP, size, 1 << 64)) + total[done : done + n] if n > 0 else total[:0]
                done += size
            left >>= 1
            if left:
                n = max(0, len(total) - size)
                total = total[:n] * np.uint64(pow(_STEP, size, 1 << 64)) + total[size : size + n]
                size *= 2
        return mix(have.copy())

    def whole(self, length: int, n: int) -> np.ndarray:
        """Which of the first ``n`` runs lie inside one document."""
        return np.arange(n) + length <= self._row_end[:n]


def _keyed(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range and low half of a hash in one number, the range in the upper half."""
    return ((hashes >> np.uint64(32)) % np.uint64(ranges)) << np.uint64(32) | (hashes & np.uint64(0xFFFFFFFF))


def _by_range(keys: np.ndarray):
    """Slices of sorted keys that have one range."""
    upper = (keys >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(upper)) + 1
    heads = [0, *cuts.tolist()] if len(keys) else []
    for a, b in zip(heads, [*heads[1:], len(keys)]):
        yield int(upper[a]), a, b


def _lean(fn):
    """The function of one group, after which its memory goes back."""

    def one(table: pa.Table) -> pa.Table:
        out = fn(table)
        give_back()
        return out

    def two(table: pa.Table, other: pa.Table) -> pa.Table:
        out = fn(table, other)
        give_back()
        return out

    return one if len(signature(fn).parameters) == 1 else two


_ROWS = "range int, chunk int, kind int, keys binary, flags binary"
_SCHEMA = pa.schema([("range", pa.int32()), ("chunk", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("flags", pa.binary())])


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)] if rows else [pa.array([], t) for t in _SCHEMA.types], schema=_SCHEMA)


def _probe(block: int, ranges: int):
    """Every rolling window of a block's length: distinct keys, which of them are blocks, which come twice."""

    def run(table: pa.Table) -> pa.Table:
        words, chunk = Words(table), table.column("chunk")[0].as_py()
        runs = words.runs(block)
        inside = words.whole(block, len(runs))
        keys = _keyed(runs, ranges)[inside]
        fixed = words.place[: len(runs)][inside] % block == 0
        order = np.argsort(keys, kind="stable")
        keys, fixed = keys[order], fixed[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(keys)))
        any_fixed = np.logical_or.reduceat(fixed, at) if len(at) else fixed
        keys = keys[at]
        flags = any_fixed.astype(np.uint8) | (counts > 1).astype(np.uint8) << 1
        low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return _table([(r, chunk, 0, low[a:b].tobytes(), np.packbits(np.unpackbits(flags[a:b, None], axis=1)[:, 6:].ravel()).tobytes()) for r, a, b in _by_range(keys)])

    return run


def _anchors(table: pa.Table) -> pa.Table:
    """Keys of one range that are a block somewhere and occur at least twice, sent back to the chunks that have them."""
    chunks, blobs, flags = (table.column(c).to_pylist() for c in ("chunk", "keys", "flags"))
    sizes = np.array([len(b) // 4 for b in blobs])
    keys = np.frombuffer(b"".join(blobs), np.uint32)
    marks = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8))[: 2 * n].reshape(-1, 2) for f, n in zip(flags, sizes)])
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(keys)))
    several = np.logical_or.reduceat(marks[order, 0].astype(bool), at) | (times > 1)
    fixed = np.logical_or.reduceat(marks[order, 1].astype(bool), at)
    hit = np.empty(len(keys), bool)
    hit[order] = np.repeat(several & fixed, times)
    r, stops = table.column("range")[0].as_py(), np.cumsum(sizes)
    rows = []
    for chunk, a, b in zip(chunks, stops - sizes, stops):
        mine = keys[a:b][hit[a:b]]
        if len(mine):
            rows.append((r, chunk, 0, mine.tobytes(), None))
    return _table(rows)


def _members(sought: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted known ones."""
    if not len(known) or not len(sought):
        return np.zeros(len(sought), bool)
    at = np.searchsorted(known, sought)
    at[at == len(known)] = 0
    return known[at] == sought


def _extend(window: int, block: int, ranges: int):
    """Windows around the anchors of a chunk. Those that an earlier place of the chunk has are settled here; of
    each distinct one the hash goes on to be compared with other chunks."""

    def run(table: pa.Table, hits: pa.Table) -> pa.Table:
        if not table.num_rows or not hits.num_rows:
            return _table([])
        words, chunk = Words(table), table.column("chunk")[0].as_py()
        known = np.sort(np.concatenate([
            np.uint64(r) << np.uint64(32) | np.frombuffer(b, np.uint32).astype(np.uint64)
            for r, b in zip(hits.column("range").to_pylist(), hits.column("keys").to_pylist())
        ]))
        probes = words.runs(block)
        anchored = np.flatnonzero(_members(_keyed(probes, ranges), known) & words.whole(block, len(probes)))
        whole = words.runs(window)
        change = np.zeros(len(probes) + 2, np.int32)
        np.add.at(change, np.maximum(anchored - (window - block), 0), 1)
        np.add.at(change, anchored + 1, -1)
        starts = np.flatnonzero((np.cumsum(change)[: len(whole)] > 0) & words.whole(window, len(whole)))
        hashes = whole[starts]
        order = np.argsort(hashes, kind="stable")
        hashes, starts = hashes[order], starts[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        rows = [(chunk % ranges, chunk, 1, np.sort(starts[~new]).astype(np.uint32).tobytes(), None)] if not new.all() else []
        hashes = hashes[new]
        target = (hashes >> np.uint64(32)) % np.uint64(ranges)
        order = np.argsort(target, kind="stable")
        hashes, target = hashes[order], target[order]
        cuts = np.flatnonzero(np.diff(target)) + 1
        heads = [0, *cuts.tolist()] if len(hashes) else []
        rows += [(int(target[a]), chunk, 0, hashes[a:b].tobytes(), None) for a, b in zip(heads, [*heads[1:], len(hashes)])]
        return _table(rows)

    return run


def _earlier(table: pa.Table) -> pa.Table:
    """For each chunk the windows that a chunk before it has; what chunks settled themselves is passed on."""
    rows = [tuple(r.values()) for r in table.to_pylist()]
    sent = sorted((r for r in rows if r[2] == 0), key=lambda r: r[1])
    out = [r for r in rows if r[2] == 1]
    if sent:
        sizes = np.array([len(r[3]) // 8 for r in sent])
        hashes = np.frombuffer(b"".join(r[3] for r in sent), np.uint64)
        order = np.argsort(hashes, kind="stable")  # within equal hashes the earliest chunk stays first
        ordered = hashes[order]
        again = np.zeros(len(hashes), bool)
        again[order[1:]] = ordered[1:] == ordered[:-1]
        stops = np.cumsum(sizes)
        for r, a, b in zip(sent, stops - sizes, stops):
            mine = hashes[a:b][again[a:b]]
            if len(mine):
                out.append((r[0], r[1], 0, mine.tobytes(), None))
    return _table(out)


_FOUND = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]


def _cut(window: int, carried: list[str], as_is: bool):
    """Repeated windows joined to maximal repeats, their words taken out."""

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        rest = table.select(carried)
        if not table.num_rows:
            for name, kind in _FOUND:
                rest = rest.append_column(name, pa.array([], kind))
            return rest
        words = Words(table)
        n = len(words.hashes)
        repeated = np.zeros(n, bool)
        if found.num_rows:
            kinds, blobs = found.column("kind").to_pylist(), found.column("keys").to_pylist()
            known = np.sort(np.frombuffer(b"".join(b for k, b in zip(kinds, blobs) if k == 0), np.uint64))
            whole = words.runs(window)
            repeated[: len(whole)] = _members(whole, known) & words.whole(window, len(whole))
            for k, b in zip(kinds, blobs):
                if k == 1:
                    repeated[np.frombuffer(b, np.uint32)] = True
        starts = np.flatnonzero(repeated)
        change = np.zeros(n + 1, np.int32)
        change[starts] += 1
        change[starts + window] -= 1  # one window at most begins at a word, so no index comes twice
        removed = np.cumsum(change)[:n] > 0
        keep = (~removed).tolist()
        data, bounds, ends = memoryview(words.flat), words.rows.tolist(), words.ends.tolist()
        taken = np.concatenate(([0], np.cumsum(removed)))[words.rows]
        kept = []
        for i in range(len(words.ids)):
            text = bytes(data[ends[i] : ends[i + 1]])
            if taken[i + 1] > taken[i]:
                text = b" ".join(compress(text.split(), keep[bounds[i] : bounds[i + 1]]))
            elif not as_is:
                text = b" ".join(text.split())
            kept.append(text.decode())
        rest = rest.take(pa.array(words.order, pa.int64()))
        for (name, kind), values in zip(_FOUND, (np.diff(words.rows), np.diff(taken), kept)):
            rest = rest.append_column(name, pa.array(values, kind))
        return rest

    return run


def chunk_count(docs: DataFrame, text: str, partitions: int) -> int:
    """As many chunks as there are partitions, and up to four times as many where chunks are large enough.

    Every chunk may exchange a row with every range of hashes, so rows with hardly a hash in them would be the most of it.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("long"))).first()[0] or 0
    return min(CHUNKS_PER_PARTITION * partitions, max(partitions, size // LEAST_CHUNK_BYTES))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, as_is: bool = False) -> DataFrame:
    """Take words out of documents that are covered by a repeat of ``window`` or more words, all but its first place.

    Words are runs of bytes that are no blanks. The first place of a run is that of the smallest id, then the
    earliest in the text. Any repeat of ``window`` words holds a whole block of half that length, counted from the
    start of its document. Such blocks are the index, and every rolling window of a block's length probes it; a
    block that is met a second time is an anchor. Around the anchors of both places windows are extended to
    the full length and compared, and windows that overlap are joined to maximal repeats.

    Documents are shuffled once, into chunks of ids in order. The chunks then exchange packed hashes: distinct ones
    for each chunk and range of hashes, so a passage that a third of all documents share costs no more than one entry
    for each chunk, and nothing is compared in pairs. Probes have 32 bits and the number of their range; one that
    meets another by chance only adds an anchor. Windows are compared by 64-bit hashes.

    Returns the columns of the input but for the text, and n_words, n_removed and kept, the words left, joined by
    one space; with ``as_is`` a text that loses nothing stays as it was. A null text has no words. Rows with null ids
    come before all others; rows with equal ids are ordered by text. Columns of the input that have the name of a
    result are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    partitions = shuffle_partitions(spark)
    block = window // 2
    bounds = chunk_bounds(docs, key, chunk_count(docs, text, partitions))
    others = {f"c{i}": c for i, c in enumerate(docs.columns) if c != text and c not in dict(_FOUND)}
    parted = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        chunk_of(F.col(key).cast("long"), bounds).cast("int").alias("chunk"),
        *[F.col(f"`{c}`").alias(name) for name, c in others.items()],
    ).repartition(partitions, "chunk")
    chunks = parted.groupBy("chunk")
    probes = chunks.applyInArrow(_lean(_probe(block, partitions)), _ROWS)
    anchors = probes.groupBy("range").applyInArrow(_lean(_anchors), _ROWS)
    windows = chunks.cogroup(anchors.groupBy("chunk")).applyInArrow(_lean(_extend(window, block, partitions)), _ROWS)
    repeats = windows.groupBy("range").applyInArrow(_lean(_earlier), _ROWS)
    schema = ", ".join(f"{n} {t}" for n, t in parted.select(*others).dtypes) + ", n_words long, n_removed long, kept string"
    done = chunks.cogroup(repeats.groupBy("chunk")).applyInArrow(_lean(_cut(window, list(others), as_is)), schema)
    return done.select(*[F.col(name).alias(c) for name, c in others.items()], *dict(_FOUND))


@query
def op4_block_anchor_repeats(spark, sf):
    """Words left in all documents after repeats of 20 or more words are taken out."""
    return remove_repeats(documents(spark, sf).select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    )


ORACLE["op4_block_anchor_repeats"] = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
runs AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS run
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS i FROM w WHERE len(ws) >= 20)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS nth FROM runs) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM again, (SELECT unnest(range(20)) AS k)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM w)
SELECT w.doc_id, CAST(len(any_value(w.ws)) AS BIGINT) AS n_words, count(gone.p) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL), '')) AS kept_sha256
FROM w LEFT JOIN words ON words.doc_id = w.doc_id LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY w.doc_id
"""
