"""What the operators of this package share: registered queries, Arrow helpers, chunks of ordered ids."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import suppress
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per session, where it isn't installed on them."""
    context = spark.sparkContext
    if getattr(context, "_adjudica_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    bundle = Path(tempfile.mkdtemp(prefix="adjudica-")) / "adjudica_package.zip"  # read by the driver alone
    with zipfile.ZipFile(bundle, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent).as_posix())
    context.addPyFile(str(bundle))
    context._adjudica_shipped = True


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Keep Arrow batches small, since one row may hold a very long text."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if now <= 0 or now > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.Table]:
    """Arrow batches put together until their texts hold ``size`` bytes, so work on them is bounded and not tiny."""
    held, held_bytes = [], 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.column(batch.schema.get_field_index(column)).nbytes
        if held_bytes >= size:
            yield pa.Table.from_batches(held)
            held, held_bytes = [], 0
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Return memory that is free again to the machine, since a worker goes on to other tasks beside others."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array and the n + 1 offsets of its rows; a null text is empty."""
    array = pa.array([], pa.large_binary())
    if len(column):
        plain = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        array = plain.cast(pa.large_binary()).fill_null(b"")
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, ends - ends[0]


def chunk_bounds(docs: DataFrame, key: str, chunks: int) -> list[int]:
    """Ascending values of a long column that cut its rows into about ``chunks`` equal ranges.

    They come from a quantile sketch over the whole column; the driver gets no more values than chunks.
    """
    if chunks < 2:
        return []
    at = [i / chunks for i in range(1, chunks)]
    found = docs.select(F.col(key).cast("long").alias("k")).agg(
        F.percentile_approx("k", [float(x) for x in at], 20 * chunks)
    ).first()[0]
    return sorted(set(found or []))


def chunk_of(key: Column, bounds: Sequence[int]) -> Column:
    """How many of the bounds are at most the key: a binary search inside the expression. Null keys come first."""
    if not bounds:
        return F.lit(0)
    steps = [1 << s for s in reversed(range(len(bounds).bit_length()))]
    values = F.lit(list(bounds)).cast("array<long>")
    # The key goes along in the accumulator: a lambda that names a column hides it from the optimizer's checks.
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.struct(F.lit(0).alias("at"), key.cast("long").alias("key")),
        lambda acc, step: F.struct(
            F.when(F.get(values, acc["at"] + step - 1) <= acc["key"], acc["at"] + step).otherwise(acc["at"]).alias("at"),
            acc["key"].alias("key"),
        ),
        lambda acc: acc["at"],
    )
    return F.coalesce(found, F.lit(0))


M64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWER_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and those of its inverse, at least ``n`` of each."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for name, base in (("_POWERS", _POWER_BASE), ("_INVERSES", pow(_POWER_BASE, -1, 1 << 64))):
            row = np.ones(size, np.uint64)
            row[1:] = np.uint64(base)
            globals()[name] = np.multiply.accumulate(row)
    return _POWERS, _INVERSES


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER_VALUE = _BYTE_VALUE[_LOWER]


def word_hashes(flat: np.ndarray, ends: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row, a word being a run of bytes that are not blanks (space, 0x09 to 0x0D).

    Returns a 64-bit hash, start and end byte per word, and the n + 1 word offsets of the rows. The hash is a
    polynomial over the bytes, taken from running sums, so the whole buffer is hashed in a few passes.
    """
    none = np.zeros(0, np.int64)
    if not len(flat):
        return np.zeros(0, np.uint64), none, none, np.zeros(len(ends), np.int64)
    solid = ~_SPACE[flat]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cuts = ends[:-1][ends[:-1] < len(flat)]
    first[cuts] = solid[cuts]  # a row's first byte starts a word even where the row before it ends in one
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    tails = ends[1:][ends[1:] > 0] - 1
    last[tails] = solid[tails]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    step = 1 << 20  # words at a time, so the running sums stay small
    for a in range(0, len(starts), step):
        b = min(a + step, len(starts))
        lo, hi = starts[a], stops[b - 1]
        power, inverse = _powers(int(hi - lo) + 1)
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((_LOWER_VALUE if lower else _BYTE_VALUE)[flat[lo:hi]] * power[: hi - lo], out=run[1:])
        hashes[a:b] = (run[stops[a:b] - lo] - run[starts[a:b] - lo]) * inverse[starts[a:b] - lo]
    return mix(hashes), starts, stops, np.searchsorted(starts, ends).astype(np.int64)
