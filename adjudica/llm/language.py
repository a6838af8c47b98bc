"""Language of documents by a bidirectional gated recurrent network over bytes, trained here."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from adjudica.llm.common import by_bytes, documents, query, small_batches, text_buffer

HIDDEN = 8
SPAN = 128  # bytes the network reads at a time; longer texts are cut into such spans, all of which are read
LANES = 2048  # spans read side by side
BATCH_BYTES = 4 << 20
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


class Model(NamedTuple):
    """Weights of both directions: bytes and state to the gates (update, reset) and to the candidate, state to labels."""

    labels: list[str]
    byte_gates: np.ndarray  # 2, 256, 2 * HIDDEN
    byte_new: np.ndarray  # 2, 256, HIDDEN
    state_gates: np.ndarray  # 2, HIDDEN, 2 * HIDDEN
    state_new: np.ndarray  # 2, HIDDEN, HIDDEN
    out: np.ndarray  # 2, HIDDEN, labels
    bias: np.ndarray  # labels


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def learn(spans: np.ndarray, targets: np.ndarray, labels: list[str], rounds: int = 300, lanes: int = 128, rate: float = 0.03, seed: int = 7) -> Model:
    """Train on byte spans (rows of equal length) by backpropagation through time; every position has the row's label."""
    rng = np.random.default_rng(seed)
    h, k, steps = HIDDEN, len(labels), spans.shape[1]
    w = [
        rng.normal(0, 0.3, (2, 256, 2 * h)), rng.normal(0, 0.3, (2, 256, h)),
        rng.normal(0, 0.3, (2, h, 2 * h)), rng.normal(0, 0.3, (2, h, h)), rng.normal(0, 0.3, (2, h, k)), np.zeros(k),
    ]
    w = [x.astype(np.float32) for x in w]
    first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    side = np.arange(2)[:, None]
    for step in range(1, rounds + 1):
        rows = rng.integers(0, len(spans), min(lanes, len(spans)))
        read = spans[rows].T
        read = np.stack((read, read[::-1]))  # direction, step, lane
        goal = targets[rows]
        n = len(rows)
        state, kept = np.zeros((2, n, h), np.float32), []
        states = np.empty((steps, 2, n, h), np.float32)
        for t in range(steps):
            x = read[:, t]
            gates = _sigmoid(w[0][side, x] + state @ w[2])
            z, r = gates[..., :h], gates[..., h:]
            inner = state @ w[3]
            new = np.tanh(w[1][side, x] + r * inner)
            kept.append((state, z, r, inner, new))
            state = state + z * (new - state)
            states[t] = state
        forward, backward = states[:, 0], states[::-1, 1]
        p = _softmax(forward @ w[4][0] + backward @ w[4][1] + w[5])
        p[:, np.arange(n), goal] -= 1
        p /= steps * n
        grads = [np.zeros_like(x) for x in w]
        flat = p.reshape(-1, k)
        grads[4][0], grads[4][1] = forward.reshape(-1, h).T @ flat, backward.reshape(-1, h).T @ flat
        grads[5] = flat.sum(axis=0)
        towards = np.stack((p @ w[4][0].T, (p @ w[4][1].T)[::-1]), axis=1)  # step, direction, lane, state
        into_gates, into_new = np.empty((steps, 2, n, 2 * h), np.float32), np.empty((steps, 2, n, h), np.float32)
        d = np.zeros((2, n, h), np.float32)
        for t in reversed(range(steps)):
            before, z, r, inner, new = kept[t]
            d = d + towards[t]
            d_new = d * z * (1 - new * new)
            d_gates = np.concatenate((d * (new - before) * z * (1 - z), d_new * inner * r * (1 - r)), axis=-1)
            d_inner = d_new * r
            into_gates[t], into_new[t] = d_gates, d_new
            turned = before.swapaxes(1, 2)
            grads[2] += turned @ d_gates
            grads[3] += turned @ d_inner
            d = d * (1 - z) + d_gates @ w[2].swapaxes(1, 2) + d_inner @ w[3].swapaxes(1, 2)
        for way in range(2):
            byte = read[way].ravel()
            for grad, into in ((grads[0], into_gates), (grads[1], into_new)):
                values = into[:, way].reshape(len(byte), -1)
                for j in range(values.shape[1]):
                    grad[way, :, j] = np.bincount(byte, values[:, j], 256)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = rate * min(1, 3 * (1 - step / (rounds + 1)))
        for x, g, a, b in zip(w, grads, first, second):
            g = g * np.float32(min(1, 1 / (size + 1e-9)))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= (pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return Model(labels, *w)


def _read(model: Model, spans: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """Sums over the positions of each span (rows of bytes) of the label probabilities at every position."""
    h, (n, steps) = HIDDEN, spans.shape
    columns = np.ascontiguousarray(spans.T)
    seen = None if mask is None else np.ascontiguousarray(mask.T.astype(np.float32))[..., None]
    # Half arguments of the gates, so one tanh serves both: s(x) = (1 + tanh(x / 2)) / 2.
    byte_gates, state_gates = model.byte_gates * np.float32(0.5), model.state_gates * np.float32(0.5)
    ahead = np.empty((steps, n, len(model.labels)), np.float32)
    total = np.zeros((n, len(model.labels)), np.float32)
    for way, order in ((0, range(steps)), (1, reversed(range(steps)))):
        state = np.zeros((n, h), np.float32)
        gates, new, inner, taken = (np.empty((n, m), np.float32) for m in (2 * h, h, h, 2 * h))
        for t in order:
            x = columns[t]
            np.matmul(state, state_gates[way], out=gates)
            gates += np.take(byte_gates[way], x, axis=0, out=taken, mode="clip")
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            np.matmul(state, model.state_new[way], out=inner)
            inner *= gates[:, h:]
            np.take(model.byte_new[way], x, axis=0, out=new, mode="clip")
            new += inner
            np.tanh(new, out=new)
            new -= state
            new *= gates[:, :h]
            state += new
            if way == 0:
                np.matmul(state, model.out[0], out=ahead[t])
            else:
                if seen is not None:
                    state *= seen[t]
                p = ahead[t]
                p += state @ model.out[1]
                p += model.bias
                np.exp(p, out=p)
                p /= p.sum(axis=1, keepdims=True)
                if seen is not None:
                    p *= seen[t]
                total += p
    return total


def probabilities(model: Model, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mean of the label probabilities over all positions of each text; zeros for an empty one."""
    lengths = np.diff(ends)
    total = np.zeros((len(lengths), len(model.labels)))
    whole = lengths // SPAN
    owner = np.repeat(np.arange(len(lengths)), whole)
    starts = ends[:-1][owner] + SPAN * (np.arange(len(owner)) - np.repeat(np.cumsum(whole) - whole, whole))
    for a in range(0, len(starts), LANES):
        some = slice(a, a + LANES)
        sums = _read(model, flat[starts[some, None] + np.arange(SPAN)], None)
        np.add.at(total, owner[some], sums)
    rest = np.flatnonzero(lengths % SPAN)
    rest = rest[np.argsort(lengths[rest] % SPAN, kind="stable")]  # rests of like length are read together
    for a in range(0, len(rest), LANES):
        rows = rest[a : a + LANES]
        size = lengths[rows] % SPAN
        steps = np.arange(size.max())
        inside = steps < size[:, None]
        at = np.where(inside, (ends[1:][rows] - size)[:, None] + steps, 0)
        total[rows] += _read(model, np.where(inside, flat[at], 0), inside)
    return total / np.maximum(lengths, 1)[:, None]


def _spans(size: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spans of a text for training, evenly spread over all of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                data = text.encode()
                n = min(most, max(1, len(data) // size))
                for i in range(n):
                    at = (len(data) - size) * i // max(1, n - 1) if len(data) > size else 0
                    out.append((lang, data[at : at + size].ljust(size)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)] if out else [pa.array([], pa.string()), pa.array([], pa.binary())], ["lang", "span"])

    return run


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 250, spans: int = 4, size: int = 64, rounds: int = 300) -> Model | None:
    """Fit the network on a bounded sample of labelled documents; None where there is none.

    Of each language at most ``sample`` documents are taken, those with the smallest hashes of their ids, and of each
    document at most ``spans`` spans of ``size`` bytes, evenly spread. So training takes the same time for any input.
    """
    small_batches(docs.sparkSession)
    rows = docs.where(F.col(lang).isNotNull() & F.col(key).isNotNull() & (F.octet_length(text) > 0))
    rows = rows.select(F.col(key).alias("at"), F.col(lang).alias("lang"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    # Rows of one id are told apart by their texts, and a repeated row counts once.
    row = ["lang", "at", "text_key"]
    picked = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("at"), "at", "text_key"))
    ids = rows.select(*row).distinct().withColumn("_n", picked).where(F.col("_n") <= sample).drop("_n")
    texts = rows.join(F.broadcast(ids), row).dropDuplicates(row).select("lang", "text")
    found = sorted((r["lang"], bytes(r["span"])) for r in texts.mapInArrow(_spans(size, spans), "lang string, span binary").collect())
    if not found:
        return None
    labels = sorted({name for name, _ in found})
    data = np.frombuffer(b"".join(s for _, s in found), np.uint8).reshape(-1, size)
    return learn(data, np.array([labels.index(name) for name, _ in found]), labels, rounds)


def identify(docs: DataFrame, model: Model | None, text: str = "text", predicted: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add the language of every whole text and its pooled probability; other columns stay.

    Texts are cut into spans of ``SPAN`` bytes, all of which are read in both directions; every position gets label
    probabilities, and those of a document are averaged. A text that is null or has no letter is ``und`` with score 0, and so
    is any text where nothing could be learned. A column that has the name of a result is replaced.
    """
    small_batches(docs.sparkSession, 1000)
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    place = f"c{docs.columns.index(text)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_bytes(batches, place, BATCH_BYTES):
            texts = table.column(place).to_pylist()
            lettered = np.array([model is not None and t is not None and _LETTER.search(t) is not None for t in texts], bool)
            names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if model is not None and lettered.any():
                p = probabilities(model, *text_buffer(table.column(place)))
                best = np.where(lettered, np.clip(p.max(axis=1), 0, 1), 0)
                names = [model.labels[i] if ok else UNKNOWN for i, ok in zip(p.argmax(axis=1).tolist(), lettered.tolist())]
            done = table.append_column("p", pa.array(names, pa.string())).append_column("s", pa.array(best, pa.float64()))
            yield from done.combine_chunks().to_batches()

    schema = ", ".join(f"{n} {t}" for n, t in kept.dtypes)
    done = kept.mapInArrow(run, f"{schema}, p string, s double")
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in (predicted, score)]
    return done.select(*named, F.col("p").alias(predicted), F.col("s").alias(score))


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: the remainder by 5 of the checksum of its id is 0."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


@query
def op7_bidirectional_gru_language(spark, sf):
    """The language of all documents, learned from those that aren't held out."""
    docs = documents(spark, sf)
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
