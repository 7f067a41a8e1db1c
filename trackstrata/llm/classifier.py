"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover it from the first byte to the last.
Learned filters over ``WIDTH`` consecutive bytes run over every position, each chunk keeps every filter's
maximum, and the mean and the maximum of the chunks' values give one probability. Training is plain
backpropagation through the maxima, on a bounded sample of labelled documents (``per_class`` of each label,
taken by hash order, ``train_chunks`` chunks of each). Scoring reads every byte in blocks of bounded size.

Null or empty texts are scored as one chunk of padding. A label table without usable rows raises nothing: every document then scores
0.5. Repeated labels of one document count as the highest. Extra columns pass through; columns named like an
output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OWN, as_text, passed, row_blocks, shielded, stored, utf8

WIDTH, FILTERS = 6, 24
SEGMENT, CHUNK_SEGMENTS, STEP_SEGMENTS = 16, 16, 15
CHUNK = SEGMENT * CHUNK_SEGMENTS
#: chunks that training holds in full at a time
TRAIN_BLOCK = 2048


@dataclass(frozen=True)
class ConvNet:
    """``tables[j, byte, filter]``: the share of the byte at place j in a filter's value."""

    tables: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One probability per document of ``data[offsets[i]:offsets[i + 1]]``."""
        lengths = np.diff(offsets)
        segments = np.maximum(1, -(-lengths // SEGMENT))
        first = np.concatenate([[0], np.cumsum(segments + 1)])  # an empty segment after each, so that no window reads the next document
        padded = np.zeros(first[-1] * SEGMENT + WIDTH, np.uint8)
        for i, n in enumerate(lengths):
            at = first[i] * SEGMENT
            padded[at : at + n] = data[offsets[i] : offsets[i + 1]]
        pooled = self._segment_maxima(padded, int(first[-1]))
        chunks = np.maximum(1, -(-(segments - CHUNK_SEGMENTS) // STEP_SEGMENTS) + 1)
        document = np.repeat(np.arange(len(lengths)), chunks)
        inside = np.arange(len(document)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        start = first[document] + inside * STEP_SEGMENTS
        end = np.minimum(start + CHUNK_SEGMENTS, first[document + 1] - 1)
        pooled = np.concatenate([pooled, np.zeros((1, FILTERS), np.float32)])
        chunk_max = np.maximum.reduceat(pooled, np.column_stack([start, end]).ravel(), axis=0)[::2]
        begins = np.cumsum(chunks) - chunks
        mean = np.add.reduceat(chunk_max, begins, axis=0) / chunks[:, None]
        top = np.maximum.reduceat(chunk_max, begins, axis=0)
        return _sigmoid(np.concatenate([mean, top], axis=1) @ self.out + self.out_bias)

    def _segment_maxima(self, padded: np.ndarray, segments: int) -> np.ndarray:
        pooled = np.empty((segments, FILTERS), np.float32)
        block = 512
        total = np.empty((block * SEGMENT, FILTERS), np.float32)
        part = np.empty_like(total)
        for at in range(0, segments, block):
            count = min(block, segments - at)
            n, base = count * SEGMENT, at * SEGMENT
            np.take(self.tables[0], padded[base : base + n], axis=0, out=total[:n], mode="clip")
            for j in range(1, WIDTH):
                np.take(self.tables[j], padded[base + j : base + j + n], axis=0, out=part[:n], mode="clip")
                total[:n] += part[:n]
            total[:n].reshape(count, SEGMENT, FILTERS).max(axis=1, out=pooled[at : at + count])
        return np.maximum(pooled + self.bias, 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def training_chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All chunks [n, CHUNK + WIDTH] of the texts, and their text's index."""
    rows, owner = [], []
    for i, text in enumerate(texts):
        raw = np.frombuffer(text, np.uint8)
        starts = np.arange(0, max(1, len(raw) - CHUNK + STEP_SEGMENTS * SEGMENT), STEP_SEGMENTS * SEGMENT)
        for s in starts:
            row = np.zeros(CHUNK + WIDTH, np.uint8)
            piece = raw[s : s + CHUNK + WIDTH]
            row[: len(piece)] = piece
            rows.append(row)
            owner.append(i)
    return np.array(rows, np.uint8).reshape(-1, CHUNK + WIDTH), np.array(owner, np.int64)


def fit(texts: list[bytes], labels: list[int], epochs: int = 14, batch: int = 48, rate: float = 0.01, seed: int = 7, least_steps: int = 300) -> ConvNet:
    """Adam on the log loss of whole documents; classes weigh the same. Few documents are seen more often, for ``least_steps`` steps."""
    rng = np.random.default_rng(seed)
    p = {
        "tables": rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "out": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "out_bias": np.zeros(1, np.float32),
    }
    y = np.array(labels, np.float32)
    if len(set(labels)) > 1:
        weight = np.where(y > 0, 0.5 / max(1e-6, y.mean()), 0.5 / max(1e-6, 1 - y.mean()))
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
        x, owner = training_chunks(texts)
        of = [np.flatnonzero(owner == i) for i in range(len(texts))] if len(texts) < 300 else np.split(np.arange(len(owner)), np.searchsorted(owner, np.arange(1, len(texts))))
        step = 0
        for _ in range(max(epochs, -(-least_steps // -(-len(texts) // batch)))):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), batch):
                docs = order[at : at + batch]
                grads = _gradients(p, x, [of[d] for d in docs], y[docs], weight[docs])
                step += 1
                for k, g in grads.items():
                    m, v = moments[k]
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.99
                    v += 0.01 * g * g
                    p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    else:
        p["out"][:] = 0
    return ConvNet(p["tables"], p["bias"], p["out"], float(p["out_bias"][0]))


def _gradients(p: dict, x: np.ndarray, chunks_of: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> dict:
    rows = np.concatenate(chunks_of)
    counts = np.array([len(c) for c in chunks_of])
    document = np.repeat(np.arange(len(counts)), counts)
    begins = np.cumsum(counts) - counts
    place, chunk_max = np.empty((len(rows), FILTERS), np.int64), np.empty((len(rows), FILTERS), np.float32)
    for at in range(0, len(rows), TRAIN_BLOCK):  # a long text has very many chunks
        pieces = x[rows[at : at + TRAIN_BLOCK]]
        total = p["tables"][0][pieces[:, :CHUNK]]
        for j in range(1, WIDTH):
            total += p["tables"][j][pieces[:, j : j + CHUNK]]
        best = total.argmax(axis=1)
        place[at : at + TRAIN_BLOCK] = best
        chunk_max[at : at + TRAIN_BLOCK] = np.take_along_axis(total, best[:, None, :], axis=1)[:, 0, :]
    chunk_max += p["bias"]
    active = np.maximum(chunk_max, 0)
    mean = np.add.reduceat(active, begins, axis=0) / counts[:, None]
    top = np.maximum.reduceat(active, begins, axis=0)
    features = np.concatenate([mean, top], axis=1)
    error = (_sigmoid(features @ p["out"] + p["out_bias"]) - y) * weight / len(y)
    to_features = error[:, None] * p["out"]
    back = (to_features[:, :FILTERS] / counts[:, None])[document]
    back = back + np.where(active == top[document], to_features[:, FILTERS:][document], 0)
    back = np.where(chunk_max > 0, back, 0).astype(np.float32)
    tables = np.zeros_like(p["tables"])
    column = np.arange(FILTERS)[None, :]
    line = rows[:, None]
    for j in range(WIDTH):
        np.add.at(tables[j], (x[line, place + j], column), back)
    return {
        "tables": tables + 1e-4 * p["tables"],
        "bias": back.sum(axis=0),
        "out": (features.T @ error + 1e-3 * p["out"]).astype(np.float32),
        "out_bias": np.array([error.sum()], np.float32),
    }


def train_quality(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = 1200, label: str = "quality", **options) -> ConvNet:
    """Fit on at most ``per_class`` documents of each label value, the first by hash of their id among the ``usable`` rows."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    known = known.where(usable).select("doc_id", (F.col("_y") > 0).cast("int").alias("_y"))
    order = (F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id"))
    # a top-n of each class instead of a window over it: no task meets a whole class
    picked = stored(known.where("_y = 0").orderBy(*order).limit(per_class).unionByName(known.where("_y = 1").orderBy(*order).limit(per_class)))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    # a repeated id gives one training row: the smallest text
    sample = sorted(rows.groupBy("doc_id", "_y").agg(F.min("text").alias("text")).collect(), key=lambda r: str(r.doc_id))
    return fit([(r.text or "").encode() for r in sample], [r._y for r in sample], **options)


def score_quality(docs: DataFrame, model: ConvNet, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """All rows and columns with ``score`` and ``predicted`` (1 if ``score >= threshold``)."""
    return shielded(docs, [text], ["score", "predicted"], None, lambda own: _scored(own.select(F.col(f"`{text}`").alias("text"), OWN), model, threshold))


def _scored(docs: DataFrame, model: ConvNet, threshold: float) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = passed(docs.drop("text"), "score double, predicted int")
    kept = [f.name for f in schema][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            data, offsets = utf8(batch, "_bytes")
            score = np.empty(batch.num_rows, np.float64)
            for a, b in row_blocks(offsets):
                score[a:b] = net.scores(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*kept, "score", "predicted"])

    return docs.select(*[F.col(f"`{c}`") for c in kept], as_text("text").alias("_bytes")).mapInArrow(run, schema)
