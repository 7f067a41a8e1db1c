"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into sequences of ``STEPS`` bytes that cover them whole. A forward and a backward GRU read each
sequence, a softmax labels every position, and a document's probabilities are the mean over all its positions.
Weights are trained by backpropagation through time on a bounded sample: ``per_lang`` documents of each
language by hash order, ``train_sequences`` sequences of each. Every byte of every text is scored, many
sequences at a time, in blocks of bounded size.

Null texts and texts without a letter are ``und`` with score 0. With no training rows every text is ``und``.
Extra columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, as_text, broadcast_under, passed, row_blocks, shielded, stored, utf8

HIDDEN, STEPS = 8, 96
SALTS = 16
UNKNOWN = "und"


@dataclass(frozen=True)
class BiGru:
    """Per direction: ``embed`` [256, 3H] (byte's share of update gate, reset gate, candidate), ``recur`` [H, 3H]."""

    languages: tuple[str, ...]
    embed: tuple[np.ndarray, np.ndarray]
    recur: tuple[np.ndarray, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def document_probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean of the positions' label probabilities, one row a document; zeros for empty documents."""
        lengths = np.diff(offsets)
        pieces = -(-lengths // STEPS)
        document = np.repeat(np.arange(len(lengths)), pieces)
        inside = (np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * STEPS
        start = offsets[document] + inside
        size = np.minimum(STEPS, lengths[document] - inside)
        total = np.zeros((len(lengths), len(self.languages)))
        long = np.concatenate([data, np.zeros(STEPS, np.uint8)])
        for at in range(0, len(document), 2048):
            rows = slice(at, at + 2048)
            order = np.argsort(-size[rows], kind="stable")
            s, n, d = start[rows][order], size[rows][order], document[rows][order]
            sums = self._position_sums(long, s, n)
            np.add.at(total, d, sums)
        return total / np.maximum(1, lengths)[:, None]

    def _position_sums(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sum of label probabilities over the positions of each sequence; sequences come longest first.
        Arrays are [unit, sequence], so every operation runs along many sequences."""
        steps, n, k, H = int(size[0]), len(start), len(self.languages), self.recur[0].shape[0]
        x = np.ascontiguousarray(data[start[:, None] + np.arange(steps)].T)
        live = np.searchsorted(-size, -np.arange(steps), side="left")  # sequences longer than t
        logits = np.empty((steps, k, n), np.float32)
        half = np.ascontiguousarray(self.out.reshape(2, H, k).transpose(0, 2, 1))
        for way in (0, 1):
            embed, recur = np.ascontiguousarray(self.embed[way].T), np.ascontiguousarray(self.recur[way].T)
            h = np.zeros((H, n), np.float32)
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                m = live[t]  # a shorter sequence starts backward from its own last byte
                now = _cell(embed.take(x[t, :m], axis=1), h[:, :m], recur)
                if way == 0:
                    logits[t, :, :m] = half[way] @ now
                    h = now  # later steps need no more sequences than this one
                else:
                    logits[t, :, :m] += half[way] @ now
                    h[:, :m] = now
        sums = np.zeros((k, n))
        for t in range(steps):
            e = logits[t, :, : live[t]] + self.out_bias[:, None]
            e -= e.max(axis=0)
            np.exp(e, out=e)
            e /= e.sum(axis=0)
            sums[:, : live[t]] += e
        return sums.T


def _cell(gates: np.ndarray, h: np.ndarray, recur: np.ndarray) -> np.ndarray:
    """One GRU step; ``gates`` is overwritten. Both gates are ``(1 + tanh) / 2`` of half the sum (the halves are in the weights)."""
    H = recur.shape[1]
    back = recur @ h
    two = gates[: 2 * H]
    two += back[: 2 * H]
    np.tanh(two, out=two)
    two *= 0.5
    two += 0.5
    new = back[2 * H :]
    new *= two[H:]
    new += gates[2 * H :]
    np.tanh(new, out=new)
    mixed = h - new
    mixed *= two[:H]
    mixed += new
    return mixed


def fit(texts: list[bytes], langs: list[str], epochs: int = 3, batch: int = 128, rate: float = 0.02, seed: int = 5, least_steps: int = 450) -> BiGru:
    """All sequences of ``STEPS`` bytes of every text are learned from; a shorter text is one shorter sequence. Few sequences are
    seen more often, for ``least_steps`` steps."""
    rng = np.random.default_rng(seed)
    languages = tuple(sorted(set(langs)))
    k, number = len(languages), {lang: i for i, lang in enumerate(languages)}
    hidden = max(HIDDEN, math.ceil(math.sqrt(8 * k)))
    p = {}
    for way in "fb":
        p["e" + way] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        p["r" + way] = rng.normal(0, 0.3, (hidden, 3 * hidden)).astype(np.float32)
    p["o"] = rng.normal(0, 0.3, (2 * hidden, k)).astype(np.float32)
    p["b"] = np.zeros(k, np.float32)
    if k > 1:
        rows, labels, sizes = [], [], []
        for text, lang in zip(texts, langs):
            raw = np.frombuffer(text, np.uint8)
            starts = np.arange(0, max(1, len(raw) - STEPS + 1), STEPS) if len(raw) else ()
            for s in starts:
                piece = raw[s : s + STEPS]
                rows.append(np.pad(piece, (0, STEPS - len(piece))))
                labels.append(number[lang])
                sizes.append(len(piece))
        x, y, size = np.array(rows, np.uint8).reshape(-1, STEPS), np.array(labels, np.int64), np.array(sizes, np.int64)
        weight = (1 / np.maximum(1, np.bincount(y, minlength=k)))[y] if len(y) else np.zeros(0)
        moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in p.items()}
        step = 0
        for _ in range(max(epochs, -(-least_steps // max(1, -(-len(x) // batch))))):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                w = weight[pick] / weight[pick].sum()
                grads = _through_time(p, x[pick].T, y[pick], w.astype(np.float32), size[pick])
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step += 1
                for name, g in grads.items():
                    g = g * min(1, 1 / max(norm, 1e-9))
                    m, v = moments[name]
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.99
                    v += 0.01 * g * g
                    p[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return BiGru(languages, (p["ef"], p["eb"]), (p["rf"], p["rb"]), p["o"], p["b"])


def _through_time(p: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray, size: np.ndarray | None = None) -> dict:
    """Gradients of the mean cross-entropy of all positions. ``x`` is [steps, sequences]; of each sequence the first ``size`` steps count."""
    steps, n = x.shape
    H = p["rf"].shape[0]
    size = np.full(n, steps) if size is None else size
    live = (np.arange(steps)[:, None] < size).astype(np.float32)[:, :, None]
    trace, states = {}, {}
    for way in "fb":
        h = np.zeros((n, H), np.float32)
        kept, out = [], np.empty((steps, n, H), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            g = p["e" + way][x[t]]
            back = h @ p["r" + way]
            gate = 0.5 + 0.5 * np.tanh(g[:, : 2 * H] + back[:, : 2 * H])
            z, r = gate[:, :H], gate[:, H:]
            new = np.tanh(g[:, 2 * H :] + r * back[:, 2 * H :])
            kept.append((t, h, z, r, new, back[:, 2 * H :]))
            h = (new + z * (h - new)) * live[t]  # a shorter sequence starts backward from its own last byte
            out[t] = h
        trace[way], states[way] = kept, out
    both = np.concatenate([states["f"], states["b"]], axis=2)
    logits = both @ p["o"] + p["b"]
    logits -= logits.max(axis=2, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(axis=2, keepdims=True)
    prob[:, np.arange(n), y] -= 1
    prob *= (weight / size)[None, :, None] * live
    grads = {"o": np.einsum("tnh,tnk->hk", both, prob), "b": prob.sum(axis=(0, 1))}
    to_both = prob @ p["o"].T
    for i, way in enumerate("fb"):
        embed, recur = np.zeros_like(p["e" + way]), np.zeros_like(p["r" + way])
        dh = np.zeros((n, H), np.float32)
        gates = np.empty((n, 3 * H), np.float32)
        for t, before, z, r, new, back in reversed(trace[way]):
            dh = (dh + to_both[t, :, i * H : (i + 1) * H]) * live[t]
            dnew = dh * (1 - z) * (1 - new * new)
            gates[:, :H] = dh * (before - new) * 2 * z * (1 - z)
            gates[:, H : 2 * H] = dnew * back * 2 * r * (1 - r)
            gates[:, 2 * H :] = dnew
            np.add.at(embed, x[t], gates)
            through = gates.copy()
            through[:, 2 * H :] *= r
            recur += before.T @ through
            dh = dh * z + through @ p["r" + way].T
        grads["e" + way], grads["r" + way] = embed, recur
    return grads


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All whole sequences of each text; a shorter text is one."""
    for batch in batches:
        data, offsets = utf8(batch, "text")
        row, piece = [], []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            starts = np.arange(0, max(1, b - a - STEPS + 1), STEPS)
            for s in starts.tolist():
                row.append(i)
                piece.append(data[a + s : min(b, a + s + STEPS)].tobytes())
        taken = batch.select(["doc_id", "lang", "_h"]).take(pa.array(row, pa.int64()))
        yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(piece, pa.binary())], ["doc_id", "lang", "_h", "piece"])


def train_languages(docs: DataFrame, usable: Column, per_lang: int = 300, **options) -> BiGru:
    """Fit on at most ``per_lang`` documents of every language, the first by hash of their id among the ``usable``
    rows. Only those rows' texts and languages are read, and all their whole sequences reach the driver."""
    rows = docs.where(usable & F.col("lang").isNotNull()).select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    # ids only are ranked, in two steps so that no task meets a whole language; the chosen rows' texts follow by id
    ranked = rows.where(F.octet_length("text") > 0).withColumn("_h", F.xxhash64("text"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"), F.col("_h"))
    keys = ranked.select("doc_id", "lang", "_h").distinct().withColumn("_salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS)))
    for group in (["lang", "_salt"], ["lang"]):
        keys = keys.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= per_lang)
    chosen = broadcast_under(stored(keys.select("doc_id", "lang", "_h")), 100_000)
    # a null id is in the table only once
    same = ranked["doc_id"].eqNullSafe(chosen["doc_id"]) & (ranked["lang"] == chosen["lang"]) & (ranked["_h"] == chosen["_h"])
    texts = ranked.join(chosen, same, "left_semi").groupBy("doc_id", "lang", "_h").agg(F.min("text").alias("text"))
    sample = texts.mapInArrow(_pieces, "doc_id string, lang string, _h bigint, piece binary").collect()
    sample.sort(key=lambda r: (r.lang, str(r.doc_id), r._h, bytes(r.piece)))
    return fit([bytes(r.piece) for r in sample], [r.lang for r in sample], **options)


def predict_languages(docs: DataFrame, model: BiGru, text: str = "text") -> DataFrame:
    """All rows and columns with ``lang_pred`` and ``score``."""
    return shielded(docs, [text], ["lang_pred", "score"], None, lambda own: _predicted(own.select(F.col(f"`{text}`").alias("text"), OWN), model))


def _predicted(docs: DataFrame, model: BiGru) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = passed(docs.drop("text"), "lang_pred string, score double")
    kept = [f.name for f in schema][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        names = np.array([*net.languages, UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = utf8(batch, "_bytes")
            letters = batch.column(batch.schema.get_field_index("_letters")).to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(batch.num_rows, len(net.languages)), np.zeros(batch.num_rows)
            for a, b in row_blocks(offsets) if net.languages else ():
                prob = net.document_probabilities(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                best[a:b], score[a:b] = prob.argmax(axis=1), np.clip(prob.max(axis=1), 0, 1)
            best[~letters], score[~letters] = len(net.languages), 0
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(names[best]), pa.string()), pa.array(score)], [*kept, "lang_pred", "score"])

    letters = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    return docs.select(*[F.col(f"`{c}`") for c in kept], as_text("text").alias("_bytes"), letters.alias("_letters")).mapInArrow(run, schema)
