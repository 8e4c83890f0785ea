"""Language ID: a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows.  In each, one network reads
forwards and one backwards; both states together label every position with a
probability for each language, and a document's probabilities are the means
over all its positions.  The network is trained in numpy by backpropagation
through time, on a bounded sample of labelled documents: per language the one
document of smallest id hash in each of ``SAMPLE_BUCKETS`` hash buckets, of
each the first ``SAMPLE_CHARS`` code points.  Prediction reads whole texts.

Edge cases: a null text or one without a letter is ``und`` with score 0; a
table without any labelled document makes every document ``und``; null ids
count as not held out; rows with null ``lang`` are predicted, not learned
from; further columns of the input are ignored, repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import hash_sample, worker_cache

WINDOW = 64  # bytes
HIDDEN = 12  # units a direction
SAMPLE_BUCKETS, SAMPLE_CHARS = 768, 768
STEPS, BATCH, RATE = 260, 384, 0.02
#: Windows that are read at once in prediction: their states take 12 MB.
BLOCK = 1024

_LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    """``tables[d][byte]``: the byte's input to the gates update, reset, new
    of direction d; ``recur[d]``: from the state to the gates; ``out``: from
    both states to the languages."""

    langs: list[str]
    tables: list[np.ndarray]  # 2 x (256, 3 H)
    recur: list[np.ndarray]  # 2 x (H, 3 H)
    out: np.ndarray  # (2 H, languages)
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [*self.tables, *self.recur, self.out, self.bias]


def windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows as rows of bytes, bytes of each that count, index of its text)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    per = -(-lengths // size)
    flat = np.zeros(int(per.sum()) * size, dtype=np.uint8)
    start = np.concatenate([[0], np.cumsum(per)[:-1]]) * size if len(texts) else lengths
    for s, t in zip(start, texts):
        flat[s:s + len(t)] = np.frombuffer(t, np.uint8)
    owner = np.repeat(np.arange(len(texts)), per)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    return flat.reshape(-1, size), np.minimum(size, lengths[owner] - place * size), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _read(table: np.ndarray, recur: np.ndarray, x: np.ndarray, keep: bool):
    """States (steps, H, windows) of one direction; with ``keep`` what the
    backward pass needs of each step too."""
    steps, n = x.shape
    size = recur.shape[0]
    by_gate, to_gates = np.ascontiguousarray(table.T), np.ascontiguousarray(recur.T)
    h = np.zeros((size, n), np.float32)
    states, kept = np.empty((steps, size, n), np.float32), []
    for t in range(steps):
        g = by_gate.take(x[t], axis=1)
        u = to_gates @ h
        zr = g[:2 * size]
        zr += u[:2 * size]
        _sigmoid(zr)
        z, r = zr[:size], zr[size:]
        new = g[2 * size:]
        new += r * u[2 * size:]
        np.tanh(new, out=new)
        before = h
        h = before - new
        h *= z
        h += new
        states[t] = h
        if keep:
            kept.append((before, z, r, new, u[2 * size:]))
    return states, kept


def _probabilities(model: Model, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """(steps, languages, windows) from the states of both directions."""
    size = forward.shape[1]
    logits = np.matmul(np.ascontiguousarray(model.out[:size].T), forward)
    logits += np.matmul(np.ascontiguousarray(model.out[size:].T), backward)
    logits += model.bias[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def label_positions(model: Model, rows: np.ndarray) -> np.ndarray:
    """Probabilities (steps, languages, windows) of every position."""
    x = np.ascontiguousarray(rows.T)
    forward, _ = _read(model.tables[0], model.recur[0], x, False)
    backward, _ = _read(model.tables[1], model.recur[1], x[::-1], False)
    return _probabilities(model, forward, backward[::-1])


def _gradients(model: Model, rows: np.ndarray, counts: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the positions, and its gradients through time."""
    x = np.ascontiguousarray(rows.T)
    steps, n = x.shape
    size = model.recur[0].shape[0]
    runs = [_read(model.tables[d], model.recur[d], x if d == 0 else x[::-1], True) for d in (0, 1)]
    states = [runs[0][0], runs[1][0][::-1]]
    probs = _probabilities(model, *states)
    weight = (np.arange(steps)[:, None] < counts[None, :]).astype(np.float32) / max(1, counts.sum())
    loss = float(-(np.log(probs[:, label, np.arange(n)] + 1e-9) * weight).sum())
    d_logits = probs
    d_logits[:, label, np.arange(n)] -= 1
    d_logits *= weight[:, None, :]
    flat = d_logits.transpose(1, 0, 2).reshape(len(model.langs), -1)
    d_out = np.concatenate([s.transpose(1, 0, 2).reshape(size, -1) @ flat.T for s in states])
    tables, recurs = [], []
    for d in (0, 1):
        order = slice(None) if d == 0 else slice(None, None, -1)
        d_states = np.matmul(np.ascontiguousarray(model.out[d * size:(d + 1) * size]), d_logits)[order]
        recur_t, d_recur = model.recur[d], np.zeros_like(model.recur[d])
        d_gates, d_h = np.empty((steps, 3 * size, n), np.float32), np.zeros((size, n), np.float32)
        for t in range(steps - 1, -1, -1):
            before, z, r, new, u_new = runs[d][1][t]
            d_h = d_h + d_states[t]
            d_new = d_h * (1 - z) * (1 - new * new)
            g = d_gates[t]
            g[:size] = d_h * (before - new) * z * (1 - z)
            g[size:2 * size] = d_new * u_new * r * (1 - r)
            g[2 * size:] = d_new
            into = g.copy()  # with respect to what the state sends to the gates
            into[2 * size:] *= r
            d_recur += before @ into.T
            d_h = d_h * z + recur_t @ into
        index = (x if d == 0 else x[::-1]).reshape(-1)
        flat_gates = d_gates.transpose(0, 2, 1).reshape(-1, 3 * size)
        by_byte = np.argsort(index, kind="stable")
        seen, first = np.unique(index[by_byte], return_index=True)
        d_table = np.zeros_like(model.tables[d])
        d_table[seen] = np.add.reduceat(flat_gates[by_byte], first, axis=0)
        tables.append(d_table)
        recurs.append(d_recur)
    return loss, [*tables, *recurs, d_out, flat.sum(axis=1)]


def train(samples: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 7) -> Model | None:
    """Adam over random windows, as many of each language; None without samples."""
    samples = sorted((lang, text) for lang, text in samples if lang is not None and text and _LETTER.search(text))
    langs = sorted({lang for lang, _ in samples})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    rows, counts, owner = windows([text.encode() for _, text in samples])
    label = np.array([langs.index(lang) for lang, _ in samples])[owner]
    of = [np.flatnonzero(label == k) for k in range(len(langs))]
    init = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
    model = Model(langs, [init(256, 3 * hidden) for _ in (0, 1)], [init(hidden, 3 * hidden) for _ in (0, 1)],
                  init(2 * hidden, len(langs)), np.zeros(len(langs), np.float32))
    params = model.weights()
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(ix, max(1, BATCH // len(langs))) for ix in of])
        _, grads = _gradients(model, rows[pick], counts[pick], label[pick])
        norm = float(np.sqrt(sum((g * g).sum() for g in grads)))
        rate = RATE * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for p, g, m, s in zip(params, grads, mean, square):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= (rate * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
    return model


def sample(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> list[tuple[str, str]]:
    """At most ``SAMPLE_BUCKETS`` short texts per language, from documents
    that are not held out."""
    text = F.substring(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 1, SAMPLE_CHARS).alias("_text")
    known = docs.filter(F.col(lang_col).isNotNull() & ~held_out(id_col))
    rows = hash_sample(known, F.col(id_col).cast("string"), SAMPLE_BUCKETS, [lang_col], [F.col(lang_col).alias("_lang"), text])
    return [(r["_lang"], r["_text"]) for r in rows]


def held_out(id_col: str = "doc_id"):
    """Whether the id is in the fold that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def score_texts(model: Model | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, its pooled probability) of each whole text."""
    out = [("und", 0.0)] * len(texts)
    real = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    if model is None or not real:
        return out
    rows, counts, owner = windows([texts[i].encode() for i in real])
    pooled = np.zeros((len(real), len(model.langs)))
    for at in range(0, len(rows), BLOCK):
        part = slice(at, at + BLOCK)
        probs = label_positions(model, rows[part])
        inside = np.arange(rows.shape[1])[:, None] < counts[part][None, :]
        sums = np.einsum("tln,tn->nl", probs, inside.astype(np.float32))
        np.add.at(pooled, owner[part], sums)
    pooled /= np.bincount(owner, counts, len(real))[:, None]
    for i, p in zip(real, pooled):
        k = int(p.argmax())
        out[i] = (model.langs[k], float(min(1.0, p[k])))
    return out


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The input with ``lang_pred, score`` (replaced where it has such)."""
    docs = docs.drop("lang_pred", "score")
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # tens of kilobytes, whatever the corpus
    out = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language_id")
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                got = score_texts(held.value, b.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([g for g, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())],
                                                 names=[*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, out)


def identify(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Learn from ``docs`` (without its held-out fold), predict all of it:
    the input's id and text columns with ``lang_pred, score``."""
    return predict(docs, train(sample(docs, text_col, lang_col, id_col)), text_col)
