"""A byte-level convolutional quality classifier in numpy.

Bytes are embedded; learned filters of WIDTH bytes are applied every STRIDE bytes
over the whole text; their rectified outputs are max-pooled within overlapping
chunks of two segments (a chunk every SEGMENT bytes); a hidden layer turns a
chunk's pooled filters and the share of the chunk that holds text into a logit.  A document's logit is the mean over all its
chunks, calibrated by a logistic fit on whole training documents.

Fitting is bounded to the DOCUMENTS labelled documents with the smallest id hashes
and CHUNKS evenly spaced chunks of the first SAMPLE_CHARS characters of each; scoring covers every
byte, in slices of SLICE segments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowmap import add_columns
from .wordhash import blocks

DOCUMENTS = 4000
CHUNKS = 12
SAMPLE_CHARS = 65_536  # characters of one document that fitting looks at
EMBED, FILTERS, HIDDEN = 8, 24, 16
STRIDE, WIDTH, SEGMENT = 4, 8, 256
EPOCHS, BATCH, RATE = 6, 64, 3e-3
SLICE = 4096  # segments whose filter outputs are in memory at once
SHORT = 0.3  # share of chunks that are also shown shortened
THRESHOLD = 0.7


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document followed by at least WIDTH zero bytes up to whole segments; segment numbers at which documents begin."""
    sizes = np.diff(offsets)
    segments = -(-(sizes + WIDTH) // SEGMENT)
    first = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(segments, out=first[1:])
    out = np.zeros(first[-1] * SEGMENT, np.uint8)
    shift = np.repeat(first[:-1] * SEGMENT - offsets[:-1], sizes)
    out[np.arange(len(data)) + shift] = data
    return out, first


class QualityModel:
    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        n = WIDTH * EMBED
        self.p = {
            "embed": r.normal(0, 0.5, (256, EMBED)),
            "filters": r.normal(0, 1 / np.sqrt(n), (n, FILTERS)),
            "bias": np.zeros(FILTERS),
            "hidden": r.normal(0, 1 / np.sqrt(FILTERS), (FILTERS + 1, HIDDEN)),
            "hidden_bias": np.zeros(HIDDEN),
            "out": r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            "out_bias": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.scale, self.shift = 1.0, 0.0

    def _head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(pooled @ self.p["hidden"] + self.p["hidden_bias"])
        return h, h @ self.p["out"] + self.p["out_bias"][0]

    def chunk_logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logit of every chunk, number of the first chunk of each document)."""
        padded, first = _padded(data, offsets)
        half = self.p["filters"].reshape(2, STRIDE * EMBED, FILTERS)
        per = SEGMENT // STRIDE
        last = first[1:] - 1
        seg = np.empty((int(first[-1]), FILTERS), np.float32)
        for i in range(0, len(seg), SLICE):  # memory follows the slice, not the text
            j = min(i + SLICE, len(seg))
            steps = self.p["embed"][padded[i * SEGMENT : j * SEGMENT + STRIDE]].reshape(-1, STRIDE * EMBED)
            n = (j - i) * per
            act = steps[:n] @ half[0]
            act[: len(steps) - 1] += (steps @ half[1])[1 : n + 1]
            act += self.p["bias"]
            act[(last[(last >= i) & (last < j)] + 1 - i) * per - 1] = 0  # would reach into the next document; only padding is left there
            seg[i:j] = np.maximum(act.reshape(-1, per, FILTERS).max(1), 0)
        counts = np.diff(first)
        pooled = seg.copy()
        pooled[:-1] = np.maximum(seg[:-1], seg[1:])
        pooled[last] = seg[last]
        filled = np.minimum(np.repeat(np.diff(offsets), counts) - (np.arange(len(seg)) - np.repeat(first[:-1], counts)) * SEGMENT, 2 * SEGMENT)
        pooled = np.concatenate([pooled, np.maximum(filled, 0)[:, None].astype(np.float32) / (2 * SEGMENT)], 1)
        keep = np.ones(len(seg), bool)
        keep[last[counts > 1]] = False  # the last segment is part of the chunk before
        chunks = np.maximum(counts - 1, 1)
        begin = np.cumsum(chunks) - chunks
        return self._head(pooled[keep])[1], begin

    def document_logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        logits, begin = self.chunk_logits(data, offsets)
        sums = np.add.reduceat(logits.astype(np.float64), begin)
        return sums / np.diff(np.append(begin, len(logits)))

    def probability(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = self.scale * self.document_logits(data, offsets) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def _gradient(self, chunk: np.ndarray, filled: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """chunk: (n, 2 * SEGMENT) bytes; filled: how many of them are text."""
        p, n = self.p, len(chunk)
        windows = np.lib.stride_tricks.sliding_window_view(chunk, WIDTH, 1)[:, ::STRIDE]  # n, positions, WIDTH
        x = p["embed"][windows].reshape(n, -1, WIDTH * EMBED)
        act = x @ p["filters"] + p["bias"]
        at = act.argmax(1)  # n, FILTERS
        pooled = np.maximum(np.take_along_axis(act, at[:, None], 1)[:, 0], 0)
        pooled = np.concatenate([pooled, filled[:, None] / np.float32(2 * SEGMENT)], 1)
        h, z = self._head(pooled)
        dz = ((1 / (1 + np.exp(-z)) - y) / n).astype(np.float32)
        dh = dz[:, None] * p["out"] * (1 - h * h)
        dact = ((dh @ p["hidden"].T) * (pooled > 0))[:, :FILTERS]
        won = np.take_along_axis(x, at[:, :, None], 1)  # n, FILTERS, WIDTH * EMBED
        dwon = dact[:, :, None] * p["filters"].T
        dembed = np.zeros_like(p["embed"])
        np.add.at(dembed, np.take_along_axis(windows, at[:, :, None], 1).ravel(), dwon.reshape(-1, EMBED))
        return {
            "embed": dembed, "filters": np.einsum("nf,nfk->kf", dact, won), "bias": dact.sum(0), "hidden": pooled.T @ dh,
            "hidden_bias": dh.sum(0), "out": h.T @ dz, "out_bias": dz.sum(keepdims=True),
        }

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 6) -> QualityModel:
        """Adam on chunks, then a logistic calibration of whole-document logits."""
        if not len(texts):
            return self
        r = np.random.default_rng(seed)
        chunks, filled, ys = [], [], []
        for t, y in zip(texts, labels, strict=True):
            padded, _ = _padded(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
            padded = np.append(padded, np.zeros(SEGMENT, np.uint8)) if len(padded) == SEGMENT else padded
            starts = np.arange(len(padded) // SEGMENT - 1)
            for s in starts[np.unique(np.linspace(0, len(starts) - 1, CHUNKS).astype(int))]:
                chunk, n = padded[s * SEGMENT : (s + 2) * SEGMENT], min(len(t) - s * SEGMENT, 2 * SEGMENT)
                chunks.append(chunk)
                filled.append(n)
                ys.append(y)
                if n > 8 and r.random() < SHORT:  # a short text like this chunk's end
                    m = int(n ** r.uniform(0.5, 1))
                    chunks.append(np.append(chunk[n - m : n], np.zeros(2 * SEGMENT - m, np.uint8)))
                    filled.append(m)
                    ys.append(y)
        x, f, y = np.array(chunks), np.array(filled, np.float32), np.array(ys, np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = r.permutation(len(x))
            for i in range(0, len(x), BATCH):
                step += 1
                pick = order[i : i + BATCH]
                for k, g in self._gradient(x[pick], f[pick], y[pick]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        sizes = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=sizes[1:])
        z = np.concatenate([self.document_logits(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts])
        self._calibrate(z, np.asarray(labels, float))
        return self

    def _calibrate(self, z: np.ndarray, y: np.ndarray) -> None:
        """Newton steps of a two-parameter logistic regression with a small ridge."""
        w = np.array([1.0, 0.0])
        x = np.stack([z, np.ones_like(z)], 1)
        for _ in range(30):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (q - y) + 0.1 * (w - [1.0, 0.0])
            hess = (x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(2)
            w = w - np.clip(np.linalg.solve(hess, g), -2, 2)
        self.scale, self.shift = max(float(w[0]), 0.05), float(w[1])


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", limit: int = DOCUMENTS) -> QualityModel:
    """A model from the labelled documents with the smallest id hashes, *limit* at most.

    Null ids and labels are left out, a null text counts as empty.  Labels of ids that documents
    lacks are not used, so the limit is taken after a join of ids alone; texts are read for the sample only.
    Of a repeated id the first text in sorting order is taken, and the mean of its labels.
    """
    keys = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    marks = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).groupBy("id").agg(F.avg("y").alias("y"))
    chosen = keys.join(marks, "id").withColumn("h", F.xxhash64(F.col("id").cast("string"))).orderBy("h", "id").limit(limit)
    text = F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, SAMPLE_CHARS).alias("text")
    rows = documents.select(F.col(id_col).alias("id"), text).join(F.broadcast(chosen), "id").groupBy("id", "h", "y").agg(F.min("text").alias("text")).collect()  # limit rows
    rows.sort(key=lambda r: (r["h"], r["id"], r["text"]))
    return QualityModel().fit([r["text"].encode("utf-8", "replace") for r in rows], np.array([r["y"] for r in rows], np.float32))


def score_quality(df: DataFrame, model: QualityModel, text_col: str = "text", score_out: str = "score", predicted_out: str = "predicted", threshold: float = THRESHOLD) -> DataFrame:
    """df with the probability of label 1 and whether it reaches the threshold.

    Null and empty texts are scored alike, as one chunk of padding.  Columns of the output
    names are replaced, all others pass through; repeated rows get equal scores.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # fixed size

    def make():
        m = shared.value

        def run(batch: pa.RecordBatch) -> list:
            p = np.concatenate([m.probability(data, at) for _, _, data, at in blocks(batch.column(text_col), 1 << 20)])
            return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

        return run

    return add_columns(df, [(score_out, T.DoubleType()), (predicted_out, T.IntegerType())], make)
