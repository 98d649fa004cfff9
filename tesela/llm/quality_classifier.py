"""Quality classifier: a byte-level convolutional network in numpy.

A document is covered by chunks of 526 bytes, a new one every 512. Each byte has a learned embedding; learned filters
of 16 bytes slide over a chunk in steps of 2, their responses are rectified and max-pooled over the chunk, and the mean
of a document's pooled chunks gives one logit and probability. Every byte of every document is read.

The fit learns from a bounded sample: SAMPLE documents of each class, drawn by a hash of doc_id, and of each up to
LEARNED chunks spread evenly over the whole text, however long. They come to the driver (17 KB a document at most), where numpy
fits with Adam. Defined cases: a null or empty text is one chunk of padding and gets a score; without
labels every score is 0.5; of several labels of one document the largest counts; null quality is no label; repeated rows are
learned from once, and of rows with one id the least text; a text of any length is scored in parts; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, drawn, sliced

CHUNK, WIDTH, STRIDE = 512, 16, 2
#: Bytes of a chunk: a filter's last place begins STRIDE bytes before the next chunk.
SPAN = CHUNK + WIDTH - STRIDE
EMBED, FILTERS = 6, 32
#: The bound of the fit: labelled documents of each class, and chunks of each document.
SAMPLE, LEARNED = 1200, 32
EPOCHS, BATCH, RATE = 8, 48, 0.01
THRESHOLD = 0.3


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def chunk_counts(offsets: np.ndarray) -> np.ndarray:
    """Where each row's chunks begin (one more at the end)."""
    first = np.zeros(len(offsets), np.int64)
    np.cumsum(np.maximum(1, -(-np.diff(offsets) // CHUNK)), out=first[1:])
    return first


def chunks(raw: np.ndarray, offsets: np.ndarray, first: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The bytes of the chunks of these numbers (n x SPAN), padded with 0."""
    row = np.searchsorted(first, which, "right") - 1
    at = (offsets[row] + (which - first[row]) * CHUNK)[:, None] + np.arange(SPAN)
    inside = at < offsets[row + 1][:, None]
    padded = raw if len(raw) else np.zeros(1, np.uint8)
    return np.where(inside, padded[np.minimum(at, len(padded) - 1)], 0).astype(np.uint8)


def spread(first: np.ndarray, most: int = LEARNED) -> list[np.ndarray]:
    """For each row the numbers of at most `most` of its chunks, evenly spread."""
    return [np.arange(a, z) if z - a <= most else a + np.arange(most) * (z - a - 1) // (most - 1) for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


class Net:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        reach = WIDTH * EMBED
        self.p = {"e": normal(0.5, 256, EMBED), "w": normal(reach**-0.5, reach, FILTERS), "c": np.zeros(FILTERS, np.float32), "v": normal(FILTERS**-0.5, FILTERS), "d": np.zeros(1, np.float32)}

    def pooled(self, data: np.ndarray, keep: bool = False):
        """n x FILTERS, the largest response of each filter in each chunk, at least 0; with keep also the largest ones as they
        are and the bytes where they begin."""
        p, n = self.p, len(data)
        x = p["e"][data]
        best = place = None
        for phase in range(0, WIDTH, STRIDE):  # the filter's places that are WIDTH apart are one product
            h = x[:, phase : phase + CHUNK].reshape(n, CHUNK // WIDTH, WIDTH * EMBED) @ p["w"]  # a view; chunk by chunk, in one thread
            top = h.max(1)
            if keep:
                spot = h.argmax(1) * WIDTH + phase
                place = spot if place is None else np.where(top > best, spot, place)
            best = top if best is None else np.maximum(best, top)
        best = best + p["c"]
        return (np.maximum(best, 0), best, place) if keep else np.maximum(best, 0)

    def logits(self, pooled: np.ndarray, first: np.ndarray) -> np.ndarray:
        means = np.add.reduceat(pooled, first[:-1], axis=0) / np.diff(first)[:, None]
        return means @ self.p["v"] + self.p["d"][0]

    def score(self, raw: np.ndarray, offsets: np.ndarray, most: int = 256) -> np.ndarray:
        if len(offsets) < 2:
            return np.zeros(0)
        first = chunk_counts(offsets)
        pooled = np.concatenate([self.pooled(chunks(raw, offsets, first, np.arange(i, min(i + most, first[-1])))) for i in range(0, first[-1], most)])
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled, first).astype(np.float64), -30, 30)))

    def gradients(self, data: np.ndarray, first: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict:
        """Of the weighted mean log loss of rows with chunks data[first[k]:first[k + 1]]."""
        p, n = self.p, len(data)
        pooled, best, place = self.pooled(data, True)
        k = np.diff(first)
        means = np.add.reduceat(pooled, first[:-1], axis=0) / k[:, None]
        out = 1 / (1 + np.exp(-np.clip(means @ p["v"] + p["d"][0], -30, 30)))
        g = ((out - y) * w / len(y)).astype(p["v"].dtype)
        row = np.repeat(np.arange(len(k)), k)
        up = (g / k)[row][:, None] * p["v"] * (best > 0)
        seen = data[np.arange(n)[:, None, None], place[:, :, None] + np.arange(WIDTH)]  # n x FILTERS x WIDTH bytes
        x = p["e"][seen].reshape(n, FILTERS, WIDTH * EMBED)
        grads = {"v": means.T @ g, "d": np.array([g.sum()]), "c": up.sum(0), "w": np.einsum("nfi,nf->if", x, up)}
        back = (up[:, :, None] * p["w"].T[None]).reshape(-1, EMBED)
        flat = seen.reshape(-1)
        return grads | {"e": np.stack([np.bincount(flat, weights=back[:, c], minlength=256) for c in range(EMBED)], 1)}


def train(texts: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Net:
    """texts: the chunks (n x SPAN) of each document."""
    net, rng = Net(seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    t = 0
    order = np.argsort([len(x) for x in texts], kind="stable")
    batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            pick = batches[k]
            first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in pick])])
            data = np.concatenate([texts[i] for i in pick])
            t += 1
            rate = RATE * (0.3 if epoch >= epochs - 2 else 1)
            for key, g in net.gradients(data, first, y[pick], np.ones(len(pick), np.float32)).items():
                m[key] = 0.9 * m[key] + 0.1 * g
                s[key] = 0.99 * s[key] + 0.01 * g * g
                net.p[key] = (net.p[key] - rate * (m[key] / (1 - 0.9**t)) / (np.sqrt(s[key] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
    return net


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", 2 << 20):
        raw, offsets = bytes_of(batch.column("text"))
        first = chunk_counts(offsets)
        data = [chunks(raw, offsets, first, which).tobytes() for which in spread(first)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(data, pa.binary())], ["doc_id", "quality", "data"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Net | None:
    """The network, from at most `sample` documents of each class; label and text only are used."""
    known = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") > 0).cast("int")).alias("quality"))
    chosen, sizes = drawn(known, "quality", sample, 10)
    if not sizes:
        return None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    once = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = sorted(once.mapInArrow(_learned, "doc_id long, quality int, data binary").collect(), key=lambda r: r["doc_id"])
    return train([np.frombuffer(r["data"], np.uint8).reshape(-1, SPAN) for r in rows], [r["quality"] for r in rows]) if rows else None


def predict(docs: DataFrame, net: Net | None) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    scored = "doc_id long, held_out boolean, score double"
    if net is None:
        out = ready.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(net.p)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Net()
            model.p = sent.value
            for batch in sliced(batches, "text", 2 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(model.score(*bytes_of(batch.column("text"))))], ["doc_id", "held_out", "score"])

        out = ready.mapInArrow(run, scored)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, fit(docs, labels))
