"""Language identification by nearest centroid.

A text becomes a vector of hashed byte n-grams (of two and three bytes, A-Z lower-cased): logarithmic counts times inverse
document frequency, normalised. Each language has several centroids from spherical k-means over a bounded sample of
its labelled rows. A text gets the language of the centroid with the largest cosine; farther from it than nearly all of
that centroid's own training texts, it is marked rejected, and the language stays as the best guess.

Defined cases: a null text or one without a letter is `und` with score 0; with no labelled rows at all everything
is; repeated rows are predicted alike and learned from once; null languages and rows without an id are never learned; of rows with one id and
language the least text is learned from; a text of any length is counted in windows; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, drawn, sliced
from .shingles import WINDOW

DIMS = 4096
#: The bound of the fit: labelled texts for each language.
SAMPLE = 400
CENTROIDS = 4
#: A text is rejected beyond this quantile of the distances of a centroid's training texts, times SLACK.
REJECT_QUANTILE, SLACK = 0.99, 1.25
#: Bytes of ASCII that are no letters count as one separator; n-grams with two of them in a row say nothing.
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x DIMS counts of the rows' n-grams."""
    rows, n = len(offsets) - 1, len(raw)
    if n < 2:
        return np.zeros((rows, DIMS), np.float32)
    out = np.zeros(rows * DIMS, np.int64)
    for lo in range(0, n, WINDOW):  # the n-grams that begin in a window, which is read two bytes further
        b = _FOLD[raw[lo : lo + WINDOW + 2]]
        row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(np.clip(offsets, lo, lo + len(b)))) * DIMS
        two = b[:-1] * np.uint32(256) + b[1:]
        said = (b[:-1] != 32) | (b[1:] != 32)
        for size, code in ((2, two), (3, two[:-1] * np.uint32(256) + b[2:] + np.uint32(1 << 24))):
            m = min(WINDOW, len(b) - size + 1)
            if m <= 0:
                continue
            at = ((code[:m] * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
            inside = (row[:m] == row[size - 1 : size - 1 + m]) & said[:m] & said[size - 2 : size - 2 + m]
            out += np.bincount((row[:m] + at)[inside], minlength=rows * DIMS)
    return out.reshape(rows, DIMS).astype(np.float32)


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(c) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that may be learned from; those held out have crc32(id as text) mod 4 = 2."""
    return ~held_out(id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", 1 << 20):
        c = np.minimum(counts(*bytes_of(batch.column("text"))), 65535).astype(np.uint16)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array([x.tobytes() for x in c], pa.binary())], ["doc_id", "lang", "c"])


def _clusters(x: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart first centres: the centroids, and the greatest usual distance to each."""
    centres = [x.mean(0)]
    for _ in range(min(k, len(x)) - 1):
        centres.append(x[np.argmin(np.max(x @ np.array(centres).T, axis=1))])
    c = np.array(centres)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].mean(0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    cos = x @ c.T
    near, far = np.argmax(cos, axis=1), np.zeros(len(c))
    for j in range(len(c)):
        own = 1 - cos[near == j, j]
        far[j] = SLACK * np.quantile(own if len(own) else 1 - cos.max(1), REJECT_QUANTILE)
    return c, far


def fit(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> dict | None:
    """The model: languages of the centroids, centroids, rejection distances and idf. Of each language at most
    `sample` labelled documents, chosen by a hash of their ids, are read; their counts (8 KB each) come to the driver."""
    known = docs.where(learnable() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & has_letter()).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    chosen, sizes = drawn(known.select("doc_id", "lang"), "lang", sample, 6)
    if not sizes:
        return None
    once = known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    rows = once.mapInArrow(_count_rows, "doc_id long, lang string, c binary").collect()
    taken: dict[str, list[np.ndarray]] = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        taken.setdefault(r["lang"], []).append(np.frombuffer(r["c"], np.uint16).astype(np.float32))
    every = [c for lang in sorted(taken) for c in taken[lang]]
    idf = (np.log((1 + len(every)) / (1 + sum((c > 0).astype(np.int64) for c in every))) + 0.1).astype(np.float32)
    langs, centres, far = [], [], []
    for lang in sorted(taken):
        c, f = _clusters(vectors(np.array(taken[lang]), idf), k)
        langs += [lang] * len(c)
        centres.append(c)
        far.append(f)
    return {"langs": langs, "centres": np.concatenate(centres).astype(np.float32), "far": np.concatenate(far), "idf": idf}


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine), rejected. Only text takes part in a prediction."""
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), has_letter().alias("letter"), "text")
    if model is None:
        return ready.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = np.array(m["langs"], dtype=object)
        for batch in sliced(batches, "text", 2 << 20):
            if batch.num_rows > 2048:
                parts = [batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)]
            else:
                parts = [batch]
            for part in parts:
                cos = vectors(counts(*bytes_of(part.column("text"))), m["idf"]) @ m["centres"].T
                best = np.argmax(cos, axis=1)
                top = cos[np.arange(len(best)), best].astype(np.float64)
                letter = part.column("letter").to_numpy(zero_copy_only=False).astype(bool)
                lang = np.where(letter, names[best], "und")
                score = np.where(letter, np.clip(top, 0, 1), 0.0)
                rejected = ~letter | (1 - top > m["far"][best])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return ready.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def language_id(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs))
