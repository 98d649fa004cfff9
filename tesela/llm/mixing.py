"""Mixing sources to target weights by soft membership.

A multinomial naive-Bayes classifier learns from the labelled table which domain a document belongs to
(clean, low quality, toxic) and gives every document posteriors over the domains instead of one class. Document
rates r >= 0 then minimise the squared distance between the expected tokens of each domain, sum of r * tokens *
posterior, and its target, by projected gradient descent from r = 1. A round is one distributed aggregation to one
number per domain; a document's rate follows from its posteriors and the gradients so far, so no state per document
is kept.

A document is written floor(r) times, and once more with the chance of the rest, drawn by a hash of doc_id. The
targets are the weights times one total, at which the domain of the greatest weight keeps its tokens (without
any of it, the tokens of all). A domain with less than its share is raised by rates above 1. One without mass (no word in
a document for which it is the likeliest) cannot be raised, as traces in the documents of other domains would have to
crowd those out: its target stays, and the tokens that are reached say so beside it.

Defined cases: a null or empty text has no tokens, the prior as posterior and a rate like any other; without
labels every posterior is uniform; null labels are none; of several labels of a document the largest count;
repeated rows have one rate and one draw (rows without an id draw by their text); of documents with one id the least text is
learned from; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, drawn, sliced, small_batches, stored
from .shingles import word_hashes

LOG = logging.getLogger(__name__)
DOMAINS = ("clean", "low", "toxic")
#: Target weights of the domains in the mixture's tokens.
WEIGHTS = {"clean": 0.90, "low": 0.04, "toxic": 0.06}
#: Word classes, and the words at which evidence is held: the log likelihoods of a longer text count as those of so many
#: words with the same mean, as naive Bayes would else be certain of every long text and memberships no longer soft.
FEATURES, EVIDENCE = 1 << 14, 40
#: The bound of the classifier's fit: labelled documents of each domain.
SAMPLE = 3000
ROUNDS = 20


def domain() -> Column:
    return F.when(F.col("toxic") > 0, 2).when(F.col("quality") > 0, 0).otherwise(1)


def _features(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Word classes of all rows in one array, and where each row's begin."""
    hashes, at = word_hashes(*bytes_of(batch.column(column)))
    return (hashes >> np.uint64(50)).astype(np.int64), at


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(DOMAINS), FEATURES), np.int64)
    docs = np.zeros(len(DOMAINS), np.int64)
    for batch in sliced(batches, "text"):
        words, at = _features(batch)
        for k, a, z in zip(batch.column("domain").to_pylist(), at[:-1], at[1:], strict=True):
            total[k] += np.bincount(words[a:z], minlength=FEATURES)
            docs[k] += 1
    k, f = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(f, pa.int32()), pa.array(total[k, f], pa.int64())], ["k", "f", "n"])
    yield pa.RecordBatch.from_arrays([pa.array(range(len(DOMAINS)), pa.int32()), pa.array([-1] * len(DOMAINS), pa.int32()), pa.array(docs, pa.int64())], ["k", "f", "n"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Log priors (column 0) and log likelihoods of the word classes, a row for each domain. At most `sample` labelled
    documents of each domain are learned from; their counts meet in DOMAINS x FEATURES numbers at most."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")).withColumn("domain", domain())
    chosen, sizes = drawn(known.select("doc_id", "domain"), "domain", sample, 4)
    model = np.zeros((len(DOMAINS), FEATURES + 1))
    if not sizes:
        model[:, 0] = np.log(1 / len(DOMAINS))
        model[:, 1:] = np.log(1 / FEATURES)
        return model
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text"))  # `sample` ids of each domain at most
    counts = np.zeros((len(DOMAINS), FEATURES + 1))
    with small_batches(docs.sparkSession, 2000):
        found = rows.mapInArrow(_class_counts, "k int, f int, n long").groupBy("k", "f").agg(F.sum("n").alias("n")).collect()
    for r in found:
        counts[r["k"], r["f"] + 1] = r["n"]
    prior = np.array([sizes.get(k, 0) + 1 for k in range(len(DOMAINS))], float)
    model[:, 0] = np.log(prior / prior.sum())
    words = counts[:, 1:] + 0.5
    model[:, 1:] = np.log(words / words.sum(1, keepdims=True))
    return model


def posteriors(docs: DataFrame, model: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns keep of docs with __n, a text's words, and __p, the posterior of each domain."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(keep).withColumns({"__n": F.lit(0).cast("long"), "__p": F.array().cast("array<double>")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, like = sent.value[:, 0], sent.value[:, 1:]
        for batch in sliced(batches, "__text"):
            words, at = _features(batch, "__text")
            n = np.diff(at)
            sums = np.zeros((len(like), len(words) + 1))
            np.cumsum(like[:, words], axis=1, out=sums[:, 1:])
            total = (sums[:, at[1:]] - sums[:, at[:-1]]) * np.minimum(1, EVIDENCE / np.maximum(n, 1))
            logit = (prior[:, None] + total).T
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * len(like))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(p.reshape(-1)))], [*keep, "__n", "__p"])

    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def _rate(steps: list[list[float]]) -> Column:
    """The rate after the gradient steps: max(0, r - step . p), round by round, from 1."""
    if not steps:
        return F.lit(1.0)
    listed = F.lit([x for s in steps for x in s])
    d = len(DOMAINS)
    move = lambda k: sum((F.get(listed, k * d + i) * F.col("__p")[i] for i in range(d)), F.lit(0.0))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), F.lit(1.0), lambda r, k: F.greatest(F.lit(0.0), r - move(k)))


def fit_rates(soft: DataFrame, weights: dict[str, float] = WEIGHTS, rounds: int = ROUNDS) -> tuple[Column, np.ndarray, np.ndarray]:
    """From rows __n, __p: the rate as an expression over __p, the domains' targets, and the expected tokens that
    the rates reach. A gradient step is scaled by the inverse of the domains' second moments, which bounds the curvature
    of any set of documents with rates above 0."""
    d = len(DOMAINS)
    tokens = lambda rate: [F.sum(F.col("__n") * F.col("__p")[i] * rate).alias(f"t{i}") for i in range(d)]
    moments = [F.sum(F.col("__n") * F.col("__p")[i] * F.col("__p")[j]).alias(f"m{i}{j}") for i in range(d) for j in range(d)]
    own = [F.sum(F.when(F.col("__p")[i] >= F.array_max("__p"), F.col("__n")).otherwise(0)).alias(f"o{i}") for i in range(d)]
    first = [x or 0.0 for x in soft.agg(*tokens(F.lit(1.0)), *own, *moments).first()]
    have, mass, curve = np.array(first[:d]), np.array(first[d : 2 * d]) > 0, np.array(first[2 * d :]).reshape(d, d)
    share = np.array([weights[k] for k in DOMAINS]) / sum(weights.values())
    anchor = int(np.argmax(share))
    target = share * (have[anchor] / share[anchor] if mass[anchor] else have.sum())
    scale = np.zeros((d, d))
    scale[np.ix_(mass, mass)] = np.linalg.pinv(curve[np.ix_(mass, mass)], rcond=1e-9, hermitian=True)
    steps: list[list[float]] = []
    reached = have
    for _ in range(rounds):
        gap = np.where(mass, reached - target, 0)
        if np.abs(gap).max() <= 1e-3 * max(1.0, target.sum()):
            break
        steps.append((scale @ gap).tolist())
        before, reached = reached, np.array([x or 0.0 for x in soft.agg(*tokens(_rate(steps))).first()])
        if np.abs(reached - before).max() <= 1e-7 * max(1.0, target.sum()):  # the least squares have their minimum short of the target
            break
    if np.abs(reached - target).max() > 2e-3 * max(1.0, target.sum()):
        LOG.warning("the mixture misses its targets: %s", ", ".join(f"{k} {r:.0f} of {t:.0f} tokens" for k, r, t in zip(DOMAINS, reached, target, strict=True)))
    return _rate(steps), target, reached


def copies_of(rate: Column, id_col: str) -> Column:
    """floor(rate), and one more with the chance of the rest by a hash of the id, or of the text (__h) without one."""
    u = F.pmod(F.xxhash64(F.coalesce(F.col(id_col), F.col("__h")), F.lit(44)), F.lit(1_000_003).cast("long")) / F.lit(1_000_003.0)
    return F.floor(rate + u).cast("int")


def _own_hash() -> Column:
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text"))


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """doc_id, n_tokens, p_clean, p_low, p_toxic, rate, copies for every row of docs (doc_id, text), and on each row the
    tokens of each domain that the mixture should have (target_clean, ...) and those that the rates reach (reached_clean, ...)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _own_hash().alias("__h"))
    model = fit(docs, labels)
    with small_batches(docs.sparkSession, 2000):
        soft = stored(posteriors(ids, model, ["doc_id", "__h"]), "op4-soft")
    rate, target, reached = fit_rates(soft, weights)
    rated = soft.withColumn("rate", rate)
    totals = [F.lit(float(x[i])).alias(f"{name}_{k}") for name, x in (("target", target), ("reached", reached)) for i, k in enumerate(DOMAINS)]
    return rated.select("doc_id", F.col("__n").alias("n_tokens"), *[F.col("__p")[i].alias(f"p_{k}") for i, k in enumerate(DOMAINS)], "rate", copies_of(F.col("rate"), "doc_id").alias("copies"), *totals)


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """docs, each row as often as its copies say, with its own columns. Texts are written once beside their
    posteriors and never shuffled."""
    own = docs.columns
    model = fit(docs, labels)
    with small_batches(docs.sparkSession, 2000):
        wide = stored(posteriors(docs.withColumn("__h", _own_hash()), model, [*own, "__h"]), "op4-docs")
    rate = fit_rates(wide.select("__n", "__p"), weights)[0]
    counted = wide.withColumn("__copies", copies_of(rate, "doc_id")).where("__copies > 0")
    return counted.select(*own, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__k")).select(*own)
