"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly in numpy.

A bag is a window of words. Its vector is the average of the embeddings of the
hashed byte n-grams of its words, so a misspelling or a new form of a word
shares the vectors of the n-grams it keeps. Embeddings and softmax weights are
learned together. A document's label says only that some window is toxic: in
training, a toxic document's highest windows stand for it, a clean document
gives all its windows; a document's score is that of its highest window.

Scoring needs one number per n-gram, the softmax difference of its embedding,
so the model sent to the tasks is one table of fixed size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penstock.llm import grams, text_bytes
from penstock.llm.store import prepared

GRAMS = (3, 4, 5)
#: A window with fewer n-grams is averaged as if it had so many.
LEAST_GRAMS = 100


#: Drawn ids never exceed so many times ``Fit.rows``: two labels, each drawn with a share that gives about that many.
DRAWN = 4


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the training.

    ``rows``: labelled rows learned from, at most about this many of either
    label, drawn by a hash of the id; ``longest``: code points of a row that
    is learned from, longer ones are only scored. Both bound what training holds.
    """

    rows: int = 2_000
    longest: int = 60_000
    window: int = 16
    buckets: int = 1 << 18
    size: int = 8
    epochs: int = 25
    rate: float = 0.5
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """``logit`` of a window: average of ``weights`` over its n-grams, plus ``bias``."""

    weights: np.ndarray
    bias: float
    window: int

    def window_logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit and text number of every window of a slice."""
        text, places, owner = grams.normalised(data, offsets)
        begin, owner = _windows(places, owner, self.window)
        if not len(owner):
            return np.zeros(0), owner
        sums, counts = np.zeros(len(text) + 1), np.zeros(len(text) + 1)
        mask = np.uint32(len(self.weights) - 1)
        for at, codes in grams.hashed(text, GRAMS):
            sums[:-1] += np.bincount(at, self.weights[codes & mask], len(text))
            counts[:-1] += np.bincount(at, minlength=len(text))
        average = np.add.reduceat(sums, begin) / np.maximum(np.add.reduceat(counts, begin), LEAST_GRAMS)
        return average + self.bias, owner

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The highest window of each text; ``bias`` for a text without words."""
        out = np.full(len(offsets) - 1, -np.inf)
        found, owner = self.window_logits(data, offsets)
        np.maximum.at(out, owner, found)
        return np.where(np.isfinite(out), out, min(self.bias, -1.0))


def _windows(places: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each window of ``size`` words (the last of a text up to twice that), and its text."""
    number = np.arange(len(owner))
    place = number - np.searchsorted(owner, owner, side="left")
    after = np.searchsorted(owner, owner, side="right") - number
    opens = (place % size == 0) & ((place == 0) | (after >= size))
    return places[opens], owner[opens]


def train(texts: list[str], labels: np.ndarray, fit: Fit = Fit()) -> Model:
    """A model from whole texts and their labels (1: toxic)."""
    column = pa.array(texts, pa.string())
    bag_grams, bag_size, bag_doc = [], [], []
    for first, _, data, offsets in text_bytes.slices(column):
        text, places, owner = grams.normalised(data, offsets)
        begin, owner = _windows(places, owner, fit.window)
        found = grams.hashed(text, GRAMS)
        at = np.concatenate([a for a, _ in found])
        codes = np.concatenate([c for _, c in found]) & np.uint32(fit.buckets - 1)
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], begin)
        if len(owner):
            bag_grams.append(codes[order].astype(np.int32))
            bag_size.append(np.diff(np.append(edges, len(order))))
            bag_doc.append(owner + first)
    doc = np.concatenate(bag_doc) if bag_doc else np.zeros(0, np.int64)
    if not len(doc) or labels.min() == labels.max():
        return Model(np.zeros(fit.buckets, np.float32), -5.0 if not len(labels) or labels.max() == 0 else 5.0,
                     fit.window)
    counts = np.concatenate(bag_size)
    flat = np.concatenate(bag_grams)
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    mass = np.maximum(counts, LEAST_GRAMS)
    random = np.random.default_rng(fit.seed)
    vectors = random.uniform(-1 / fit.size, 1 / fit.size, (fit.buckets, fit.size)).astype(np.float32)
    softmax = np.zeros((2, fit.size), np.float32)
    softmax[1] = random.normal(0, 0.5, fit.size)
    bias = np.zeros(2, np.float32)
    seen_v, seen_s, seen_b = (np.full(x.shape, 1e-6, np.float32) for x in (vectors, softmax, bias))
    truth = labels[doc]

    def difference() -> np.ndarray:
        per_gram = vectors @ (softmax[1] - softmax[0])
        total = np.add.reduceat(per_gram[flat], np.minimum(begin, len(flat) - 1))
        return np.where(counts > 0, total / mass, 0) + bias[1] - bias[0]

    for epoch in range(fit.epochs):
        logit = difference()
        best = np.full(len(labels), -np.inf)
        np.maximum.at(best, doc, logit)
        # at first every window; then of toxic documents those close to the highest, of clean ones those
        # that score high and a tenth of the others
        hard = (logit > -4) | (random.random(len(doc)) < 0.1)
        used = (epoch < 2) | np.where(truth == 1, logit >= best[doc] - 0.5, hard)
        bags = np.flatnonzero(used & (counts > 0))
        random.shuffle(bags)
        share = np.bincount(truth[bags], minlength=2)
        weight = np.where(truth == 1, share[0] / max(1, share[1]), 1.0).astype(np.float32)
        weight = np.minimum(weight, 20)
        for batch in np.array_split(bags, max(1, len(bags) // 128)):
            size = counts[batch]
            rows = np.repeat(np.arange(len(batch)), size)
            ids = flat[np.repeat(begin[batch] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            edges = np.cumsum(size) - size
            mean = np.add.reduceat(vectors[ids], edges, axis=0) / mass[batch, None]
            score = mean @ softmax.T + bias
            score = np.exp(score - score.max(axis=1, keepdims=True))
            error = score / score.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), truth[batch]] -= 1
            error *= weight[batch, None] / weight[batch].mean()
            step_s, step_b = error.T @ mean / len(batch), error.mean(axis=0)
            back = (error @ softmax) / mass[batch, None]
            touched, place = np.unique(ids, return_inverse=True)
            step_v = np.stack([np.bincount(place, back[rows, d], len(touched)) for d in range(fit.size)], axis=1)
            seen_v[touched] += step_v ** 2
            vectors[touched] -= (fit.rate * step_v / np.sqrt(seen_v[touched])).astype(np.float32)
            seen_s += step_s ** 2
            softmax -= 0.2 * fit.rate * step_s / np.sqrt(seen_s)
            seen_b += step_b ** 2
            bias -= 0.2 * fit.rate * step_b / np.sqrt(seen_b)
    logit = difference()
    best = np.full(len(labels), -np.inf)
    np.maximum.at(best, doc, logit)
    held = np.isfinite(best)
    return Model((vectors @ (softmax[1] - softmax[0])).astype(np.float32),
                 float(bias[1] - bias[0]) - _threshold(best[held], labels[held]), fit.window)


def _threshold(logit: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the gap between logits that makes the fewest errors."""
    order = np.argsort(logit)
    logit, labels = logit[order], labels[order]
    missed = np.concatenate([[0], np.cumsum(labels)])
    false = (labels == 0).sum() - np.concatenate([[0], np.cumsum(labels == 0)])
    cost = missed + false
    ties = np.flatnonzero(cost == cost.min())
    edges = np.concatenate([[logit[0] - 1], (logit[1:] + logit[:-1]) / 2, [logit[-1] + 1]])
    gaps = np.concatenate([[0], logit[1:] - logit[:-1], [0]])
    return float(edges[ties[np.argmax(gaps[ties])]])


def fitted(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic") -> Model:
    """A model from ``labels`` joined to ``docs``; the caller leaves out the rows it holds back.

    Rows with a null id, text or label, and labels other than 0 and 1, are not
    learned from. Without any usable row, or with one label only, the model
    gives every text the same score.
    """
    prepared(docs.sparkSession)
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label")) \
        .where("id IS NOT NULL AND label IN (0, 1)").dropDuplicates(["id"])
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    # a share of each label that keeps about fit.rows of it, the same rows in every run
    share = F.lit(0.0)
    for label, size in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, fit.rows / max(size, 1))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit(fit.seed), "id"), F.lit(1 << 30)) < share * (1 << 30)
    # so few that every task gets them; texts stay where they are until the drawn ones are picked
    drawn = F.broadcast(known.where(draw).limit(DRAWN * fit.rows))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")) \
        .where(F.length("text") <= fit.longest).join(drawn, "id").select("id", "text", "label")

    def learn(sample: pa.Table) -> pa.Table:
        ordered = sample.sort_by([("id", "ascending"), ("text", "ascending")])
        model = train(ordered.column("text").to_pylist(), ordered.column("label").to_numpy().astype(np.int64), fit)
        return pa.table({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    # one task: the sample is bounded by Fit
    found = rows.withColumn("sample", F.lit(0)).groupBy("sample").applyInArrow(learn, "weights binary, bias double").first()
    if found is None:
        return train([], np.zeros(0, np.int64), fit)
    return Model(np.frombuffer(found["weights"], np.float32), found["bias"], fit.window)


def scores(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function from a column of texts to their scores, 0 to 1, higher where toxic is likelier."""
    sent = prepared(spark).sparkContext.broadcast(model)  # one table of fixed size

    def score(texts: pa.Array) -> pa.Array:
        found = [1 / (1 + np.exp(-np.clip(sent.value.logits(data, offsets), -50, 50)))
                 for _, _, data, offsets in text_bytes.slices(texts)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return F.arrow_udf(score, "double")


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for each row: score in 0 to 1, predicted 1 from 0.5 on.

    A null or empty text, or one without words, scores low. Null and repeated
    ids come back as they are. Other columns play no role. An empty table
    gives no rows.
    """
    score = scores(docs.sparkSession, model)(F.col(f"`{text_col}`").cast("string"))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), score.alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
