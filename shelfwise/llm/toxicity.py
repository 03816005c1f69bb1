"""Toxicity scores from a linear classifier over scaled character n-grams.

A text is the set of its character n-grams (n = 3 to 5, hashed). Each gram is scaled by its
naive Bayes log-count ratio: the logarithm of the share of toxic texts that have it over the
share of the others. Logistic regression on the scaled features gives the weights.

The model is fitted on a bounded sample of labelled texts (SAMPLE per label, of at most
SAMPLE_CHARS characters) and the FEATURES grams whose ratios are surest. Every text is scored
whole.

Defined results: null and empty texts get the score of a text without grams; several labels of
one document count as toxic if one is; null labels and labels without a document teach nothing;
without both labels every score is 0; null ids are scored but never learned from; an id with
several texts teaches the first of them in their order; repeated rows get equal scores; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.samples import BITS, bounded_sample, gram_codes, learnable
from shelfwise.llm.store import needs, workers_import

ORDERS = (3, 4, 5)
#: Texts per label (0, 1) that the model sees at most, roughly.
SAMPLE = {0: 4000, 1: 2000}
SAMPLE_CHARS = 20_000
FEATURES = 2048
#: A gram must occur in so many sampled texts.
MIN_TEXTS = 3
L2 = 1e-3
STEPS = 300
THRESHOLD = 0.3


class Model:
    """`weight[place[gram]]` summed over a text's grams, and a bias."""

    def __init__(self, texts: list[str], toxic: np.ndarray, prior: float):
        grams = [np.unique(gram_codes(t, ORDERS)) for t in texts]
        counts = np.zeros((2, 1 << BITS), np.int32)
        for codes, label in zip(grams, toxic, strict=True):
            counts[label][codes] += 1
        sizes = np.array([(toxic == 0).sum(), (toxic == 1).sum()], float)
        smooth = counts + 0.5
        ratio = np.log(smooth[1] / (sizes[1] + 1)) - np.log(smooth[0] / (sizes[0] + 1))
        sure = np.abs(ratio) / np.sqrt(1 / smooth[0] + 1 / smooth[1])
        sure[counts.sum(axis=0) < MIN_TEXTS] = -1
        chosen = np.argsort(-sure, kind="stable")[:FEATURES]
        self.grams = np.sort(chosen[sure[chosen] > 0])
        scale = ratio[self.grams]
        place = self.places()
        rows = np.zeros((len(texts), len(self.grams)), np.float32)
        for k, codes in enumerate(grams):
            at = place[codes]
            rows[k, at[at >= 0]] = 1
        rows *= scale.astype(np.float32)
        weights, bias = _fit(rows, toxic)
        self.weights = weights * scale
        # The sample has its own share of toxic texts; the bias goes back to the labels' share.
        share = toxic.mean()
        self.bias = bias + np.log(prior / (1 - prior)) - np.log(share / (1 - share))

    def places(self) -> np.ndarray:
        place = np.full(1 << BITS, -1, np.int32)
        place[self.grams] = np.arange(len(self.grams), dtype=np.int32)
        return place

    def score(self, text: str, place: np.ndarray) -> float:
        at = place[gram_codes(text, ORDERS)]
        total = self.weights[np.unique(at[at >= 0])].sum() + self.bias
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def _fit(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty by accelerated gradient steps."""
    n, width = rows.shape
    y = labels.astype(np.float32)
    v = np.ones(width, np.float32)
    top = 1.0
    for _ in range(20):  # the largest singular value bounds the curvature
        v = rows.T @ (rows @ v)
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    step = 1 / (0.25 * (top / n + 1) + L2)
    w = ahead = np.zeros(width, np.float32)
    b = b_ahead = 0.0
    for t in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(rows @ ahead + b_ahead, -30, 30)))
        new_w = ahead - step * (rows.T @ (p - y) / n + L2 * ahead)
        new_b = b_ahead - step * float((p - y).mean())
        pull = (t - 1) / (t + 2)
        ahead, b_ahead = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return w.astype(np.float64), b


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, rest: int = 2,
          sample: dict[int, int] | None = None) -> Model | None:
    """A model from labels of documents whose id's crc32 does not leave `rest`."""
    known = needs(labels, "doc_id", "toxic").filter(F.col("toxic").isNotNull()
                                                    & learnable(modulus, rest)) \
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    # The sample is bounded by SAMPLE, whatever the tables hold, so it may be broadcast. An id that
    # many rows repeat brings one text to the driver, the first of them.
    picked = bounded_sample(known, "toxic", sample or SAMPLE, "toxicity")
    body = docs.select("doc_id", "text").filter(F.length("text") <= SAMPLE_CHARS)
    got = sorted((tuple(r) for r in body.join(F.broadcast(picked), "doc_id")
                  .groupBy("doc_id", "toxic").agg(F.min("text")).collect()))
    toxic = np.array([r[1] for r in got], int)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    return Model([r[2] for r in got], toxic, counts[1] / (counts[0] + counts[1]))


def score(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns `keep` and score of every row, from its text alone."""
    workers_import(docs.sparkSession)
    body = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_body"))
    schema = T.StructType([T.StructField(f"k{i}", docs.schema[c].dataType)
                           for i, c in enumerate(keep)] + [T.StructField("score", T.DoubleType())])
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        place = model.places() if model else None
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            scores = [model.score(t.as_py() or "", place) if model else 0.0 for t in texts]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())],
                                             names=[f.name for f in schema])

    out = body.mapInArrow(predict, schema)
    return out.withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score, predicted (1 from THRESHOLD on) of every document."""
    needs(docs, "doc_id", "text")
    return score(docs, train(docs, labels), ["doc_id"]).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
