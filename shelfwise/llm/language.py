"""Language identification with a string kernel.

The presence kernel over character n-grams of one to three characters (hashed) of two texts is
the number of different ones that both have, over the root of the product of how many each has. Landmark
texts of every language span a Nystroem approximation of its feature space, in which one kernel
ridge regression per language is fitted, one versus the rest. A batch of texts is scored by two
matrix products: texts by landmark grams, and kernel values by coefficients.

The model is fitted on a bounded sample: SAMPLE texts per language, of at most SAMPLE_CHARS
characters, of which LANDMARKS per language become landmarks. Every text is scored whole.

Defined results: a text that is null or has no letter is `und` with score 0; without any
training row all texts are `und`; null ids are scored but never learned from; repeated rows get
equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.samples import Presence, bounded_sample, gram_codes, learnable
from shelfwise.llm.store import (materialise, needs, numbered, short_batches, stored,
                                 workers_import, wrapped)

ORDERS = (1, 2, 3)
SAMPLE = 250
SAMPLE_CHARS = 10_000
LANDMARKS = 16
RIDGE = 1e-3
BLOCK = 128
#: Of the exponential that turns outputs into shares.
SHARPNESS = 10.0
UNKNOWN = "und"
#: The pipeline rejects a text whose language scores lower, besides those without a letter.
MIN_SCORE = 0.3


class Model:
    """Landmark incidence, sizes and coefficients; `scores` of a block of texts by languages."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: int = LANDMARKS,
                 ridge: float = RIDGE):
        self.labels = sorted(set(langs))
        chosen = [i for lab in self.labels
                  for i in [k for k, lang in enumerate(langs) if lang == lab][:landmarks]]
        marks = [np.unique(gram_codes(texts[i], ORDERS)) for i in chosen]
        self.vocabulary = np.unique(np.concatenate(marks))
        self.incidence = np.zeros((len(self.vocabulary), len(marks)), np.float32)
        for k, codes in enumerate(marks):
            self.incidence[np.searchsorted(self.vocabulary, codes), k] = 1
        self.roots = np.sqrt([max(1, len(c)) for c in marks]).astype(np.float32)
        presence = Presence(self.vocabulary, ORDERS)
        among = self.kernel([texts[i] for i in chosen], presence).astype(np.float64)
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        keep = values > 1e-6
        self.projection = vectors[:, keep] / np.sqrt(values[keep])
        features = self._features(self.kernel(texts, presence))
        target = (np.array(langs)[:, None] == np.array(self.labels)[None, :]).astype(np.float64)
        gram = features.T @ features + ridge * len(texts) * np.eye(features.shape[1])
        weights = np.linalg.solve(gram, features.T @ target)
        self.coefficients = np.vstack([self.projection @ weights[:-1], weights[-1:]])

    def _features(self, kernel: np.ndarray) -> np.ndarray:
        return np.hstack([kernel @ self.projection, np.ones((len(kernel), 1))])

    def kernel(self, texts: list[str], presence: Presence) -> np.ndarray:
        """Kernel values of texts by landmarks."""
        out = np.zeros((len(texts), self.incidence.shape[1]), np.float32)
        for low in range(0, len(texts), BLOCK):
            block = texts[low:low + BLOCK]
            rows = np.zeros((len(block), len(self.vocabulary)), np.float32)
            sizes = np.ones((len(block), 1), np.float32)
            for k, text in enumerate(block):
                at, distinct = presence(text)
                rows[k, at] = 1
                sizes[k] = max(1, distinct)
            out[low:low + len(block)] = rows @ self.incidence / (np.sqrt(sizes) * self.roots)
        return out

    def scores(self, texts: list[str], presence: Presence) -> np.ndarray:
        """The regressions' outputs (1 for a sure text, 0 for others) as shares of 1."""
        raw = self.kernel(texts, presence) @ self.coefficients[:-1] + self.coefficients[-1]
        shares = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)))
        return shares / shares.sum(axis=1, keepdims=True)


def train(docs: DataFrame, usable: Column, label: str = "lang", sample: int = SAMPLE) -> Model | None:
    """A model from a bounded sample of the usable rows with a label; None if there is none."""
    rows = docs.filter(usable & F.col(label).isNotNull())
    picked = bounded_sample(rows, label, sample, "language") \
        .filter(F.col("text").rlike("\\p{L}") & (F.length("text") <= SAMPLE_CHARS)) \
        .select("doc_id", F.col(label).alias("label"), "text")
    got = sorted((tuple(r) for r in picked.collect()), key=lambda r: (r[0], r[1], r[2]))
    return Model([r[2] for r in got], [r[1] for r in got]) if got else None


def identify(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns `keep`, lang_pred and score of every row, from its text alone."""
    spark = docs.sparkSession
    workers_import(spark)
    columns = [F.col(f"`{c}`") for c in keep]
    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    body = docs.select(*columns, F.when(lettered, F.col("text")).alias("_body"))
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([T.StructField(f"k{i}", f.dataType) for i, f in enumerate(fields)]
                          + [T.StructField("lang_pred", T.StringType()),
                             T.StructField("score", T.DoubleType())])
    shipped = spark.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        presence = Presence(model.vocabulary, ORDERS) if model else None
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            langs, scores = [], []
            for low in range(0, batch.num_rows, BLOCK):
                block = texts.slice(low, BLOCK).to_pylist()
                known = [k for k, t in enumerate(block) if t is not None and model is not None]
                lang, score = [UNKNOWN] * len(block), [0.0] * len(block)
                if known:
                    found = model.scores([block[k] for k in known], presence)
                    best = found.argmax(axis=1)
                    for k, b, row in zip(known, best, found, strict=True):
                        lang[k], score[k] = model.labels[b], round(float(row[b]), 4)
                langs += lang
                scores += score
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[f.name for f in schema])

    out = body.mapInArrow(predict, schema)
    return out.withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})


def identify_documents(docs: DataFrame, modulus: int = 3, rest: int = 1) -> DataFrame:
    """doc_id, lang_pred, score; learned from documents whose id's crc32 leaves another rest."""
    needs(docs, "doc_id", "text", "lang")
    return identify(docs, train(docs, learnable(modulus, rest)), ["doc_id"])


def accepted_documents(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs, in their columns, that have a language.

    Just texts go to Python, in short batches, and the numbers of rejected rows come back.
    """
    docs = stored(docs)
    model = train(docs, F.col("doc_id").isNotNull())
    judged = identify(numbered(docs, "text"), model, ["_row"])
    with short_batches(docs.sparkSession):
        gone = materialise(
            judged.filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score))
            .select(F.col("_row").alias("_gone")), "rejected")
    rows = numbered(docs, wrapped(docs))
    return rows.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select("doc.*")
