"""A fitted text model: what was learned from some documents, applied to others.

The model is three tables: the vocabulary, each word's idf, mean and deviation over the
training documents, and the weights of a regression. They are written, so that another job can
read them and score documents that were not there when the model was made.

Defined results: words that the training documents do not have drop out; so do words that all
training documents hold and words without variance; a null text has no words, and its vector
no entries; training documents without a label shape the vocabulary, not the weights.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prairie.functions.scalars import idf_ln
from prairie.operators import models
from prairie.operators import vectors as v
from prairie.session import stored


@dataclass(frozen=True)
class TextModel:
    vocab: DataFrame  # word, n, idx
    scale: DataFrame  # idx, idf, mean, std (above 0)
    weights: DataFrame  # idx, w

    def vectors(self, docs: DataFrame, key: str, words: Column) -> DataFrame:
        """``key`` and ``entries`` of documents, by what was learned from the training ones."""
        return self._vectors(docs, words, key)

    def _vectors(self, docs: DataFrame, words: Column, *keep: str) -> DataFrame:
        bags = docs.select(*keep, v.bag(words).alias("bag"))
        return _scaled(v.counted(bags, self.vocab, *keep), self.scale, *keep)

    def scored(self, docs: DataFrame, key: str, words: Column) -> DataFrame:
        """``key``, ``label``, ``z`` and ``p`` of documents with a ``label``."""
        rows = self._vectors(docs, words, key, "label")
        return models.scored(stored(rows, "unseen"), key, self.weights)  # read twice there

    def save(self, path: str) -> None:
        for name in ("vocab", "scale", "weights"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextModel:
        return TextModel(*(spark.read.parquet(f"{path}/{name}") for name in ("vocab", "scale", "weights")))


def _scaled(counts: DataFrame, scale: DataFrame, *keep: str) -> DataFrame:
    """Standardised TF-IDF of stored entries; the scale has a row for each word of the vocabulary at most."""
    return v.valued(counts, scale, lambda cnt, total, idf, mean, std: (cnt * idf - mean) / std, *keep)


def scale_of(corpus: v.Corpus) -> DataFrame:
    """``idx``, ``idf``, ``mean`` and ``std`` over the corpus, absent entries as 0."""
    idf = corpus.frequency().select("idx", idf_ln(F.lit(corpus.n), "df").alias("idf"))
    stats = v.moments(corpus.tfidf_raw(), corpus.n).where("std > 0")
    return stats.join(idf, "idx").select("idx", "idf", "mean", "std")


def fit(docs: DataFrame, key: str, words: Column, path: str, size: int = v.SIZE, **training) -> TextModel:
    """The model of documents with a ``label`` (0, 1 or null), written to ``path`` and read back.

    ``training`` goes to :func:`prairie.operators.models.train_logistic`.
    """
    spark = docs.sparkSession
    corpus = v.corpus(docs, key, words, size, keep=("label",))
    scale = stored(scale_of(corpus), "scale")
    rows = _scaled(corpus.counts, scale, "label")
    weights = models.train_logistic(rows, corpus.vocab.count(), **training)
    TextModel(corpus.vocab, scale, models.weight_table(spark, weights)).save(path)
    return TextModel.load(spark, path)
