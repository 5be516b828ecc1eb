"""Language of a text by sparse multinomial regression on TF-IDF character n-grams.

Document frequencies count every training row; the weights are learnt with follow the regularised
leader under an elastic net from at most ``per_language`` training rows a language, chosen by a
hash of the id, and a temperature is fitted on a fifth of them kept aside.

Cases: a text that is null or has no letter is ``und`` with score 0; rows without a language are
not learnt from; with no training rows everything is ``und``; ties go to the alphabetically first
language; a null id is never held out and never learnt from; texts are read whole; extra columns
are carried along, and of those that clash with the result's names the result's win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cascata.llm.arrays import give_back
from cascata.llm.features import Ngrams, fit_temperature, scaled, softmax, text_parts, train_ftrl
from cascata.session import ship_package

UNKNOWN = "und"
CHARACTERS = Ngrams((1, 2, 3))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # one row a feature, the bias in the last
    temperature: float

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner, feature, count = CHARACTERS.counts(texts)
        return owner, feature, scaled(owner, (1 + np.log(count)) * self.idf[feature], len(texts))

    def logits(self, texts: list[str]) -> np.ndarray:
        owner, feature, value = self.vectors(texts)
        weights = self.weights[feature]
        sums = [np.bincount(owner, weights=value * weights[:, k], minlength=len(texts)) for k in range(len(self.languages))]
        return np.stack(sums, axis=1) + self.weights[-1]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        shares = softmax(self.logits(texts) / self.temperature)
        best = shares.argmax(axis=1)
        lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
        names = [self.languages[k] if some else UNKNOWN for k, some in zip(best.tolist(), lettered.tolist())]
        return names, np.where(lettered, shares[np.arange(len(texts)), best], 0.0)


def document_frequencies(docs: DataFrame, text_column: str, ngrams: Ngrams) -> tuple[np.ndarray, int]:
    """How many rows hold each feature, and how many rows there are; one partial vector a task is added up by Spark."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ngrams.size + 1, np.int64)
        for block in blocks:
            for a, b, texts in text_parts(block, 0):
                total[:-1] += np.bincount(ngrams.counts(texts)[1], minlength=ngrams.size)
                total[-1] += b - a
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["feature", "n"])

    found = docs.select(text_column).mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(ngrams.size + 1, np.int64)
    total[found.column("feature").to_numpy()] = found.column("n").to_numpy()
    return total[:-1], int(total[-1])


def sampled(rows: DataFrame, group: str, id_column: str, most: int, in_all: int = 20_000) -> DataFrame:
    """About ``most`` rows of each group at most, ``in_all`` in all, by a hash of the id; one row of each id.

    Ids are chosen before the other columns are read: each group is dealt into 64 parts by the hash,
    and each part gives its first rows, which Spark limits before the shuffle. The chosen ids are
    bounded by ``in_all`` and so can be broadcast. However many rows share an id, one of them is kept, within
    each task before the shuffle; an id on very many rows costs its part of the 64 some of its places.
    """
    order = Window.partitionBy(group, "_part").orderBy("_h", id_column)
    hashed = rows.where(F.col(id_column).isNotNull()).select(id_column, group, F.xxhash64(id_column, F.lit(5)).alias("_h"))
    placed = hashed.withColumn("_part", F.pmod("_h", F.lit(64))).withColumn("_place", F.row_number().over(order))
    chosen = placed.where(F.col("_place") <= -(-most // 64)).orderBy("_place", "_h", id_column).limit(in_all).select(id_column).distinct()
    return rows.join(F.broadcast(chosen), id_column, "left_semi").dropDuplicates([id_column])


def sparse_rows(rows: DataFrame, text_column: str, target_column: str, ngrams: Ngrams) -> pa.Table:
    """Features and counts of a bounded sample, brought to the driver."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for a, b, texts in text_parts(block, 0):
                owner, feature, count = ngrams.counts(texts)
                offsets = pa.array(np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (feature, count)]
                yield pa.RecordBatch.from_arrays([block.column(1).slice(a, b - a), *lists], names=["target", "features", "counts"])

    schema = T.StructType([T.StructField("target", rows.schema[target_column].dataType), *(
        T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("features", "counts"))])
    return rows.select(text_column, target_column).mapInArrow(run, schema).toArrow()


def lists_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    found = []
    for chunk in column.chunks:
        offsets = chunk.offsets.to_numpy()
        found += np.split(chunk.flatten().to_numpy(), (offsets[1:-1] - offsets[0])) if len(chunk) else []
    return found


def fit(
    docs: DataFrame,
    may_learn: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    per_language: int = 1500,
) -> LanguageModel:
    """Learn from the rows for which ``may_learn`` is true and the language is known."""
    ship_package(docs.sparkSession)
    training = docs.where(may_learn & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    frequencies, n = document_frequencies(training, text_column, CHARACTERS)
    idf = np.log((1 + n) / (1 + frequencies)) + 1
    sample = sparse_rows(sampled(training, lang_column, id_column, per_language), text_column, lang_column, CHARACTERS)
    if not sample.num_rows:
        return LanguageModel([], idf, np.zeros((1, 0)), 1.0)
    # Rows arrive in any order; sorted by their content, the same sample gives the same weights.
    languages = sorted(set(sample.column("target").to_pylist()))
    features, counts = lists_of(sample.column("features")), lists_of(sample.column("counts"))
    number = {name: k for k, name in enumerate(languages)}
    known = [number[x] for x in sample.column("target").to_pylist()]
    order = sorted(range(len(known)), key=lambda i: (known[i], len(features[i]), features[i].tobytes(), counts[i].tobytes()))
    rows, truth = [], []
    for i in order:
        value = (1 + np.log(counts[i])) * idf[features[i]]
        value = value / max(np.linalg.norm(value), 1e-12)
        rows.append((np.append(features[i], CHARACTERS.size), np.append(value, 1.0)))
        truth.append(known[i])
    targets = np.eye(len(languages))[truth]
    aside = np.arange(len(rows)) % 5 == 4
    weights = train_ftrl([r for r, a in zip(rows, aside) if not a], targets[~aside], CHARACTERS.size + 1)
    held = [i for i in np.flatnonzero(aside)]
    logits = np.array([rows[i][1] @ weights[rows[i][0]] for i in held]).reshape(len(held), len(languages))
    return LanguageModel(languages, idf, weights.astype(np.float32), fit_temperature(logits, targets[aside]))


def predict(docs: DataFrame, model: LanguageModel, text_column: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and its calibrated probability, as ``lang_pred`` and ``score`` or under other names."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # features times languages
    kept = docs.drop(*names)
    place = kept.columns.index(text_column)

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for a, b, texts in text_parts(block, place):
                found, scores = shared.value.predict(texts)
                part = block.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(scores)], names=[*part.schema.names, *names])
        give_back()

    schema = T.StructType([*kept.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return kept.mapInArrow(run, schema)
