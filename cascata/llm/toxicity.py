"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are hashed character n-grams of length four to six. Over a bounded sample of the labelled
rows, the number of toxic and of clean rows that hold each feature is counted, and the features that tell toxic
rows from clean ones are selected. Grade 0 is a clean row; the toxic rows are graded by how many of these
features they hold, cut at equal numbers of rows (two grades unless asked otherwise). The
regression has one weight a feature, shared by all thresholds, and ordered thresholds; it learns
from the same sample, and its expected grade is the severity.

Cases: a null or empty text has severity 0; rows whose label is null are not learnt from, nor are
labels without a row; without toxic or without clean labels every severity is 0; repeated labels
of an id count once (toxic if any says so); texts are read whole; extra columns are carried along,
and of those that clash with the result's names the result's win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cascata.llm.features import Ngrams, text_parts
from cascata.llm.lang_id import lists_of, sampled
from cascata.session import materialize, ship_package

PARTS = Ngrams((4, 5, 6), bits=20)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def label_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(grade 0 or 1, feature) counts of the rows (text, toxic) that hold a feature, and rows of either kind."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, PARTS.size + 1), np.int64)
        for block in blocks:
            toxic = block.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b, texts in text_parts(block, 0):
                owner, feature, _ = PARTS.counts(texts)
                kind = toxic[a:b]
                total[:, :-1] += np.bincount(kind[owner] * PARTS.size + feature, minlength=2 * PARTS.size).reshape(2, -1)
                total[:, -1] += np.bincount(kind, minlength=2)
        # A feature that one row of a task holds is by far the most common case, and all must be added up.
        some = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total.ravel()[some])], names=["place", "n"])

    found = rows.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(2 * (PARTS.size + 1), np.int64)
    total[found.column("place").to_numpy()] = found.column("n").to_numpy()
    total = total.reshape(2, -1)
    return total[:, :-1], total[:, -1]


def select(counts: np.ndarray, rows: np.ndarray, most: int, least: float) -> np.ndarray:
    """The features whose share among toxic rows exceeds that among clean rows most, by the root of the likelihood ratio."""
    both, all_rows = counts.sum(axis=0), rows.sum()
    ratio = np.zeros(counts.shape[1])
    for held, whole, size in [(c, both, n) for c, n in zip(counts, rows)] + [(n - c, all_rows - both, n) for c, n in zip(counts, rows)]:
        expected = whole * (size / all_rows)
        ratio += 2 * np.where(held > 0, held * np.log(np.maximum(held, 1) / np.maximum(expected, 1e-12)), 0.0)
    strength = np.sqrt(np.maximum(ratio, 0.0))
    strong = np.flatnonzero((strength >= least) & (counts[1] * rows[0] > counts[0] * rows[1]))
    return np.sort(strong[np.lexsort((strong, -strength[strong]))][:most])


@dataclass(frozen=True)
class SeverityModel:
    place: np.ndarray  # number of a selected feature plus one, or 0
    weights: np.ndarray  # one for each selected feature, none negative
    thresholds: np.ndarray  # ascending

    def sums(self, texts: list[str]) -> np.ndarray:
        owner, feature, _ = PARTS.counts(texts)
        at = self.place[feature]
        return np.bincount(owner[at > 0], weights=self.weights[at[at > 0] - 1], minlength=len(texts))

    def reach(self, texts: list[str]) -> np.ndarray:
        """Probability of each grade from 1 on, or a higher one."""
        if not len(self.thresholds):
            return np.zeros((len(texts), 1))
        found = sigmoid(self.sums(texts)[:, None] - self.thresholds)
        found[[not t for t in texts]] = 0.0
        return found


def train_ordinal(rows: list[np.ndarray], grades: np.ndarray, size: int, grade_count: int, ridge: float = 1e-4, steps: int = 400, rate: float = 0.07):
    """Weights shared by all thresholds, and the thresholds, by gradient steps with adaptive rates on the mean log loss.

    P(grade >= k) = sigmoid(sum of weights - threshold k); the thresholds stay in order since each
    is the one before plus the exponential of a free number. Weights are kept from falling below
    zero, so that no amount of clean text around it can hide a toxic part.
    """
    lengths = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    shares = np.array([np.mean(grades >= k) for k in range(1, grade_count)])
    start = np.log((1 - shares) / shares)
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    params = np.concatenate([np.zeros(size), [start[0]], gaps])
    moments = np.zeros((2, len(params)))
    for step in range(1, steps + 1):
        weights, first, gaps = params[:size], params[size], params[size + 1 :]
        thresholds = first + np.r_[0, np.cumsum(np.exp(gaps))]
        total = np.bincount(owner, weights=weights[flat], minlength=len(rows))
        upto = np.concatenate([np.ones((len(rows), 1)), sigmoid(total[:, None] - thresholds), np.zeros((len(rows), 1))], axis=1)
        slope = upto * (1 - upto)
        each = np.arange(len(rows))
        chance = np.maximum(upto[each, grades] - upto[each, grades + 1], 1e-12)
        by_total = -(slope[each, grades] - slope[each, grades + 1]) / chance
        by_threshold = np.zeros((len(rows), grade_count + 1))
        by_threshold[each, grades] = slope[each, grades] / chance
        by_threshold[each, grades + 1] -= slope[each, grades + 1] / chance
        by_threshold = by_threshold[:, 1:-1].sum(axis=0)
        gradient = np.concatenate([
            np.bincount(flat, weights=by_total[owner], minlength=size) / len(rows) + ridge * weights,
            [by_threshold.sum() / len(rows)],
            np.cumsum(by_threshold[::-1])[::-1][1:] * np.exp(gaps) / len(rows)])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        mean, square = moments[0] / (1 - 0.9**step), moments[1] / (1 - 0.99**step)
        params = params - rate * (1 - step / (steps + 1)) * mean / (np.sqrt(square) + 1e-8)
        params[:size] = np.maximum(params[:size], 0.0)
    return params[:size], params[size] + np.r_[0, np.cumsum(np.exp(params[size + 1 :]))]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    grade_count: int = 3,
    per_label: int = 4000,
    most_features: int = 1 << 16,
    least_strength: float = 4.0,
) -> SeverityModel:
    """Learn from the texts of at most ``per_label`` ids of either label, chosen by a hash of the id.

    Only ids and labels are looked at for that, of documents that have a text; the chosen ones are
    broadcast, so that no text but theirs is shuffled. One text of each id counts.
    """
    ship_package(docs.sparkSession)
    marks = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(id_column).agg(
        (F.max(F.col(label_column).cast("int")) > 0).cast("int").alias("_toxic"))
    given = docs.select(id_column, text_column).where(F.col(text_column).isNotNull())
    marks = marks.join(given.select(id_column).distinct(), id_column, "left_semi")
    ids = F.broadcast(sampled(marks, "_toxic", id_column, per_label))  # about twice per_label at most
    labelled = given.join(ids, id_column).dropDuplicates([id_column])
    labelled = materialize(labelled.select(text_column, "_toxic").repartition(8), "rotulados")
    counts, rows = label_counts(labelled)
    place = np.zeros(PARTS.size, np.int32)
    if not rows.all():
        return SeverityModel(place, np.zeros(0), np.zeros(0))
    chosen = select(counts, rows, most_features, least_strength)
    place[chosen] = np.arange(1, len(chosen) + 1)

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for a, b, texts in text_parts(block, 0):
                owner, feature, _ = PARTS.counts(texts)
                kept = place[feature] > 0
                owner, feature = owner[kept], place[feature[kept]] - 1
                offsets = pa.array(np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([block.column(1).slice(a, b - a), lists], names=["toxic", "features"])

    sample = labelled.mapInArrow(run, "toxic int, features array<int>").toArrow()
    features, toxic = lists_of(sample.column("features")), sample.column("toxic").to_numpy()
    order = sorted(range(len(features)), key=lambda i: (toxic[i], features[i].tobytes()))
    held = np.array([len(features[i]) for i in order])
    toxic = toxic[order]
    cuts = np.quantile(held[toxic == 1], np.arange(1, grade_count - 1) / (grade_count - 1)) if toxic.any() else []
    grades = np.where(toxic == 1, 1 + np.searchsorted(cuts, held, "right"), 0)
    levels = np.unique(grades)  # short of rows, some grades may be empty
    grades = np.searchsorted(levels, grades)
    if len(levels) < 2:
        return SeverityModel(place, np.zeros(0), np.zeros(0))
    weights, thresholds = train_ordinal([features[i] for i in order], grades, len(chosen), len(levels))
    return SeverityModel(place, weights, thresholds)


def grade(docs: DataFrame, model: SeverityModel, text_column: str = "text", least: float = 0.3) -> DataFrame:
    """``docs`` with ``severity`` (the expected grade), ``toxic_score`` (that of any grade) and ``toxic``."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # features, whatever the number of rows
    kept = docs.drop("severity", "toxic_score", "toxic")
    at = kept.columns.index(text_column)

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for a, b, texts in text_parts(block, at):
                reach = shared.value.reach(texts)
                part = block.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(reach.sum(axis=1)), pa.array(reach[:, 0]), pa.array(reach[:, 0] >= least)],
                                                 names=[*part.schema.names, "severity", "toxic_score", "toxic"])

    schema = T.StructType([*kept.schema.fields, T.StructField("severity", T.DoubleType()), T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic", T.BooleanType())])
    return kept.mapInArrow(run, schema)
