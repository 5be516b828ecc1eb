"""Quality of a text by a weak-label model and a hashed linear scorer.

Overlapping heuristic labellers vote good, bad or abstain on every text. Expectation-maximisation
over the counts of all vote patterns (at most 3 to the power of the labellers) estimates how each
labeller votes on good and on bad texts, and with that the posterior of every pattern. Posterior
labels of a bounded sample of texts, chosen by a hash of the id within each pattern, train a linear
scorer on hashed n-grams and signals, which scores all texts.

Cases: a null or empty text and one without words get no votes; its posterior is that of the empty
pattern, and its score is 0, so it is not kept; with no rows at all the result is empty; repeated
rows count and are scored each; a null id can be scored but is not learnt from; texts are read
whole; extra columns are carried along, and of those that clash with the result's names the
result's win.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cascata.llm.arrays import give_back
from cascata.llm.features import Ngrams, scaled, softmax, text_parts, train_ftrl
from cascata.llm.lang_id import lists_of, sampled
from cascata.session import materialize, ship_package

GOOD, BAD, ABSTAIN = 1, 0, 2
SHAPES = Ngrams((1, 2, 3), bits=16, fold_case=False)
SIGNAL_STEPS = 16
SIGNAL_VALUE = 0.35
LABELLERS = ["odd_signs", "letters", "capitals", "shouting", "repeated_words", "repeated_phrases", "cells", "wordless", "sentences"]

FEATURES = SHAPES.size + SIGNAL_STEPS * len(LABELLERS) + 1

_UPPER, _LETTER, _BLANK, _PLAIN, _DIGIT = 1, 2, 4, 8, 16


def _kinds() -> np.ndarray:
    """What a byte is; bytes of characters beyond ASCII count as letters."""
    kinds = np.zeros(256, np.uint8)
    kinds[[*range(65, 91)]] = _UPPER | _LETTER
    kinds[[*range(97, 123), *range(128, 256)]] = _LETTER
    kinds[[9, 10, 11, 12, 13, 32]] = _BLANK
    kinds[[*b".,;:'\"!?()-|"]] = _PLAIN
    kinds[[*b"0123456789"]] = _PLAIN | _DIGIT
    return kinds


_KINDS = _kinds()
_CAPITALS = re.compile(r"[À-ÖØ-Þ]")


@dataclass
class Signals:
    """Shares that describe the shape of each text; NaN where a text is too short to tell."""

    values: np.ndarray  # one column for each of LABELLERS

    @classmethod
    def of(cls, texts: list[str]) -> Signals:
        raw = [t.encode() for t in texts]
        kinds = _KINDS[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)

        def per_text(flags: np.ndarray) -> np.ndarray:
            upto = np.cumsum(flags, dtype=np.int64)[ends - 1]
            return np.diff(upto, prepend=0).astype(float)

        sums = {name: per_text((kinds & bit) != 0) for name, bit in (("upper", _UPPER), ("letter", _LETTER), ("plain", _PLAIN))}
        sums["blank"] = per_text((kinds & _BLANK) != 0) - 1
        blank = (kinds & _BLANK) != 0
        starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
        without = np.zeros(len(kinds), bool)
        if starts.size:
            without[starts] = np.bitwise_or.reduceat(kinds, starts) & (_LETTER | _DIGIT) == 0
        sums["wordless"] = per_text(without)
        values = np.full((len(texts), len(LABELLERS)), np.nan)
        for i, (text, r) in enumerate(zip(texts, raw)):
            words = r.split()
            n = len(words)
            if not n:
                continue
            solid = len(r) - sums["blank"][i]
            letters = sums["letter"][i]
            odd = solid - letters - sums["plain"][i]
            values[i, 0] = odd / solid
            if n >= 20:
                values[i, 1] = letters / solid
            if letters >= 30:
                values[i, 2] = (sums["upper"][i] + len(_CAPITALS.findall(text))) / letters
            values[i, 3] = r.count(b"!") / n
            if n >= 20:
                values[i, 4] = len(set(words)) / n
                values[i, 5] = len(set(zip(words, words[1:], words[2:]))) / (n - 2)
            values[i, 6] = r.count(b"|") / n
            values[i, 7] = sums["wordless"][i] / n
            if n >= 12:
                values[i, 8] = (r.count(b".") + r.count(b"?") + r.count(b"!")) / n
        return cls(values)

    # Up to (or from) which share a labeller votes good, and beyond which it votes bad.
    LIMITS = {
        "odd_signs": (0.03, 0.08), "letters": (0.85, 0.75), "capitals": (0.2, 0.35), "shouting": (0.08, 0.2),
        "repeated_words": (0.5, 0.35), "repeated_phrases": (0.85, 0.6), "cells": (0.03, 0.15), "wordless": (0.06, 0.15),
        "sentences": (0.4, 0.6),
    }

    def votes(self) -> np.ndarray:
        votes = np.full(self.values.shape, ABSTAIN, np.int8)
        for k, name in enumerate(LABELLERS):
            good, bad = self.LIMITS[name]
            sign = 1 if good < bad else -1
            seen = sign * self.values[:, k]
            votes[seen <= sign * good, k] = GOOD
            votes[seen >= sign * bad, k] = BAD
        return votes

    def steps(self) -> np.ndarray:
        """Signals as feature numbers, one for each labeller; the last step means too short to tell."""
        step = np.minimum(np.sqrt(np.clip(self.values, 0, 1)) * (SIGNAL_STEPS - 1), SIGNAL_STEPS - 2)
        step = np.where(np.isnan(self.values), SIGNAL_STEPS - 1, step).astype(np.int64)
        return step + SIGNAL_STEPS * np.arange(len(LABELLERS))


def patterns(votes: np.ndarray) -> np.ndarray:
    """Each row of votes as one number."""
    return votes.astype(np.int64) @ (3 ** np.arange(votes.shape[1]))


def votes_of(pattern: np.ndarray, labellers: int = len(LABELLERS)) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(labellers) % 3


@dataclass(frozen=True)
class WeakLabels:
    """What expectation-maximisation found: the share of good texts, and each labeller's votes by class."""

    prior: float
    votes: np.ndarray  # (class, labeller, vote of those that vote)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes is good."""
        logs = np.concatenate([np.log(self.votes), np.zeros((2, votes.shape[1], 1))], axis=2)  # abstaining says nothing
        each = [logs[c][np.arange(votes.shape[1]), votes].sum(axis=1) for c in (0, 1)]
        return softmax(np.stack(each, axis=1) + np.log([1 - self.prior, self.prior]))[:, 1]

    def accuracy(self) -> np.ndarray:
        """For each labeller, how often it is right when it votes."""
        right = self.prior * self.votes[1][:, GOOD] + (1 - self.prior) * self.votes[0][:, BAD]
        wrong = self.prior * self.votes[1][:, BAD] + (1 - self.prior) * self.votes[0][:, GOOD]
        return right / (right + wrong)


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 100, strength: float = 1.0) -> WeakLabels:
    """Expectation-maximisation over vote patterns and how many texts have each.

    It starts from taking a text for bad when any labeller does, which also tells which class is
    which; ``strength`` pseudo-votes keep every share positive.
    """
    bad, good = (votes == BAD).any(axis=1), (votes == GOOD).any(axis=1)
    chance = np.where(bad, 0.1, np.where(good, 0.95, 0.5))
    model = WeakLabels(0.5, np.full((2, votes.shape[1], 2), 0.5))
    for _ in range(rounds):
        weights = np.stack([(1 - chance) * counts, chance * counts])
        shares = np.stack([[[(w * (votes[:, k] == v)).sum() for v in (BAD, GOOD)] for k in range(votes.shape[1])] for w in weights]) + strength
        shares /= shares.sum(axis=2, keepdims=True)
        model = WeakLabels(float((weights[1].sum() + strength) / (counts.sum() + 2 * strength)), shares)
        renewed = model.posterior(votes)
        if np.abs(renewed - chance).max() < 1e-6:
            break
        chance = renewed
    return model


def vectors(texts: list[str], signals: Signals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value): hashed n-grams scaled to length one, signal steps, and the bias."""
    owner, feature, count = SHAPES.counts(texts)
    steps = SHAPES.size + signals.steps()
    each, every = np.arange(len(texts)), steps.shape[1]
    owner = np.concatenate([owner, np.repeat(each, every), each])
    value = np.concatenate([scaled(owner[: len(feature)], 1 + np.log(count), len(texts)), np.full(steps.size, SIGNAL_VALUE), np.ones(len(texts))])
    return owner, np.concatenate([feature, steps.ravel(), np.full(len(texts), FEATURES - 1)]), value


@dataclass(frozen=True)
class QualityModel:
    weak: WeakLabels
    weights: np.ndarray

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Posterior of the votes, and the linear scorer's probability that the text is good."""
        signals = Signals.of(texts)
        owner, feature, value = vectors(texts, signals)
        total = np.bincount(owner, weights=value * self.weights[feature], minlength=len(texts))
        blank = np.array([not t.strip() for t in texts], bool)
        return self.weak.posterior(signals.votes()), np.where(blank, 0.0, 1 / (1 + np.exp(-np.clip(total, -50, 50))))


def _sample(rows: DataFrame, id_column: str, text_column: str) -> pa.Table:
    """Vote pattern, features and values of a bounded sample, brought to the driver."""

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for a, b, texts in text_parts(block, 0):
                signals = Signals.of(texts)
                owner, feature, value = vectors(texts, signals)
                order = np.argsort(owner, kind="stable")
                offsets = pa.array(np.searchsorted(owner[order], np.arange(b - a + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (feature[order].astype(np.int32), value[order])]
                yield pa.RecordBatch.from_arrays([pa.array(patterns(signals.votes())), *lists], names=["pattern", "features", "values"])

    return rows.dropDuplicates([id_column]).select(text_column).mapInArrow(run, "pattern long, features array<int>, values array<double>").toArrow()


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_pattern: int = 400, most: int = 6000) -> QualityModel:
    """Votes of all rows; the scorer learns from about ``per_pattern`` rows a vote pattern at most, of at most ``most`` ids in all."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("pattern", T.LongType())])

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for a, b, texts in text_parts(block, 1):
                found = patterns(Signals.of(texts).votes())
                yield pa.RecordBatch.from_arrays([block.column(0).slice(a, b - a), pa.array(found)], names=[id_column, "pattern"])
        give_back()

    given = docs.select(id_column, text_column)
    voted = materialize(given.mapInArrow(run, schema), "votos")
    counted = voted.groupBy("pattern").count().toArrow()  # at most 3 ** labellers rows
    pattern, count = counted.column("pattern").to_numpy(), counted.column("count").to_numpy()
    weak = estimate(votes_of(pattern), count.astype(float)) if len(pattern) else WeakLabels(0.5, np.full((2, len(LABELLERS), 2), 0.5))
    chosen = sampled(voted, "pattern", id_column, per_pattern, most)
    chosen = F.broadcast(chosen.select(id_column))
    sample = _sample(given.join(chosen, id_column, "left_semi"), id_column, text_column)  # a row of each of at most ``most`` ids
    features, values = lists_of(sample.column("features")), lists_of(sample.column("values"))
    # Rows arrive in any order; sorted by their content, the same sample gives the same weights.
    order = sorted(range(len(features)), key=lambda i: (len(features[i]), features[i].tobytes(), values[i].tobytes()))
    good = weak.posterior(votes_of(sample.column("pattern").to_numpy()))[order] if order else np.zeros(0)
    weights = train_ftrl([(features[i], values[i]) for i in order], np.stack([1 - good, good], axis=1), FEATURES, lasso=0.01, ridge=0.01)
    return QualityModel(weak, (weights[:, 1] - weights[:, 0]).astype(np.float32))


def score(docs: DataFrame, model: QualityModel, text_column: str = "text", least: float = 0.5, names: tuple[str, str, str] = ("posterior", "quality", "keep")) -> DataFrame:
    """``docs`` with the votes' posterior, the scorer's probability and whether that is at least ``least``."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # a weight for each feature
    kept = docs.drop(*names)
    place = kept.columns.index(text_column)

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            for a, b, texts in text_parts(block, place):
                posterior, quality = shared.value.score(texts)
                part = block.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(posterior), pa.array(quality), pa.array(quality >= least)],
                                                 names=[*part.schema.names, *names])
        give_back()

    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, t) for n, t in zip(names, (T.DoubleType(), T.DoubleType(), T.BooleanType())))])
    return kept.mapInArrow(run, schema)
