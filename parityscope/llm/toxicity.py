"""Toxicity: a linear classifier that counterfactual pairs keep fair to named groups.

Features are the words of a text and their first three to five bytes, so that inflected
or composed forms of a word learn together; a feature counts once a text. The model is
a logistic regression on the features that tell the classes apart most. Wherever a
fitting text names a group of people, a copy with the names swapped for others of the
same kind is made, and the squared difference of both scores is added to the loss: the
model can't learn that naming a group is toxic.

Fitting uses a bounded sample of labelled rows (``labelled.ROWS_PER_CLASS``); scoring
reads every whole text and nothing but the text.

Defined results: a null or empty text has no features and gets the score of the intercept; 
repeated rows get equal scores; an empty table gives no rows; without labels of both
classes, every score is the share of ones among the labels (0.5 without any).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityscope.llm.arrow_columns import TextFunction, with_text_columns
from parityscope.llm.labelled import fitting_rows, held_out
from parityscope.llm.text_bytes import Texts, mix

#: Words that name a group, by kind; a word is swapped for another of its kind.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("she", "he"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"), ("immigrants", "refugees", "natives"), ("old", "young"),
    ("americans", "mexicans", "africans", "europeans", "germans", "turks"), ("deaf", "blind", "disabled"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "inländer"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
_KIND = {word: (kind, i) for kind in IDENTITY_TERMS for i, word in enumerate(kind)}
_NAMED = re.compile(r"\b(" + "|".join(sorted(_KIND, key=len, reverse=True)) + r")\b", re.IGNORECASE)

BITS = 18
SELECTED = 3_000
#: Fitting texts that a feature must occur in.
LEAST_TEXTS = 8
PENALTY = 4.0
_RIDGE, _STEPS, _RATE = 2e-3, 300, 0.1
_PREFIXES = (None, 3, 4, 5)

_TO_LETTERS = np.arange(256, dtype=np.uint8)
_TO_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32


def swap_terms(text: str, step: int = 1) -> str:
    """The text with every group name swapped for the one ``step`` places on of its kind,
    never for itself. Steps that differ from text to text compare all names of a kind.
    Letters of old prints, as the long s, count as those they stand for."""

    def other(match: re.Match) -> str:
        kind, i = _KIND.get(match[0].casefold(), ((), 0))
        if not kind:  # a letter that matches without case, but has another lower-case form
            return match[0]
        word = kind[(i + 1 + (step - 1) % (len(kind) - 1)) % len(kind)]
        return word.capitalize() if match[0][0].isupper() else word

    return _NAMED.sub(other, text)


def _hits(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Text and feature, for every word and prefix."""
    letters = Texts(_TO_LETTERS[texts.data], texts.offsets)
    features = []
    for k, first in enumerate(_PREFIXES):
        hashes = mix(letters.word_hashes(lower=True, first_bytes=first) + np.uint64(k))
        features.append((hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return np.tile(letters.word_docs, len(_PREFIXES)), np.concatenate(features)


def _distinct(docs: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(docs << BITS | features)
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _feature_lists(texts: Texts) -> pa.Array:
    docs, features = _distinct(*_hits(texts))
    ends = np.searchsorted(docs, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(features, pa.int32()))


def _pairs() -> TextFunction:
    def features(texts: Texts) -> list[pa.Array]:
        whole = [texts.data[a:b].tobytes().decode() for a, b in zip(texts.offsets, texts.offsets[1:], strict=False)]
        swapped = [swap_terms(t, zlib.crc32(t.encode())) for t in whole]
        named = [s if s != t else "" for s, t in zip(swapped, whole, strict=True)]
        other = _feature_lists(Texts.of(pa.array(named, pa.large_string())))
        return [_feature_lists(texts), other, pa.array([bool(t) for t in named])]

    return features


@dataclass
class Model:
    """Weight of each feature, most of them 0, and the intercept."""

    weights: np.ndarray
    intercept: float

    def scores(self, texts: Texts) -> np.ndarray:
        docs, features = _hits(texts)
        weighty = self.weights[features] != 0
        docs, features = _distinct(docs[weighty], features[weighty])
        total = np.bincount(docs, self.weights[features], minlength=len(texts))
        return _sigmoid(self.intercept + total)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logit(share: float) -> float:
    return float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))


class _Sparse:
    """Rows of binary features."""

    def __init__(self, lists: pa.Array, column_of: np.ndarray) -> None:
        self.n_rows, self.n_columns = len(lists), int(column_of.max()) + 1
        rows = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        columns = column_of[lists.flatten().to_numpy()]
        self.rows, self.columns = rows[columns >= 0], columns[columns >= 0]

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], minlength=self.n_rows)

    def gradient(self, by_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, by_row[self.rows], minlength=self.n_columns)


def _select(lists: pa.Array, labels: np.ndarray) -> np.ndarray:
    """Column of each feature, -1 for those left out: the largest chi-square stays."""
    rows = np.repeat(labels, pc.list_value_length(lists).to_numpy())
    features = lists.flatten().to_numpy()
    ones = np.bincount(features[rows == 1], minlength=1 << BITS)
    zeros = np.bincount(features[rows == 0], minlength=1 << BITS)
    n_ones, n_zeros, seen = int(labels.sum()), int((labels == 0).sum()), ones + zeros
    expected = seen * n_ones / (n_ones + n_zeros)
    spread = expected * n_zeros / (n_ones + n_zeros) + 1e-9
    chi = np.where(seen >= LEAST_TEXTS, (ones - expected) ** 2 / spread, 0)
    best = np.argsort(-chi, kind="stable")[:SELECTED]
    column_of = np.full(1 << BITS, -1)
    best = best[chi[best] > 0]
    column_of[best] = np.arange(len(best))
    return column_of


def fit_lists(table: pa.Table, share: float, penalty: float = PENALTY) -> Model:
    """Fit on rows of feature lists: ``features``, ``swapped``, ``named`` and ``label``."""
    table = table.combine_chunks()
    labels = table["label"].to_numpy()
    model = Model(np.zeros(1 << BITS), _logit(share))
    if len(set(labels.tolist())) < 2:
        return model
    features = table["features"].combine_chunks()
    column_of = _select(features, labels)
    if column_of.max() < 0:
        return model
    x = _Sparse(features, column_of)
    named = np.flatnonzero(table["named"].to_numpy())
    own = _Sparse(features.take(pa.array(named)), column_of)
    swapped = _Sparse(table["swapped"].combine_chunks().take(pa.array(named)), column_of)
    weights, bias = np.zeros(x.n_columns), 0.0
    weight_of = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    first, second = np.zeros(x.n_columns + 1), np.zeros(x.n_columns + 1)
    for step in range(1, _STEPS + 1):
        error = (_sigmoid(x.times(weights) + bias) - labels) * weight_of / len(labels)
        slope = np.append(x.gradient(error) + _RIDGE * weights, error.sum())
        if len(named):
            a, b = (_sigmoid(m.times(weights) + bias) for m in (own, swapped))
            gap = 2 * penalty * (a - b) / len(named)
            slope[:-1] += own.gradient(gap * a * (1 - a)) - swapped.gradient(gap * b * (1 - b))
            slope[-1] += (gap * (a * (1 - a) - b * (1 - b))).sum()
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        change = _RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - change[:-1], bias - change[-1]
    model.weights[column_of >= 0] = weights[column_of[column_of >= 0]]
    model.intercept = float(bias)
    return model


def fit(docs: DataFrame, labels: DataFrame, penalty: float = PENALTY) -> Model:
    """Fit in one task, on the bounded sample; the driver gets the weights alone."""
    rows, share = fitting_rows(docs, labels, "toxic")
    fields = {"features": "array<int>", "swapped": "array<int>", "named": "boolean"}
    rows = with_text_columns(rows, fields, _pairs, keep=["doc_id", "label"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            model = fit_lists(pa.Table.from_batches(held), share, penalty)
            features = np.flatnonzero(model.weights)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*features.tolist(), -1], pa.int64()), pa.array([*model.weights[features].tolist(), model.intercept])],
                ["feature", "weight"],
            )

    learned = rows.repartition(1).sortWithinPartitions("doc_id", "features").mapInArrow(learn, "feature long, weight double")
    model = Model(np.zeros(1 << BITS), _logit(share))
    for row in learned.collect():  # SELECTED rows at most, and the intercept
        if row.feature < 0:
            model.intercept = row.weight
        else:
            model.weights[row.feature] = row.weight
    return model


def with_scores(docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Add the probability that a text is toxic to the columns kept (all by default)."""
    weights, intercept = model.weights, model.intercept

    def make() -> TextFunction:
        scorer = Model(weights, intercept)
        return lambda texts: [pa.array(scorer.scores(texts))]

    return with_text_columns(docs, {name: "double"}, make, keep)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A score and a prediction for every document."""
    found = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels), ["doc_id"])
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
