"""Quality: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is described by
its statistics and by hashed words and word beginnings, and encoded by one layer. Gated
attention (a softmax over the bag of ``w (tanh(V h) * sigmoid(U h))``) weighs the
passages; the score is read off their weighted mean. All layers are learned together,
from document labels alone, on a bounded sample of labelled rows
(``labelled.ROWS_PER_CLASS``, ``FIT_PASSAGES`` of a text), in one task: at most 200 kB for
each 1,000 passages. Scoring reads every whole text and nothing but the text.

Defined results: a null or empty text is one passage without words; a text of any length is
scored by all its passages; repeated rows get equal scores; an empty table gives no rows; without labels of both classes every score is
the share of ones among the labels (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityscope.llm.arrow_columns import TextFunction, with_text_columns
from parityscope.llm.labelled import fitting_rows, held_out
from parityscope.llm.text_bytes import Texts, mix, repeated

PASSAGE_WORDS = 100
_HASHED = 32
_STATISTICS = 15
_INPUT = _HASHED + _STATISTICS
_HIDDEN, _ATTENTION, _STEPS, _RATE, _RIDGE = 24, 12, 400, 0.02, 1e-4
#: Shapes of the layers.
_SHAPES = {"W": (_INPUT, _HIDDEN), "b": (_HIDDEN,), "V": (_HIDDEN, _ATTENTION), "U": (_HIDDEN, _ATTENTION), "a": (_ATTENTION,), "c": (_HIDDEN,), "d": ()}
#: Passages of a text that the fit uses at most, spread evenly over it; scores use all.
FIT_PASSAGES = 256


def _flags(test) -> np.ndarray:
    return np.array([bool(test(b)) for b in range(256)])


_UPPER = _flags(lambda b: 65 <= b <= 90)
_LETTER = _flags(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_DIGIT = _flags(lambda b: 48 <= b <= 57)
_SIGN = _flags(lambda b: 33 <= b <= 126 and not chr(b).isalnum() and chr(b) not in ".,'-")
_STOP = _flags(lambda b: chr(b) in ".!?")
_FIRST = _flags(lambda b: b & 0xC0 != 0x80)


def passages(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Description of each passage, and the offset of each text's first passage."""
    offsets = texts.word_offsets
    n_words = np.diff(offsets)
    n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    ends = np.concatenate(([0], np.cumsum(n_passages)))
    out = np.zeros((ends[-1], _INPUT), np.float32)
    if not len(texts.word_starts):
        return out, ends
    docs = texts.word_docs
    passage = ends[docs] + (np.arange(len(docs)) - offsets[docs]) // PASSAGE_WORDS
    add = lambda values: np.bincount(passage, values, minlength=ends[-1])
    n = np.maximum(add(np.ones(len(passage))), 1)
    hashes = texts.word_hashes(lower=True)
    chars, letters = texts.count_in_words(_FIRST), texts.count_in_words(_LETTER)
    upper, digits, signs = (texts.count_in_words(t) for t in (_UPPER, _DIGIT, _SIGN))
    _, seen = repeated(mix(hashes + mix(passage.astype(np.uint64) + np.uint64(1))))
    _, before = repeated(mix(hashes + mix(docs.astype(np.uint64) + np.uint64(1))))
    as_last = np.zeros(len(hashes))
    as_last[1:] = (hashes[1:] == hashes[:-1]) & (docs[1:] == docs[:-1])
    total = np.maximum(add(chars), 1)
    columns = [
        np.log1p(add(np.ones(len(passage)))),
        add(chars) / n,
        np.sqrt(np.maximum(add(chars.astype(float) ** 2) / n - (add(chars) / n) ** 2, 0)),
        add(letters) / total,
        add(upper) / total,
        add(upper == letters) / n,
        add(digits) / total,
        add(signs) / total,
        add(signs == chars) / n,
        add(signs > 0) / n,
        add(texts.count_in_words(_STOP) > 0) / n,
        add(seen) / n,
        add(before) / n,
        add(as_last) / n,
        add(chars <= 3) / n,
    ]
    out[:, :_STATISTICS] = np.stack(columns, axis=1)
    for first in (None, 4):
        code = mix(texts.word_hashes(lower=True, first_bytes=first) + np.uint64(7))
        sign = np.where(code & np.uint64(1), 1.0, -1.0)
        cell = (code >> np.uint64(59)).astype(np.int64)
        out[:, _STATISTICS:] += np.bincount(passage * _HASHED + cell, sign, minlength=ends[-1] * _HASHED).reshape(-1, _HASHED)
    out[:, _STATISTICS:] /= np.sqrt(n)[:, None]
    return out, ends


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Layers of the network; without any, the share of ones is every score."""

    share: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: dict[str, np.ndarray] = field(default_factory=dict)

    def forward(self, x: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
        p, bags = self.layers, np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logit = (t * g) @ p["a"]
        weight = np.exp(logit - np.maximum.reduceat(logit, ends[:-1])[bags])
        weight /= np.add.reduceat(weight, ends[:-1])[bags]
        z = np.add.reduceat(weight[:, None] * h, ends[:-1])
        return {"x": x, "h": h, "t": t, "g": g, "weight": weight, "z": z, "bags": bags, "score": _sigmoid(z @ p["c"] + p["d"])}

    def backward(self, f: dict[str, np.ndarray], error: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the loss, given its slope by the score's logit."""
        p, bags = self.layers, f["bags"]
        by_z = error[:, None] * p["c"]
        by_weight = (by_z[bags] * f["h"]).sum(1)
        mean = np.add.reduceat(f["weight"] * by_weight, ends[:-1])
        by_logit = f["weight"] * (by_weight - mean[bags])
        by_t = by_logit[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2)
        by_g = by_logit[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
        by_h = f["weight"][:, None] * by_z[bags] + by_t @ p["V"].T + by_g @ p["U"].T
        by_in = by_h * (1 - f["h"] ** 2)
        return {
            "W": f["x"].T @ by_in, "b": by_in.sum(0), "V": f["h"].T @ by_t, "U": f["h"].T @ by_g,
            "a": (f["t"] * f["g"]).T @ by_logit, "c": f["z"].T @ error, "d": np.array(error.sum()),
        }

    def scores(self, texts: Texts) -> np.ndarray:
        x, ends = passages(texts)
        if not self.layers:
            return np.full(len(texts), self.share)
        return self.forward((x - self.center) / self.scale, ends)["score"] if len(texts) else np.zeros(0)


def fit_passages(x: np.ndarray, ends: np.ndarray, labels: np.ndarray, share: float) -> Model:
    model = Model(share)
    if len(set(labels.tolist())) < 2:
        return model
    model.center, model.scale = x.mean(0), x.std(0) + 1e-3
    x = (x - model.center) / model.scale
    draw = np.random.default_rng(8)
    model.layers = {k: draw.normal(0, 0.1 if k in "ac" else 0.2, s) if k not in "bd" else np.zeros(s) for k, s in _SHAPES.items()}
    # Each class weighs as much as among all labelled rows.
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean())) / len(labels)
    first = {k: np.zeros_like(v) for k, v in model.layers.items()}
    second = {k: np.zeros_like(v) for k, v in model.layers.items()}
    for step in range(1, _STEPS + 1):
        found = model.forward(x, ends)
        slopes = model.backward(found, (found["score"] - labels) * weight, ends)
        for k, slope in slopes.items():
            slope = slope + _RIDGE * model.layers[k] * (k not in "bd")
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            rate = _RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            model.layers[k] = model.layers[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def _described() -> TextFunction:
    def describe(texts: Texts) -> list[pa.Array]:
        x, ends = passages(texts)
        chosen = [a + np.unique(np.linspace(0, b - a - 1, min(b - a, FIT_PASSAGES)).round().astype(int)) for a, b in zip(ends, ends[1:], strict=False)]
        at = np.concatenate([np.zeros(0, np.int64), *chosen])
        offsets = np.concatenate(([0], np.cumsum([len(c) for c in chosen]))) * _INPUT
        return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(x[at].ravel(), pa.float32()))]

    return describe


def _learned(share: float):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table["passages"].combine_chunks()
        lengths = pc.list_value_length(lists).to_numpy() // _INPUT
        ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        model = fit_passages(lists.flatten().to_numpy().reshape(-1, _INPUT), ends, table["label"].to_numpy(), share)
        parts = model.layers | ({"center": model.center, "scale": model.scale} if model.layers else {})
        values = [pa.array([np.asarray(v, float).ravel() for v in parts.values()], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.string()), *values], ["name", "weights"])

    return learn


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit in one task, on the bounded sample; the driver gets the layers alone."""
    rows, share = fitting_rows(docs, labels, "quality")
    described = with_text_columns(rows, {"passages": "array<float>"}, _described, keep=["doc_id", "label"])
    one = described.repartition(1).sortWithinPartitions("doc_id", "passages")
    found = {r.name: np.array(r.weights) for r in one.mapInArrow(_learned(share), "name string, weights array<double>").collect()}
    model = Model(share)
    if found:
        model.center, model.scale = found["center"], found["scale"]
        model.layers = {k: found[k].reshape(shape) for k, shape in _SHAPES.items()}
    return model


def with_scores(docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Add the probability of good quality to the columns kept (all by default)."""
    return with_text_columns(docs, {name: "double"}, lambda: lambda texts: [pa.array(model.scores(texts))], keep)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A score and a prediction for every document."""
    found = with_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels), ["doc_id"])
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
