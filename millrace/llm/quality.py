"""Quality: a convolutional network over a document's bytes, in numpy.

Learned filters of ``WIDTH`` bytes slide over the text with stride ``STRIDE``. Each byte value has its own weight at every
place of every filter, so a filter is a sum of table rows. The text is cut into chunks that overlap by a
filter's width, so that no stretch of bytes is left out; a chunk's features are the largest responses
of each filter, and a document's are their mean, their largest and the mean responses over all chunks, the last chunk
counting by its length. A dense layer makes one probability of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.texts import keyed_texts, map_rows
from millrace.llm.training import logistic, prior_shift

FILTERS, WIDTH, STRIDE = 12, 6, 2
# Responses of one chunk: with the stride, 512 bytes, overlapping the next by WIDTH - STRIDE.
CHUNK = 256
# Training: passes over the sample, documents to a step, step size, and chunks of a document in one step.
EPOCHS, BATCH, RATE, CHUNKS = 6, 32, 0.02, 12


@dataclass
class Model:
    """``filters`` (WIDTH, 256, FILTERS), their ``bias``, and the dense layer's weights, its bias last."""

    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray


def padded(text: str) -> np.ndarray:
    """The text's bytes, with zeros up to one filter at least and to a whole number of strides."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    size = max(WIDTH, -(-max(0, len(raw) - WIDTH) // STRIDE) * STRIDE + WIDTH)
    return np.concatenate([raw, np.zeros(size - len(raw), dtype=np.uint8)])


def responses(data: np.ndarray, model: Model) -> np.ndarray:
    """Every filter at every place, negative ones as zero."""
    n = (len(data) - WIDTH) // STRIDE + 1
    out = np.repeat(model.bias[None, :], n, axis=0)
    for i in range(WIDTH):
        out += model.filters[i][data[i:i + STRIDE * (n - 1) + 1:STRIDE]]
    return np.maximum(out, 0, out=out)


def pooled(values: np.ndarray) -> np.ndarray:
    """A document's features of its filters' responses."""
    starts = np.arange(0, len(values), CHUNK)
    peaks = np.maximum.reduceat(values, starts)
    weight = np.diff(np.append(starts, len(values))) / len(values)
    return np.concatenate([weight @ peaks, peaks.max(axis=0), values.mean(axis=0)])


def probability(model: Model, text: str) -> float:
    features = pooled(responses(padded(text), model))
    return float(1 / (1 + np.exp(-np.clip(features @ model.dense[:-1] + model.dense[-1], -30, 30))))


def _gradients(model: Model, data: np.ndarray, label: float, filters: np.ndarray, bias: np.ndarray,
               dense: np.ndarray) -> None:
    """Adds one document's gradients of the logistic loss."""
    values = responses(data, model)
    starts = np.arange(0, len(values), CHUNK)
    ends = np.append(starts[1:], len(values))
    where = np.array([values[a:b].argmax(axis=0) + a for a, b in zip(starts, ends)])
    peaks = np.take_along_axis(values, where, axis=0)
    weight = (ends - starts) / len(values)
    top = peaks.argmax(axis=0)
    features = np.concatenate([weight @ peaks, peaks.max(axis=0), values.mean(axis=0)])
    p = 1 / (1 + np.exp(-np.clip(features @ model.dense[:-1] + model.dense[-1], -30, 30)))
    error = p - label
    dense[:-1] += error * features
    dense[-1] += error
    back = error * model.dense[:-1]
    by_chunk, by_top, by_mean = np.split(back, 3)
    change = np.repeat((by_mean / len(values))[None, :], len(values), axis=0)
    columns = np.arange(values.shape[1])
    for chunk, places in enumerate(where):
        change[places, columns] += weight[chunk] * by_chunk + (top == chunk) * by_top
    change *= values > 0
    bias += change.sum(axis=0)
    for i in range(WIDTH):
        at = data[i:i + STRIDE * (len(values) - 1) + 1:STRIDE]
        order = np.argsort(at, kind="stable")
        found, first = np.unique(at[order], return_index=True)
        filters[i][found] += np.add.reduceat(change[order], first, axis=0)


def learn(texts: list[str], labels: list[int], share: float | None = None) -> Model:
    """The network fitted to labelled documents by Adam steps; ``share`` is that of label 1 outside the sample.

    A step looks at ``CHUNKS`` chunks of a document at most, other ones in each pass.
    """
    draw = np.random.default_rng(11)
    model = Model(draw.normal(0, 0.1, (WIDTH, 256, FILTERS)), np.zeros(FILTERS), draw.normal(0, 0.1, 3 * FILTERS + 1))
    data = [padded(t) for t in texts]
    y = np.array(labels, dtype=float)
    parts = [model.filters, model.bias, model.dense]
    means = [np.zeros_like(x) for x in parts]
    squares = [np.zeros_like(x) for x in parts]
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(data))
        rate = RATE * (1 - epoch / EPOCHS)
        for start in range(0, len(order), BATCH):
            batch = order[start:start + BATCH]
            sums = [np.zeros_like(x) for x in parts]
            for d in batch:
                most = CHUNK * STRIDE * CHUNKS
                shift = int(draw.integers(0, max(1, len(data[d]) - most) // STRIDE + 1)) * STRIDE
                piece = data[d][shift:shift + most]
                _gradients(model, piece[:len(piece) - (len(piece) - WIDTH) % STRIDE], y[d], *sums)
            step += 1
            for x, g, mean, square in zip(parts, sums, means, squares):
                g /= len(batch)
                mean += 0.1 * (g - mean)
                square += 0.01 * (g * g - square)
                x -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-6)
    # The dense layer once more, on whole documents.
    features = np.array([np.append(pooled(responses(d, model)), 1.0) for d in data])
    model.dense = logistic(features, y)
    model.dense[-1] += prior_shift(labels, share)
    return Model(model.filters.astype(np.float32), model.bias.astype(np.float32), model.dense)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key and ``score``, 0 to 1: how likely its label is 1; whole texts are read.

    Without a model, because a class had no labelled rows, every score is 0. Missing and empty texts are
    scored as a filter's width of zero bytes; repeated rows stay; nothing else of a row is looked at.
    """
    schema = T.StructType([docs.schema[key], T.StructField("score", T.DoubleType())])

    def prepare():
        def scored(columns: dict[str, list]) -> dict[str, list]:
            return {key: columns[key], "score": [
                0.0 if model is None else probability(model, body) for body in columns[text]]}

        return scored

    return map_rows(keyed_texts(docs, key, text), [key, text], schema, prepare)
