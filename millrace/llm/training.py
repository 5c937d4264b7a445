"""Fitting a small model on a bounded sample of labelled rows, inside one task."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.texts import keyed_texts, text_batches

# Bounds of a sample: rows of each class, and code points of a text that may be in it.
ROWS_PER_CLASS, MOST_CHARACTERS = 3_000, 20_000


def key_remainder(key: Column, modulus: int) -> Column:
    """CRC-32 of the key as text, modulo ``modulus``; a missing key has none."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def fit(docs: DataFrame, labels: DataFrame, label: str, train: Column,
        kind: type, learn: Callable[[list[str], list[int], float], object], key: str = "doc_id", text: str = "text",
        rows_per_class: int = ROWS_PER_CLASS, most_characters: int = MOST_CHARACTERS):
    """The model, a ``kind``, that ``learn`` makes of texts, their labels 0 and 1, and the share of label 1
    among all rows to learn from; nothing if a class has no rows.

    ``train`` chooses among ``labels``. Of each class the ``rows_per_class`` rows with the smallest hashes of
    their keys are learnt from, as far as their texts exist and have at most ``most_characters`` code points: the one task that
    learns holds no more than that at any size of input. Only the model reaches the driver.
    """
    counts = {row[label]: row["n"] for row in labels.where(train & F.col(label).isin(0, 1)).groupBy(label).agg(
        F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    share = counts[1] / (counts[0] + counts[1])
    chosen = None
    for value in (0, 1):
        rows = labels.where(train & (F.col(label) == value) & F.col(key).isNotNull()).select(
            F.col(key).alias("_key"), F.lit(value).alias("_label")).distinct() \
            .orderBy(F.xxhash64("_key"), "_key").limit(rows_per_class)
        chosen = rows if chosen is None else chosen.unionByName(rows)
    texts = keyed_texts(docs, key, text).where(F.length(text) <= most_characters)
    sample = texts.join(F.broadcast(chosen), F.col(key) == F.col("_key")).select("_key", "_label", text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[tuple, str] = {}
        for batch in batches:
            for k, value, body in zip(*(column.to_pylist() for column in batch.columns)):
                # Of rows that repeat a key, the smallest text; so the order of arrival does not matter.
                rows[k, value] = min(rows.get((k, value), body), body)
        ordered = sorted(rows)
        model = learn([rows[r] for r in ordered], [r[1] for r in ordered], share) \
            if len({value for _, value in ordered}) == 2 else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model and vars(model))], pa.binary())], ["model"])

    with text_batches(docs.sparkSession):
        found = sample.repartition(1).mapInArrow(task, "model binary").first()
    state = pickle.loads(found["model"]) if found else None
    return state and kind(**state)


def prior_shift(labels: Sequence[int], share: float | None) -> float:
    """What the logarithm of the odds of label 1 gains when its share is ``share`` instead of the sample's."""
    own = sum(labels) / len(labels)
    return 0.0 if share is None else math.log(share / (1 - share)) - math.log(own / (1 - own))


def logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of the likeliest logistic curve with a small ridge, by Newton steps."""
    w = np.zeros(features.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        gradient = features.T @ (p - labels) + ridge * len(labels) / 100 * w
        hessian = (features * (p * (1 - p))[:, None]).T @ features + (ridge * len(labels) / 100 + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, float(np.abs(step).max()) / 4)
    return w
