"""Packing documents into sequences of a fixed size, in their order, by dynamic programming.

The tokens of a task's documents form one stream. Cuts between sequences may fall after a document,
after a sentence, or anywhere; a sequence costs its padding plus the penalty of the cut that
ends it. ``best[j] = min(best[i] + size - (p[j] - p[i])) + penalty[j]`` over the cuts ``i`` at most a
sequence before ``j`` is a minimum of ``best[i] + p[i]`` over a sliding window, which a queue of increasing values
gives in constant time per cut. A sequence whose length is a power of two is stored as it is.

The stream is cut into stretches, each closed by its own last cut, so memory is bounded however
large a task is. Nothing is shuffled unless an order is asked for.
"""

from __future__ import annotations

import base64
import json
from collections import deque
from collections.abc import Iterator, Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from millrace.llm.texts import keyed_texts, pieces

# Sequence size, vocabulary, the id after each document.
SIZE = 1024
VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 0
# Padding tokens that a cut after a sentence, or inside one, is worth avoiding.
AFTER_SENTENCE, INSIDE = 1.0, 12.0
# Cuts inside sentences fall on a grid of so many places to a sequence.
GRID = 8
# Tokens of a stretch, and words remembered at a time.
STRETCH = 1 << 18
REMEMBERED = 400_000
# Lengths that need no padding and are worth looking for; shorter ones would make crumbs.
_POWERS = (SIZE // 2, SIZE // 4)


class Encoder:
    """Byte-level BPE ids of whole texts, with a memory of words met before.

    A blank that stands alone always begins a new token, and no token goes on past one, so what lies
    between two of them has the same ids everywhere. White space next to a blank would be read together
    with it; texts that have it are encoded in one go. The added tokens of the ``json`` file beside the
    vocabulary have no blanks; as in the tokenizers library they are found first, inside words too.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        with open(Path(path).with_suffix(".json"), encoding="utf-8") as file:
            self._added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
        self._lengths = np.zeros(max([*ranks.values(), *self._added.values()]) + 1, dtype=np.int64)
        for word, rank in chain(ranks.items(), ((a.encode(), i) for a, i in self._added.items())):
            self._lengths[rank] = len(word)
        self._encoding = tiktoken.Encoding(
            "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self._added)
        self._forget()

    def _encode(self, text: str) -> list[int]:
        if any(added in text for added in self._added):
            return self._encoding.encode(text, allowed_special="all")
        return self._encoding.encode_ordinary(text)

    def _forget(self) -> None:
        # By word: its number; by number: where its ids begin, how many, whether it ends a sentence,
        # whether it must not be read alone. Number 0 is the end of a document.
        self._number: dict[str, int] = {}
        self._ids = np.array([END_ID], dtype=np.uint32)
        self._start, self._count = np.array([0]), np.array([1])
        self._ends, self._unfit = np.array([False]), np.array([False])

    def _learn(self, words: list[str]) -> None:
        import re

        joined = f" {' '.join(words)}"
        unfit = np.zeros(len(words), dtype=bool)
        if re.search(r" \s|\s |\s$", joined):
            # Such words run into their neighbours; the others are then encoded without them.
            unfit = np.array([not w or w[0].isspace() or w[-1].isspace() for w in words])
            joined = "".join(f" {w}" for w, bad in zip(words, unfit) if not bad)
        ids = np.array(self._encode(joined), dtype=np.uint32)
        raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        # Only the blanks in front of words are blanks now.
        stops = np.append(np.flatnonzero(raw == 0x20), len(raw))[1:]
        after = np.zeros(len(words), dtype=np.int64)
        after[~unfit] = np.searchsorted(np.cumsum(self._lengths[ids]), stops, side="right")
        after = np.maximum.accumulate(after)
        counts = np.diff(after, prepend=0)
        ends = np.zeros(len(words), dtype=bool)
        ends[~unfit] = np.isin(raw[stops - 1], list(b".!?"))
        self._number.update(zip(words, range(len(self._start), len(self._start) + len(words))))
        self._start = np.append(self._start, len(self._ids) + after - counts)
        self._ids = np.append(self._ids, ids)
        self._count = np.append(self._count, counts)
        self._ends = np.append(self._ends, ends)
        self._unfit = np.append(self._unfit, unfit)

    def __call__(self, texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text its ids with ``END_ID`` last, and the numbers of ids up to each sentence's end."""
        if len(self._number) > REMEMBERED:
            self._forget()
        split = [text.split(" ") for text in texts]
        rest = list(chain.from_iterable(words[1:] for words in split))
        new = set(rest).difference(self._number)
        if new:
            self._learn(list(new))
        numbers = np.fromiter(map(self._number.__getitem__, rest), dtype=np.int64, count=len(rest))
        found, at = [], 0
        for text, words in zip(texts, split):
            own = numbers[at:at + len(words) - 1]
            at += len(words) - 1
            if not words[0] or words[0][-1].isspace() or self._unfit[own].any():
                found.append(self._whole(text))
                continue
            first = self._encode(words[0])
            own = np.append(own, 0)
            counts = self._count[own]
            ends = np.cumsum(counts)
            places = np.arange(ends[-1]) + np.repeat(self._start[own] - ends + counts, counts)
            ids = np.concatenate([np.array(first, dtype=np.uint32), self._ids[places]])
            found.append((ids, len(first) + ends[self._ends[own]]))
        return found

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        import re

        ids = np.array([*self._encode(text), END_ID], dtype=np.uint32)
        stops = [m.end() for m in re.finditer(rb"[.!?](?=\s)", text.encode("utf-8", "surrogatepass"))]
        ends = np.cumsum(self._lengths[ids[:-1]])
        places = np.searchsorted(ends, np.array(stops, dtype=np.int64)) + 1
        return ids, places[places < len(ids)]


def best_cuts(places: np.ndarray, penalties: np.ndarray, size: int = SIZE) -> list[int]:
    """The cheapest chain of cuts, as indexes into ``places``, first and last place included.

    ``places`` rise by at most ``size`` at a time. A sequence costs its padding up to ``size``, none if its
    length is a power of two, plus the penalty of the place where it ends.
    """
    at, extra = places.tolist(), penalties.tolist()
    exact = []
    for power in _POWERS:
        before = np.searchsorted(places, places - power)
        exact.append(np.where(places[before] == places - power, before, -1).tolist())
    value, back = [0.0] * len(at), [0] * len(at)
    value[0] = float(at[0])
    window = deque([0])
    for j in range(1, len(at)):
        here = at[j]
        while at[window[0]] < here - size:
            window.popleft()
        i = window[0]
        cost = value[i] + size - here
        for before in exact:
            k = before[j]
            if k >= 0 and value[k] - at[k] < cost:
                i, cost = k, value[k] - at[k]
        back[j] = i
        value[j] = total = cost + extra[j] + here
        while window and value[window[-1]] >= total:
            window.pop()
        window.append(j)
    cuts, j = [], len(at) - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return [0, *reversed(cuts)]


def _cut_places(texts: list[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the stream where a sequence may end, and what a cut there costs."""
    begins = np.cumsum([0, *[len(ids) for ids, _ in texts]])
    sentences = np.concatenate([ends + begin for (_, ends), begin in zip(texts, begins)])
    places = np.unique(np.concatenate([begins, sentences]))
    # A grid that the size is a multiple of: from each of its places a full sequence reaches another.
    grid = np.arange(0, begins[-1], size // GRID)
    every = np.union1d(places, grid).astype(np.int64)
    penalties = np.full(len(every), INSIDE)
    penalties[np.searchsorted(every, places)] = AFTER_SENTENCE
    penalties[np.searchsorted(every, begins)] = 0.0
    return every, penalties


def pack_stretch(keys: list, texts: list[tuple[np.ndarray, np.ndarray]], first_id: int,
                 size: int = SIZE) -> tuple[dict[str, list], int]:
    """Pieces of a stretch of documents, and the next sequence's number."""
    places, penalties = _cut_places(texts, size)
    cuts = places[best_cuts(places, penalties, size)]
    begins = np.cumsum([0, *[len(ids) for ids, _ in texts]])
    # Pieces lie between neighbouring borders, of documents or of sequences.
    borders = np.unique(np.concatenate([begins, cuts]))
    left, right = borders[:-1], borders[1:]
    doc = np.searchsorted(begins, left, side="right") - 1
    sequence = np.searchsorted(cuts, left, side="right") - 1
    stream = np.concatenate([ids for ids, _ in texts]).astype("<u4")
    return {
        "key": [keys[d] for d in doc.tolist()],
        "start": left - begins[doc],
        "length": right - left,
        "ids": [stream[a:b].tobytes() for a, b in zip(left.tolist(), right.tolist())],
        "doc_tokens": (begins[1:] - begins[:-1])[doc],
        "sequence_id": first_id + sequence,
        "offset": left - cuts[sequence],
    }, first_id + len(cuts) - 1


def pack(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text",
         size: int = SIZE, order: Sequence[str] = ()) -> DataFrame:
    """One row per piece: its document's key, ``start`` in the document, ``length``, ``ids`` (little-endian
    unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id``, and ``offset`` in the sequence.

    ``vocabulary`` is the path of a file of ranks that every executor has, as well as the ``json`` file of the same
    name, ``pattern`` its splitting rule. Documents keep the order in which they are stored, or that of ``order``, at the price of a
    range shuffle. Every row is packed: a missing or empty text is its end id alone, repeated rows are
    packed each, and a missing key stays missing. Sequence numbers hold for one run: they name the task that
    packed them, and a task that is run again gives the same ones.
    """
    if order:
        docs = docs.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*map(F.col, order))
    schema = T.StructType([
        docs.schema[key], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        next_id = TaskContext.get().partitionId() << 36
        encode = Encoder(vocabulary, pattern)
        keys: list = []
        texts: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def rows() -> pa.RecordBatch:
            nonlocal next_id
            found, next_id = pack_stretch(keys, texts, next_id, size)
            return pa.RecordBatch.from_arrays(
                [pa.array(column, type=field.type) for column, field in zip(found.values(), arrow)],
                schema=arrow)

        for piece in pieces(batches):
            new = piece.to_pydict()
            for name, found in zip(new[key], encode(new[text])):
                keys.append(name)
                texts.append(found)
                waiting += len(found[0])
                if waiting >= STRETCH:
                    yield rows()
                    keys, texts, waiting = [], [], 0
        if texts:
            yield rows()

    return keyed_texts(docs, key, text).mapInArrow(packed, schema)
