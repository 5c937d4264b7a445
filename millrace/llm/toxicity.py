"""Toxicity: a support vector machine on gap-weighted subsequences of words.

The kernel of two words sums over all their common subsequences of ``ORDER`` characters, each
occurrence weighing ``DECAY`` to the length of its stretch, so inserted characters and gaps lower it without
breaking it; words are scaled by the root of their occurrences' squared weights. Landmarks are words that mark toxic sentences of the sample; the kernel against them, whitened, is
the Nyström map. A sentence counts by its worst word, and the machine is trained on sentences: all of
clean documents against the worst ones of toxic documents, chosen anew with each round's machine.

The alphabet has 32 letters, so a word's subsequences can be counted in a table of 32 to the power of ``ORDER``
entries. Landmarks, map and machine fold into one such table of weights; a word's margin is a sum over its own subsequences.
A document's score comes from its worst sentences' margins by a logistic curve.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.texts import keep_rows, keyed_texts, map_rows
from millrace.llm.training import logistic, prior_shift

ORDER, DECAY = 4, 0.7
# How alike two landmarks may be.
ALIKE = 0.6
TINY = np.float32(1e-12)
# Longer words are read in windows of this many characters that overlap by half: so far apart may an insult's letters be among
# other letters. Signs between them do not count, as they are dropped before.
WINDOW = 24
# Widest stretch of a landmark's subsequences: wider ones weigh little. Those of the words held against them may be any.
LANDMARK_STRETCH = 8
# Subsequences that keep their weights in the model, those with the largest.
KEPT = 2_000
# Words that are less like every landmark than this take part in a fit as words that have nothing of any; words looked at together.
NEAR, TOGETHER = 0.2, 40_000
# Rows of a machine's sample that are taken to doubles together.
AT_ONCE = 8_192
# A toxic document that is missed counts as much as so many clean ones that are rejected.
MISSED = 2
# Up to this length a word's subsequences are gone through one by one; longer ones are counted place by place.
LISTED = 14
# Longest stretch of a subsequence: all there are. Words are scaled, so in a word with wide gaps long stretches are all.
STRETCH = WINDOW
# Neighbouring words of so many characters at most are read joined up too, up to so many together.
SHORT, JOINED = 4, 10
LANDMARKS, CANDIDATES = 96, 2_000
ROUNDS = 4
# Parts of the documents that the curve is fitted on, each by a machine that has not seen it.
FOLDS = 2
# Worst sentences a document's score looks at, levels over which it counts sentences, and sentences of one
# document that training uses at most.
WORST, LEVELS, TRAINED = 3, (-0.5, 0.0, 0.5), 25
# Stands before each word, a letter of its own: how a word begins tells more than that its letters occur.
BEGIN = "\ue000"
# Words whose margins are remembered at a time.
REMEMBERED = 400_000
# Figures and signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


def _letters() -> np.ndarray:
    """Code of each character below 65536: 1 to 26 for a to z, 27 for a word's beginning, 28 to 31 for other letters, 0 for none."""
    codes = np.zeros(1 << 16, dtype=np.int64)
    for c in range(1 << 16):
        if chr(c).isalpha():
            codes[c] = c - 96 if 97 <= c <= 122 else 28 + c % 4
    codes[ord(BEGIN)] = 27
    for sign, letter in LOOKALIKES.items():
        codes[ord(sign)] = ord(letter) - 96
    return codes


def _rows(words: list[str], letters: np.ndarray):
    """``(places, codes)``: words of the same length together, up to ``TOGETHER``, one row of letter codes each."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    by_length = np.argsort(lengths, kind="stable")
    for same in np.split(by_length, np.flatnonzero(np.diff(lengths[by_length])) + 1):
        for start in range(0, len(same), TOGETHER):
            places = same[start:start + TOGETHER]
            text = np.frombuffer("".join([words[i] for i in places.tolist()]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            if len(text):
                yield places, letters[np.where(text < 1 << 16, text, 0x4E00 + text % 5)].reshape(len(places), -1)


def _numbered(texts: Sequence[str], numbers: dict[str, int]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per text its words' numbers and their sentences, numbered across texts, and how many words each has.

    New words get the next numbers. Of a text's words nothing else is kept, so memory follows the different words.
    """
    words, sentences, first = [], [], 0
    for text in texts:
        own, at = units(text)
        words.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), dtype=np.int32, count=len(own)))
        sentences.append(first + np.array(at, dtype=np.int32))
        first += max(at, default=0) + 1
    return words, sentences, np.fromiter(map(len, words), dtype=np.int64, count=len(words))


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)


def _subsequences(codes: np.ndarray, stretch: int = STRETCH):
    """``(span, indexes)`` of subsequences up to a stretch, a step for each choice of places; where a place has no letter the
    index has no entry in a table of subsequences (``_WITHOUT``)."""
    n = codes.shape[1]
    shifted = [np.ascontiguousarray(codes.T.astype(np.int32) << 5 * k) for k in range(ORDER)]
    for i in range(n - 3):
        for j in range(i + 1, min(n - 2, i + stretch)):
            pair = shifted[3][i] | shifted[2][j]
            for k in range(j + 1, min(n - 1, i + stretch)):
                triple = pair | shifted[1][k]
                for m in range(k + 1, min(n, i + stretch)):
                    yield m - i + 1, triple | shifted[0][m]


def _without() -> np.ndarray:
    """Indexes in which a place has no letter."""
    index = np.arange(1 << 5 * ORDER)
    return np.logical_or.reduce([index >> 5 * k & 31 == 0 for k in range(ORDER)])


_WITHOUT = _without()


class _Counts:
    """Sums over subsequences by place: prefixes of the subsequences that have a row in a table are counted up to each place.

    Weights of a stretch are split into one for its first and one for its last place, so nothing decays on the way, and
    a place touches only the prefixes that its letter ends. The cost follows the length, not its fourth power.
    """

    def __init__(self, used: np.ndarray, table: np.ndarray):
        self.table = table
        triples, of_triple = np.unique(used >> 5, return_inverse=True)
        pairs, of_pair = np.unique(triples >> 5, return_inverse=True)
        self.sizes = len(pairs), len(triples)
        self.by_letter = {}
        for c in range(1, 32):
            ends, thirds, seconds = (np.flatnonzero(x & 31 == c) for x in (used, triples, pairs))
            self.by_letter[c] = (of_triple[ends], ends, thirds, of_pair[thirds], seconds, pairs[seconds] >> 5)

    def sums(self, codes: np.ndarray) -> np.ndarray:
        total = np.zeros((len(codes), self.table.shape[1]), dtype=np.float32)
        step = max(16, (1 << 23) // (sum(self.sizes) + 32))
        for start in range(0, len(codes), step):
            part = codes[start:start + step]
            ones, twos, threes = (np.zeros((len(part), n), dtype=np.float32) for n in (32, *self.sizes))
            for place in range(part.shape[1]):
                for c in np.unique(part[:, place]).tolist():
                    if c == 0:
                        continue
                    rows = np.flatnonzero(part[:, place] == c)
                    before, ends, thirds, of_pair, seconds, firsts = self.by_letter[c]
                    if len(ends):
                        total[start + rows] += np.float32(DECAY ** (place + 1)) * (threes[np.ix_(rows, before)] @ self.table[ends])
                    threes[np.ix_(rows, thirds)] += twos[np.ix_(rows, of_pair)]
                    twos[np.ix_(rows, seconds)] += ones[np.ix_(rows, firsts)]
                    ones[rows, c] += np.float32(DECAY ** -place)
        return total


def _squares(codes: np.ndarray) -> np.ndarray:
    """Sum over each row's subsequences of their squared weights."""
    counts = np.zeros((ORDER, len(codes)))
    for place in range(codes.shape[1]):
        letter = codes[:, place] > 0
        counts[ORDER - 1] += letter * counts[ORDER - 2] * DECAY ** (2 * (place + 1))
        for k in range(ORDER - 2, 0, -1):
            counts[k] += letter * counts[k - 1]
        counts[0] += letter * DECAY ** (-2 * place)
    return counts[ORDER - 1]


def _padded(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of several lengths as one table; what is added stands for no letter."""
    longest = max(codes.shape[1] for _, codes in rows)
    return np.concatenate([places for places, _ in rows]), np.concatenate(
        [np.pad(codes, ((0, 0), (0, longest - codes.shape[1]))) for _, codes in rows])


@dataclass
class Model:
    """Weights of subsequences and bias: a word's margin; weights of a document's features."""

    weights: np.ndarray
    bias: float
    curve: np.ndarray

    def word_margins(self, words: list[str], letters: np.ndarray) -> np.ndarray:
        found = np.full(len(words), self.bias)
        weights = np.where(_WITHOUT, np.float32(0), self.weights)
        long = []
        for places, codes in _rows(words, letters):
            if codes.shape[1] > LISTED:
                long.append((places, codes))
                continue
            by_span = np.zeros((codes.shape[1] + 1, len(places)), dtype=np.float32)
            for span, index in _subsequences(codes):
                by_span[span] += weights.take(index)
            total = DECAY ** np.arange(codes.shape[1] + 1) @ by_span
            found[places] += total / np.sqrt(np.maximum(_squares(codes), TINY))
        if long:
            places, codes = _padded(long)
            used = np.flatnonzero(weights)
            total = _Counts(used, weights[used][:, None]).sums(codes)[:, 0]
            found[places] += total / np.sqrt(np.maximum(_squares(codes), TINY))
        return found


# What readings drop: signs and figures that stand for no letter, and repeats of a character from the third on.
_SIGN = rf"(?![{''.join(LOOKALIKES)}])[\W\d_]"
_LETTER = rf"(?:[^\W\d_]|[{''.join(LOOKALIKES)}])"
_ODD = re.compile(rf"{_LETTER}{_SIGN}+{_LETTER}|(.)\1\1")
_TRIPLE = re.compile(r"(\S)\1\1")
_SIGNS, _REPEATS = re.compile(rf"{_SIGN}+"), re.compile(r"(.)\1\1+")


def _plain(word: str) -> str:
    """The word without inserted signs, with repeats of three or more characters as one."""
    return _REPEATS.sub(r"\1", _SIGNS.sub("", word))


# Latin letters with accents and the letters they are read as.
_BARE = str.maketrans({c: "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
                       for c in map(chr, range(0xC0, 0x250))})


def _unaccented(word: str) -> str:
    if max(word) < "\u0250":
        return word.translate(_BARE)
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def units(text: str) -> tuple[list[str], list[int]]:
    """The text's words in lower case, and the number of the sentence each is in.

    Three or more characters that stand alone in a row count as a word of their own besides, and so do neighbouring
    short words of a sentence joined up, and words without the signs and repeats inside them, and without accents; longer
    words than ``WINDOW`` are read in overlapping windows. Words that have a subsequence at all begin with ``BEGIN``.
    """
    lower = text.lower()
    words = lower.split()
    sentences, at = [], 0
    for word in words:
        sentences.append(at)
        if word[-1] in ".!?":
            at += 1
    original = len(words)
    extra: list[tuple[str, int]] = []
    # Most words are letters alone, in texts without a threefold character: there is nothing to look for in them.
    triple = _TRIPLE.search(lower) is not None
    odd = {word: _plain(word) for word in set(words) if (triple or not word.isalpha()) and _ODD.search(word)}
    if odd:
        extra += [(odd[word], s) for word, s in zip(words, sentences) if word in odd]
    if not text.isascii():
        bare = {word: _unaccented(word) for word in {*words, *odd.values()} if not word.isascii()}
        bare = {word: plain for word, plain in bare.items() if plain != word}
        extra += [(bare[word], s) for word, s in zip(words, sentences) if word in bare]
        extra += [(bare[odd[word]], s) for word, s in zip(words, sentences) if odd.get(word) in bare]
    sizes = list(map(len, words))
    for i in range(original - 1):
        if sizes[i] <= SHORT and sizes[i + 1] <= SHORT:
            joined, j = words[i], i + 1
            while j < original and sizes[j] <= SHORT and len(joined) + sizes[j] <= JOINED \
                    and sentences[j] == sentences[i]:
                joined += words[j]
                extra.append((joined, sentences[i]))
                j += 1
    lone = [i for i, word in enumerate(words) if len(word) == 1]
    single, of = words, sentences
    words = words + [word for word, _ in extra]
    sentences = sentences + [s for _, s in extra]
    words = [BEGIN + word if len(word) >= ORDER else word for word in words]
    if max(map(len, words), default=0) > WINDOW:
        cut = [(part, s) for word, s in zip(words, sentences) for part in windows(word)]
        words, sentences = [w for w, _ in cut], [s for _, s in cut]
    run: list[int] = []
    for i in [*lone, -1]:
        if run and i != run[-1] + 1:
            if len(run) > 2:
                joined = BEGIN + "".join(single[k] for k in run)
                for part in windows(joined):
                    words.append(part)
                    sentences.append(of[run[0]])
            run = []
        run.append(i)
    return words, sentences


def windows(word: str) -> list[str]:
    if len(word) <= WINDOW:
        return [word]
    return [word[i:i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def pooled(margins: np.ndarray, sentences: np.ndarray, documents: np.ndarray, n: int) -> np.ndarray:
    """Per document: its ``WORST`` largest sentence margins, between -1 and 1.5; of its words above each of ``LEVELS`` the
    logarithms of their number and of their share; and a 1.

    ``sentences`` are numbered across documents, in order of documents; words need no order.
    """
    features = np.zeros((n, WORST + 2 * len(LEVELS) + 1))
    features[:, :WORST] = -1.0
    features[:, -1] = 1.0
    sizes = np.bincount(documents, minlength=n)
    for k, level in enumerate(LEVELS):
        above = np.bincount(documents[margins > level], minlength=n)
        features[:, WORST + 2 * k] = np.log1p(above)
        features[:, WORST + 2 * k + 1] = np.log1p(100 * above / (sizes + 20))
    if len(margins):
        worst = np.full(int(sentences.max()) + 1, -np.inf)
        np.maximum.at(worst, sentences, margins)
        owner = np.zeros(len(worst), dtype=np.int64)
        owner[sentences] = documents
        used = np.flatnonzero(worst > -np.inf)
        order = used[np.lexsort((-worst[used], owner[used]))]
        of = owner[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        kept = rank < WORST
        features[of[kept], rank[kept]] = np.clip(worst[order[kept]], -1.0, 1.5)
    return features


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 0.1) -> np.ndarray:
    """Squared hinge loss with a ridge, by Newton steps on the rows inside the margin; the last column is the bias.

    Rows are taken to doubles and summed up ``AT_ONCE`` at a time.
    """
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    parts = [slice(start, start + AT_ONCE) for start in range(0, len(x), AT_ONCE)]

    def within(v: np.ndarray) -> np.ndarray:
        return np.concatenate([y[part] * (x[part].astype(np.float64) @ v) < 1 for part in parts])

    for _ in range(30):
        inside = within(w)
        squares, sums = np.zeros((len(w), len(w))), np.zeros(len(w))
        for part in parts:
            rows = x[part][inside[part]].astype(np.float64)
            weighed = cost * (rows * weight[part][inside[part]][:, None]).T
            squares += weighed @ rows
            sums += weighed @ y[part][inside[part]]
        new = np.linalg.solve(squares + ridge, sums)
        if np.allclose(new, w, atol=1e-7):
            break
        w = (w + new) / 2 if np.any(within(new) != inside) else new
    return w


def _curve(features: np.ndarray, labels: np.ndarray, share: float | None) -> np.ndarray:
    found = logistic(features, labels)
    found[-1] += prior_shift(labels.tolist(), share) + np.log(MISSED)
    return found


class _Sample:
    """Labelled documents as numbers: each word's number, sentence and document."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        words, sentences, sizes = _numbered(texts, numbers)
        self.vocabulary = list(numbers)
        self.words, self.sentences = _joined(words), _joined(sentences)
        every = np.arange(len(texts), dtype=np.int32)
        self.documents = np.repeat(every, sizes)
        # Each word once for a document.
        present = [np.unique(own) for own in words]
        self.present = _joined(present), np.repeat(every, list(map(len, present)))


def _vector(word: str, letters: np.ndarray) -> Counter:
    found: Counter = Counter()
    for _, codes in _rows([word], letters):
        for span, index in _subsequences(codes, LANDMARK_STRETCH):
            if not _WITHOUT[index[0]]:
                found[int(index[0])] += DECAY ** span
    return found


def _kernel(a: Counter, b: Counter) -> float:
    return sum(v * b[k] for k, v in a.items() if k in b)


def _landmarks(sample: _Sample, y: np.ndarray, known: np.ndarray, letters: np.ndarray) -> list[Counter]:
    """One after the other, the word that marks toxic documents best, those that have landmarks already counting half
    for each: so every kind of insult gets some, however rare its language is. ``known`` documents alone are looked at."""
    words, documents = sample.present
    n1, n0 = max(1, int((known & (y == 1)).sum())), max(1, int((known & (y == 0)).sum()))
    toxic = np.bincount(words[known[documents] & (y[documents] == 1)], minlength=len(sample.vocabulary))
    clean = np.bincount(words[known[documents] & (y[documents] == 0)], minlength=len(sample.vocabulary))
    mark = toxic / n1 - 2 * clean / n0
    listed = [i for i in np.argsort(-mark, kind="stable")[:CANDIDATES] if mark[i] > 0]
    column = np.full(len(sample.vocabulary), -1)
    column[listed] = np.arange(len(listed))
    stands = np.zeros((len(listed), len(y)), dtype=np.float32)
    inside = (column[words] >= 0) & known[documents]
    stands[column[words[inside]], documents[inside]] = 1.0
    open_documents = (known & (y == 1)).astype(np.float32) / n1
    cost = 2 * clean[listed] / n0
    landmarks: list[Counter] = []
    norms: list[float] = []
    while len(landmarks) < LANDMARKS and len(listed):
        gain = stands @ open_documents - cost
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        cost[best] = np.inf
        v = _vector(sample.vocabulary[listed[best]], letters)
        norm = _kernel(v, v)
        # A landmark must be unlike the others.
        if norm > 0 and all(_kernel(v, o) < ALIKE * (norm * n) ** 0.5 for o, n in zip(landmarks, norms)):
            landmarks.append(v)
            norms.append(norm)
            open_documents *= 1 - stands[best] / 2
    return landmarks


@dataclass
class _Map:
    """The Nyström map: subsequences that landmarks have, their weights in each landmark, the whitening; of the sample's words
    the row in ``mapped``, whose first one stands for words like no landmark, and how near the nearest landmark is."""

    used: np.ndarray
    table: np.ndarray
    whiten: np.ndarray
    row: np.ndarray
    mapped: np.ndarray
    nearest: np.ndarray

    def margins(self, w: np.ndarray) -> np.ndarray:
        return (self.mapped @ w.astype(np.float32))[self.row]


def _mapped(sample: _Sample, landmarks: list[Counter], letters: np.ndarray) -> _Map:
    norms = np.array([_kernel(v, v) ** 0.5 for v in landmarks])
    gram = np.array([[_kernel(a, b) for b in landmarks] for a in landmarks]) / np.outer(norms, norms)
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-3 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    # Only the landmarks' own subsequences have rows.
    used = np.array(sorted({u for v in landmarks for u in v}))
    table = np.zeros((len(used), len(landmarks)), dtype=np.float32)
    for m, v in enumerate(landmarks):
        table[np.searchsorted(used, list(v)), m] = np.array(list(v.values())) / norms[m]
    at_index = np.full(1 << 5 * ORDER, -1, dtype=np.int32)
    at_index[used] = np.arange(len(used))
    counts = _Counts(used, table)
    row = np.zeros(len(sample.vocabulary), dtype=np.int32)
    nearest = np.zeros(len(sample.vocabulary), dtype=np.float32)
    mapped = [np.append(np.zeros(whiten.shape[1]), 1.0).astype(np.float32)[None, :]]
    rows = 1
    for places, codes in _rows(sample.vocabulary, letters):
        if codes.shape[1] > LISTED:
            against = counts.sums(codes)
        else:
            against = np.zeros((len(places), len(landmarks)), dtype=np.float32)
            for span, index in _subsequences(codes):
                at = at_index.take(index)
                hit = np.flatnonzero(at >= 0)
                against[hit] += np.float32(DECAY ** span) * table[at[hit]]
        against /= np.sqrt(np.maximum(_squares(codes), TINY))[:, None]
        nearest[places] = against.max(axis=1)
        near = np.flatnonzero(nearest[places] >= NEAR)
        row[places[near]] = rows + np.arange(len(near))
        rows += len(near)
        mapped.append(np.hstack([against[near] @ whiten.astype(np.float32), np.ones((len(near), 1), dtype=np.float32)]))
    return _Map(used, table, whiten, row, np.concatenate(mapped), nearest)


def _fitted(sample: _Sample, y: np.ndarray, known: np.ndarray, of_map: _Map) -> np.ndarray:
    """The machine of the ``known`` documents: a weight for each direction of the map, and the bias."""
    words, sentences, documents = sample.words, sample.sentences, sample.documents
    inside = known[documents]
    if not inside.all():
        words, sentences, documents = words[inside], sentences[inside], documents[inside]
    del inside
    margin = np.minimum(of_map.nearest, 1)  # at first, the nearest landmark; all landmarks are as near
    owner = np.zeros(int(sample.sentences.max(initial=0)) + 1, dtype=np.int64)
    owner[sentences] = documents
    for _ in range(ROUNDS):
        # Each sentence's worst word, and each document's sentences from worst to best.
        order = np.lexsort((-margin[words], sentences))
        of = sentences[order]
        lead = order[np.flatnonzero(np.append(True, of[1:] != of[:-1]))] if len(of) else order
        s = sentences[lead]
        by = np.lexsort((-margin[words[lead]], owner[s]))
        of = owner[s][by]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        taken = np.where(y[of] == 1, rank < 2, rank < TRAINED)
        chosen, sign = words[lead][by][taken], np.where(y[of][taken] == 1, 1.0, -1.0)
        weigh = np.where(sign > 0, 1.0 / max(1, (sign > 0).sum()), 1.0 / max(1, (sign < 0).sum())) * len(sign) / 2
        w = _machine(of_map.mapped[of_map.row[chosen]], sign, weigh)
        margin = of_map.margins(w)
    return w


def _folded(of_map: _Map, w: np.ndarray) -> Model:
    """The machine as a model: map and weights make one weight for each subsequence, of which the largest are kept."""
    weights = of_map.table @ (of_map.whiten @ w[:-1])
    kept = np.argsort(-np.abs(weights), kind="stable")[:KEPT]
    folded = np.zeros(1 << 5 * ORDER, dtype=np.float32)
    folded[of_map.used[kept]] = weights[kept]
    return Model(folded, float(w[-1]), np.zeros(0))


def learn(texts: list[str], labels: list[int], share: float | None = None) -> Model:
    """The model of labelled documents, both classes among them; ``share`` is that of label 1 outside the sample.

    The curve from margins to scores is fitted on documents that the machine giving their margins has not seen, each part of
    ``FOLDS`` in turn; landmarks come from all, and the machine of the model sees all.
    """
    letters, y = _letters(), np.array(labels)
    sample = _Sample(texts)
    n = len(y)

    def features(margin: np.ndarray) -> np.ndarray:
        return pooled(margin[sample.words], sample.sentences, sample.documents, n)

    # Documents of each label are dealt out in turn, so every part has its share of both.
    place = np.empty(n, dtype=np.int64)
    for value in (0, 1):
        place[y == value] = np.arange(int((y == value).sum()))
    every = np.ones(n, dtype=bool)
    landmarks = _landmarks(sample, y, every, letters)
    if not landmarks:
        nothing = np.zeros(0, dtype=np.int64)
        return Model(np.zeros(1 << 5 * ORDER, dtype=np.float32), -1.0, _curve(pooled(np.zeros(0), nothing, nothing, n), y, share))
    of_map = _mapped(sample, landmarks, letters)
    model = _folded(of_map, _fitted(sample, y, every, of_map))
    unseen = features(model.word_margins(sample.vocabulary, letters))
    for k in range(FOLDS):
        part = place % FOLDS == k
        if 0 < y[~part].sum() < (~part).sum():
            other = _folded(of_map, _fitted(sample, y, ~part, of_map))
            unseen[part] = features(other.word_margins(sample.vocabulary, letters))[part]
    model.curve = _curve(unseen, y, share)
    return model


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key and ``score``, 0 to 1: how likely its label is 1; whole texts are read.

    Without a model, because a class had no labelled rows, every score is 0. Missing and empty texts have the
    score of a document without words; repeated rows stay; nothing else of a row is looked at.
    """
    schema = T.StructType([docs.schema[key], T.StructField("score", T.DoubleType())])

    def prepare():
        likely = scorer(model)
        return lambda columns: {key: columns[key], "score": likely(columns[text])}

    return map_rows(keyed_texts(docs, key, text), [key, text], schema, prepare)


def below(docs: DataFrame, model: Model | None, limit: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all their columns."""
    def prepare():
        likely = scorer(model)
        return lambda texts: likely(texts) < limit

    return keep_rows(docs, text, prepare)


def scorer(model: Model | None) -> Callable[[Sequence[str]], np.ndarray]:
    """A function from texts to scores that remembers the words it has met."""
    letters = _letters()
    known: dict[str, int] = {}
    margins = np.zeros(0)

    def likely(texts: Sequence[str]) -> np.ndarray:
        nonlocal margins
        if model is None:
            return np.zeros(len(texts))
        if len(known) > REMEMBERED:
            known.clear()
            margins = np.zeros(0)
        words, sentences, counts = _numbered(texts, known)
        if len(known) > len(margins):
            margins = np.append(margins, model.word_margins(list(islice(known, len(margins), None)), letters))
        documents = np.repeat(np.arange(len(counts)), counts)
        features = pooled(margins[_joined(words)], _joined(sentences), documents, len(counts))
        return 1 / (1 + np.exp(-np.clip(features @ model.curve, -30, 30)))

    return likely
