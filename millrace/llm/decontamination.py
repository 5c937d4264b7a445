"""Passages of benchmark items in documents, a bounded number of edits included.

An item may differ in ``errors`` characters, a share of its length. Cut into ``errors + 1`` pieces, one of them
at least stands unchanged in every such passage: an automaton of all pieces finds the hits in one
pass over a document, and Myers' bit-parallel distance, which keeps a column of the edit
matrix in the bits of two numbers, decides on the stretch around each hit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from millrace.llm.texts import keep_rows, keyed_texts, map_rows
from millrace.session import materialize

# Edits allowed per character of an item.
RATE = 0.06
# Characters of items that one pass over the documents looks for; more items take more passes.
PASS_CHARACTERS = 4 << 20
# Word characters; all other characters separate words.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain(text: str) -> str:
    """Lower case, words divided by single blanks, a blank at both ends."""
    table = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256))
    words = text.lower().encode("utf-8", "surrogatepass").translate(table).split()
    return f" {b' '.join(words).decode('utf-8', 'surrogatepass')} " if words else ""


@dataclass(frozen=True)
class Item:
    key: object
    text: str
    errors: int

    def parts(self) -> Iterator[tuple[int, str]]:
        """Pieces of nearly equal length and where they begin."""
        n = self.errors + 1
        cuts = [i * len(self.text) // n for i in range(n + 1)]
        return ((a, self.text[a:b]) for a, b in zip(cuts, cuts[1:]))


def nearest(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """``(edits, end)`` of the passage of ``text`` nearest to ``pattern``, the earliest end of equal
    ones; nothing if it takes more than ``most`` edits."""
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    every, last = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    up, down, score = every, 0, len(pattern)
    best, best_end = most + 1, 0
    for end, c in enumerate(text, 1):
        same = equal.get(c, 0)
        level = same | down
        across = (((same & up) + up) ^ up) | same
        more, less = down | ~(across | up) & every, up & across
        if more & last:
            score += 1
        elif less & last:
            score -= 1
        more, less = more << 1 & every, less << 1 & every
        up, down = less | ~(level | more) & every, more & level
        if score < best:
            best, best_end = score, end
    return (best, best_end) if best <= most else None


def best_passage(item: Item, text: str, hits: list[int]) -> tuple[int, int, int] | None:
    """``(edits, start, end)`` of the item's nearest passage around the places where it may begin."""
    stretches: list[list[int]] = []
    for begin in sorted(hits):
        low = max(0, begin - item.errors)
        high = min(len(text), begin + len(item.text) + item.errors)
        if stretches and low <= stretches[-1][1]:
            stretches[-1][1] = max(high, stretches[-1][1])
        else:
            stretches.append([low, high])
    best = None
    for low, high in stretches:
        found = nearest(item.text, text[low:high], item.errors if best is None else best[0] - 1)
        if found:
            edits, end = found[0], low + found[1]
            # Backwards from its end, the passage is the shortest of as many edits.
            length = nearest(item.text[::-1], text[low:end][::-1], edits)[1]
            best = (edits, end - length, end)
            if not edits:
                break
    return best


def searcher(items: list[Item]) -> Callable[[str], Iterator[tuple[Item, tuple[int, int, int]]]]:
    """A function that finds, in a text made ``plain``, the items it holds and their nearest passages."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    pieces: dict[str, list[tuple[int, int]]] = {}
    for k, item in enumerate(items):
        for offset, part in item.parts():
            pieces.setdefault(part, []).append((k, offset + len(part) - 1))
    for part, of in pieces.items():
        automaton.add_word(part, of)
    automaton.make_automaton()

    def search(words: str) -> Iterator[tuple[Item, tuple[int, int, int]]]:
        hits: dict[int, set[int]] = {}
        for last, of in automaton.iter(words):
            for k, offset in of:
                hits.setdefault(k, set()).add(last - offset)
        for k in sorted(hits):
            best = best_passage(items[k], words, list(hits[k]))
            if best:
                yield items[k], best

    return search


def _pass(docs: DataFrame, items: list[Item], key: str, text: str, schema: T.StructType) -> DataFrame:
    item_key = schema.fieldNames()[1]

    def prepare():
        import re

        search = searcher(items)

        def found(columns: dict[str, list]) -> dict[str, list]:
            rows: dict[str, list] = {name: [] for name in schema.fieldNames()}
            for name, body in zip(columns[key], columns[text]):
                words, spans = plain(body), None
                for item, (edits, start, end) in search(words):
                    spans = spans or [m.span() for m in re.finditer(_WORD, body)]
                    # The words that the passage touches, blanks at its ends left out.
                    last = words.count(" ", 0, end - (words[end - 1] == " ")) - 1
                    first = min(words.count(" ", 0, start + 1) - 1, last)
                    rows[key].append(name)
                    rows[item_key].append(item.key)
                    rows["edits"].append(edits)
                    rows["likeness"].append(1.0 - edits / len(item.text))
                    rows["start"].append(spans[first][0])
                    rows["end"].append(spans[last][1])
            return rows

        return found

    return map_rows(docs, [key, text], schema, prepare)


def _passes(items: DataFrame, item_key: str, item_text: str, rate: float, characters: int) -> Iterator[tuple[list[Item], bool]]:
    """The items in portions of about ``characters``, and whether there are several."""
    searched = items.select(F.col(item_key).alias("key"), F.coalesce(F.col(item_text), F.lit("")).alias("body"))
    total = searched.agg(F.sum(F.length("body"))).first()[0] or 0
    passes = max(1, math.ceil(total / characters))
    for number in range(passes):
        chosen = []
        for row in searched.where(F.pmod(F.xxhash64("body"), F.lit(passes)) == number).toLocalIterator():
            words = plain(row["body"])
            if words:
                chosen.append(Item(row["key"], words, int(rate * len(words))))
        if chosen:
            yield chosen, passes > 1


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text", rate: float = RATE,
          pass_characters: int = PASS_CHARACTERS) -> DataFrame:
    """One row per document and item it holds: both keys, ``edits``, ``likeness`` (one less the share of
    edits), ``start`` and ``end`` of the words touched, in the text's code points.

    Case, punctuation and white space do not count. The passage with the fewest edits is reported, the
    earliest of equal ones; whole documents are searched. Missing and empty texts hold nothing, items without words are
    in no document, repeated rows on either side are compared each. Items come to the tasks in
    passes of at most ``pass_characters``, one longer item aside, so a large benchmark costs passes, not memory.
    """
    own = keyed_texts(docs, key, text)
    if item_key in (key, "edits", "likeness", "start", "end"):
        raise ValueError(f"{item_key} cannot name the items")
    schema = T.StructType([
        docs.schema[key], items.schema[item_key], T.StructField("edits", T.LongType()),
        T.StructField("likeness", T.DoubleType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType())])
    results = []
    for chosen, several in _passes(items, item_key, item_text, rate, pass_characters):
        found = _pass(own, chosen, key, text, schema)
        # One pass's items leave the driver before the next one's arrive.
        results.append(materialize(found, "leaks") if several else found)
    if not results:
        return own.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, results)


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", rate: float = RATE, pass_characters: int = PASS_CHARACTERS) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; what counts is as in ``leaks``."""
    left = docs
    for chosen, several in _passes(items, item_key, item_text, rate, pass_characters):
        left = _without(left, chosen, text)
        left = materialize(left, "without-leaks") if several else left
    return left


def _without(docs: DataFrame, items: list[Item], text: str) -> DataFrame:
    def prepare():
        search = searcher(items)
        return lambda texts: [next(search(plain(body)), None) is None for body in texts]

    return keep_rows(docs, text, prepare)
