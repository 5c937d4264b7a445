"""License scan: exact phrases of words, and short notices with bounded errors.

The text becomes words (``WORD``), lower-cased in A-Z. A notice of ``n`` characters may be
misspelt in ``n // CHARACTERS_PER_ERROR`` places. It is split into one piece more than that, so that at least
one piece stands unharmed in every such misspelling: an automaton of all pieces finds these seeds
in one pass, and the ``regex`` library's bounded-error matching decides on the short stretch around
each seed and reports what matched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.texts import keyed_texts, map_rows

# Word class, phrases and their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices looked for with errors, each with a label of its own.
NOTICES = (
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person", "mit-text"),
    ("licensed under the apache license version 2 0", "apache-notice"),
    ("licensed under the gnu general public license version", "gnu-gpl-notice"),
    ("gnu lesser general public license", "gnu-lgpl-notice"),
    ("licensed under cc by nc 4 0", "cc-by-nc-notice"),
    ("creative commons attribution", "cc-attribution"),
    ("mozilla public license version 2 0", "mpl-notice"),
    ("redistribution and use in source and binary forms", "bsd-text"),
    ("this is free and unencumbered software", "unlicense-text"),
    ("spdx license identifier", "spdx-tag"),
)
# One error is allowed for so many characters of a notice.
CHARACTERS_PER_ERROR = 9

FINDING = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("exact", T.BooleanType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("edits", T.LongType()), T.StructField("score", T.DoubleType()),
])


@dataclass(frozen=True)
class Notice:
    """A notice, the errors it may have, and its pieces with their places in it."""

    text: str
    label: str
    errors: int
    parts: tuple[tuple[int, str], ...]


def split_notice(text: str, label: str, per_error: int = CHARACTERS_PER_ERROR) -> Notice:
    errors = len(text) // per_error
    cuts = [round(i * len(text) / (errors + 1)) for i in range(errors + 2)]
    return Notice(text, label, errors, tuple(
        (a, text[a:b]) for a, b in zip(cuts, cuts[1:])))


def fuzzy_matches(words: str, notices: Sequence[Notice], automaton, patterns) -> Iterator[tuple]:
    """``(notice, start, end, edits)`` in ``words``: all places within a notice's errors that touch
    no earlier place of the same notice."""
    stretches: dict[int, list[list[int]]] = {}
    for last, seeds in automaton.iter(words):
        for k, offset, length in seeds:
            notice = notices[k]
            begin = last - length + 1 - offset
            low = max(0, begin - notice.errors)
            high = min(len(words), begin + len(notice.text) + notice.errors)
            of = stretches.setdefault(k, [])
            # Seeds come by their ends, so stretches may begin a little out of order.
            if of and low <= of[-1][1]:
                of[-1][0], of[-1][1] = min(low, of[-1][0]), max(high, of[-1][1])
            else:
                of.append([low, high])
    for k, of in sorted(stretches.items()):
        done = 0
        for low, high in of:
            for match in patterns[k].finditer(words, max(low, done), high):
                done = match.end()
                yield notices[k], match.start(), match.end(), sum(match.fuzzy_counts)


def exact_places(words: str, phrase: str) -> Iterator[int]:
    """Where the phrase's words stand consecutively; ``words`` begins and ends with a blank."""
    wanted, at = f" {phrase} ", -1
    while (at := words.find(wanted, at + 1)) >= 0:
        yield at


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text",
         phrases: Sequence[tuple[str, str]] = PHRASES,
         notices: Sequence[tuple[str, str]] = NOTICES,
         per_error: int = CHARACTERS_PER_ERROR) -> DataFrame:
    """Per row its key, ``n_words`` and ``findings``, sorted by word, label and exactness.

    A finding has its label, whether it is a phrase (``exact``) or a notice, its first and last
    word, its span in the text's code points (``start`` up to but without ``end``), the number of
    edits and a score of one less the share of edited characters. A phrase is found at all its
    places. Missing and empty texts have no words and no findings; repeated rows are scanned
    each; other columns are not returned. A text is scanned whole, in the task that holds it.
    """
    split = [split_notice(body, label, per_error) for body, label in notices]
    schema = T.StructType([docs.schema[key], T.StructField("n_words", T.LongType()),
                           T.StructField("findings", T.ArrayType(FINDING))])

    def prepare():
        import ahocorasick
        import re

        import regex

        # Everything but the word class turns into blanks; bytes of other alphabets stay.
        blanks = bytes(b if re.fullmatch(WORD, chr(b)) or b > 0x7F else 0x20 for b in range(256))
        automaton = ahocorasick.Automaton()
        seeds: dict[str, list] = {}
        for k, notice in enumerate(split):
            for offset, part in notice.parts:
                seeds.setdefault(part, []).append((k, offset, len(part)))
        for part, of in seeds.items():
            automaton.add_word(part, of)
        if seeds:
            automaton.make_automaton()
        patterns = [regex.compile(f"(?e)(?:{regex.escape(n.text)}){{e<={n.errors}}}") for n in split]

        def scanned(columns: dict[str, list]) -> dict[str, list]:
            counts, findings = [], []
            for body in columns[text]:
                plain = body.encode("utf-8", "surrogatepass").lower().translate(blanks)
                words = plain.split()
                joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
                places = [(at, at + len(phrase) + 2, label, True, 0, 1.0)
                          for phrase, label in phrases for at in exact_places(joined, phrase)]
                if seeds:
                    places += [(start, end, notice.label, False, edits, 1.0 - edits / len(notice.text))
                               for notice, start, end, edits in
                               fuzzy_matches(joined, split, automaton, patterns)]
                found = []
                if places:
                    spans = [m.span() for m in re.finditer(WORD, re.sub(
                        "[A-Z]+", lambda m: m.group().lower(), body))]
                    # Blanks before a place count its words; places come in order, so one pass is enough.
                    seen = at = 0
                    for start, end, label, exact, edits, score in sorted(places):
                        head = start + (len(joined[start:end]) - len(joined[start:end].lstrip(" ")))
                        tail = start + len(joined[start:end].rstrip(" "))
                        seen, at = seen + joined.count(" ", at, head), head
                        first = seen - 1
                        last = first + joined.count(" ", head, tail)
                        found.append((first, last, label, exact, spans[first][0], spans[last][1],
                                      edits, score))
                counts.append(len(words))
                findings.append([dict(zip(("first_word", "last_word", "label", "exact", "start", "end",
                                           "edits", "score"), row)) for row in
                                 sorted(found, key=lambda row: (row[0], row[2], not row[3]))])
            return {key: columns[key], "n_words": counts, "findings": findings}

        return scanned

    return map_rows(keyed_texts(docs, key, text), [key, text], schema, prepare)
