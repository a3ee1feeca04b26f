"""Licence scan: exact phrases, and short notices with a bounded number of edits.

A notice may differ in one character per ten. It is cut into one piece more than its allowed edits,
so any place within the bound holds some piece unchanged. One automaton finds all pieces, each hit
names a window of the text, and the bounded-error match of the regex library checks only windows.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z; notices are compared with the
words joined by single spaces, and a match starts and ends at word boundaries.

Cases: null text counts as empty (no words, no labels, score 0); places may overlap and all count;
repeated rows are scanned alike; an empty table gives an empty result; carried columns named like a
result are left out; a text of any length is scanned whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import as_bytes, carry_map

# The phrases that count as base places, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short notices of well-known licences, and their labels.
NOTICES = {
    **BASE_PHRASES,
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "free and unencumbered software released into the public domain": "unlicense",
}
CHARS_PER_EDIT = 10

SPAN = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("start_word", T.LongType()),
        T.StructField("end_word", T.LongType()),
        T.StructField("edits", T.IntegerType()),
    ]
)
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)

#: A-Z to a-z; ASCII that is no letter or digit to a space; all other bytes as they are.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
    for b in range(256)
)


class Notice:
    """A notice with its allowed edits, its exact pieces and its bounded-error pattern."""

    def __init__(self, phrase: str, label: str, chars_per_edit: int):
        self.phrase, self.label = phrase, label
        self.edits = len(phrase) // chars_per_edit
        cuts = [len(phrase) * i // (self.edits + 1) for i in range(self.edits + 2)]
        self.pieces = [(phrase[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.pattern = regex.compile(
            rf"(?e)(?<![^ ])(?:{regex.escape(phrase)}){{e<={self.edits}}}(?![^ ])"
        )


class Scanner:
    def __init__(self, base: dict[str, str], notices: dict[str, str], chars_per_edit: int):
        self.base = [(f" {p} ".encode(), label) for p, label in base.items()]
        self.notices = [Notice(p, label, chars_per_edit) for p, label in notices.items()]
        users: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for piece, offset in notice.pieces:
                users.setdefault(piece, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in users.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()

    def base_places(self, padded: bytes) -> list[tuple[int, str]]:
        """Start word and label of every base place; `padded` has a space at both ends."""
        places = []
        for phrase, label in self.base:
            at, seen, word = padded.find(phrase), 0, 0
            while at >= 0:
                word += padded.count(b" ", seen, at)
                seen = at
                places.append((word, label))
                at = padded.find(phrase, at + 1)
        return places

    def windows(self, text: str) -> Iterator[tuple[Notice, int, int]]:
        """Per notice the merged stretches, cut at spaces, that some piece points to."""
        found: dict[int, list[tuple[int, int]]] = {}
        for end, (size, uses) in self.seeds.iter(text):
            for i, offset in uses:
                notice = self.notices[i]
                start = end + 1 - size - offset
                low = max(0, start - notice.edits)
                high = min(len(text), start + len(notice.phrase) + notice.edits)
                spans = found.setdefault(i, [])
                if spans and low <= spans[-1][1]:
                    spans[-1] = (min(low, spans[-1][0]), max(high, spans[-1][1]))
                else:
                    spans.append((low, high))
        for i, spans in found.items():
            done = -1
            for low, high in spans:
                low = max(text.rfind(" ", 0, low + 1) + 1, done)
                high = text.find(" ", high)
                high = len(text) if high < 0 else high
                if high > low:
                    yield self.notices[i], low, high
                done = high

    def spans(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """Label, start word, end word (behind the last), edits and similarity of each match."""
        out = []
        for notice, low, high in self.windows(text):
            for m in notice.pattern.finditer(text[low:high]):
                edits = sum(m.fuzzy_counts)
                first = text.count(" ", 0, low + m.start())
                out.append(
                    (notice.label, first, first + m.group().count(" ") + 1, edits,
                     1.0 - edits / len(notice.phrase))
                )
        return sorted(out, key=lambda s: (s[1], s[2], s[0], s[3]))

    def scan(self, raw: bytes) -> tuple:
        words = raw.translate(WORD_BYTES).split()
        joined = b" ".join(words)
        places = self.base_places(b" " + joined + b" ")
        spans = self.spans(joined.decode("utf-8", "replace"))
        base = {label for _, label in places}
        labels = base | {s[0] for s in spans}
        return (
            len(words),
            len(places),
            min((w for w, _ in places), default=None),
            max((w for w, _ in places), default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            1.0 if places else max((s[4] for s in spans), default=0.0),
            [dict(zip(SPAN.names, s)) for s in spans],
        )


def license_scan(
    docs: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    base: dict[str, str] = BASE_PHRASES,
    notices: dict[str, str] = NOTICES,
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """Counts, labels, score and `spans` (of the notices) beside `carry`."""

    def start():
        scanner = Scanner(base, notices, chars_per_edit)

        def step(part: pa.RecordBatch) -> list:
            return [*map(list, zip(*map(scanner.scan, as_bytes(part.column(0)))))]

        return step

    carry = [c for c in docs.columns if c != text] if carry is None else carry
    return carry_map(docs, start, {"__text": F.col(f"`{text}`")}, RESULT, carry, "__text")
