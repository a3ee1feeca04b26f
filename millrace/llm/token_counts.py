"""Word-piece counts by a linear longest-match automaton.

A trie of the vocabulary gets failure links. A node's link says where matching goes on once the
node cannot be followed, and its popped count says how many pieces have become certain by then.
A word of n bytes takes at most 2n moves and no piece is ever built: only counts are added.
Pieces at the start of a word carry a leading space; all others continue a word.

Cases: null and empty texts have no words and no tokens; a word with a part that no piece matches
counts as one unknown token; repeated rows are counted alike; an empty table gives an empty result;
carried columns named like a result are left out; a text of any length is counted whole.
"""

from __future__ import annotations

import json
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import as_bytes, carry_map
from millrace.llm.bpe import byte_symbols

#: Words remembered by a task; when more are known, the memory starts anew. Results are the same.
REMEMBERED_WORDS = 1 << 20
ROOT = 0
NOWHERE = -1

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_unknown", T.LongType()),
    ]
)


def load_pieces(path: str) -> list[bytes]:
    """The byte strings of a byte-level vocabulary file, without its special tokens."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    special = {t["content"] for t in file.get("added_tokens", [])}
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    return [
        bytes(byte_of[c] for c in piece) for piece in file["model"]["vocab"] if piece not in special
    ]


def build_automaton(vocab: list[bytes]) -> dict:
    """`next` by (node << 8 | byte), and per node its failure link and popped count."""
    follow: dict[int, int] = {}
    is_piece = [False]
    for piece in vocab:
        node = ROOT
        for b in piece:
            step = node << 8 | b
            if step not in follow:
                follow[step] = len(is_piece)
                is_piece.append(False)
            node = follow[step]
        is_piece[node] = node != ROOT
    children: dict[int, list[tuple[int, int]]] = {}
    for step, node in follow.items():
        children.setdefault(step >> 8, []).append((step & 255, node))
    link = [NOWHERE] * len(is_piece)
    popped = [0] * len(is_piece)
    queue = deque([ROOT])
    while queue:
        parent = queue.popleft()
        for b, node in children.get(parent, ()):
            queue.append(node)
            if is_piece[node]:
                link[node], popped[node] = ROOT, 1
                continue
            at, count = link[parent], popped[parent]
            while at != NOWHERE and at << 8 | b not in follow:
                count += popped[at]
                at = link[at]
            if at != NOWHERE:
                link[node], popped[node] = follow[at << 8 | b], count
    return {"next": follow, "link": link, "popped": popped}


def count_pieces(word: bytes, automaton: dict) -> int:
    """Pieces of a word under greedy longest match; 0 when some part matches no piece."""
    follow, link, popped = automaton["next"], automaton["link"], automaton["popped"]
    node, count = ROOT, 0
    for b in word:
        while (step := follow.get(node << 8 | b)) is None:
            count += popped[node]
            node = link[node]
            if node == NOWHERE:
                return 0
        node = step
    while node != ROOT:
        count += popped[node]
        node = link[node]
        if node == NOWHERE:
            return 0
    return count


class WordCounts(dict):
    """Counts of words, worked out when first asked for."""

    def __init__(self, automaton: dict):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        count = self[word] = count_pieces(b" " + word, self.automaton)
        return count


def token_counts(
    docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """`n_words`, `n_tokens` and `n_unknown` beside `carry`; words are `[^\\x20\\x09-\\x0D]+`."""
    automaton = docs.sparkSession.sparkContext.broadcast(build_automaton(load_pieces(path)))

    def start():
        pieces_of = WordCounts(automaton.value)

        def step(part: pa.RecordBatch) -> list:
            words, tokens, unknown = [], [], []
            for raw in as_bytes(part.column(0)):
                counts = [*map(pieces_of.__getitem__, raw.split())]
                missing = counts.count(0)
                words.append(len(counts))
                tokens.append(sum(counts) + missing)
                unknown.append(missing)
            return [words, tokens, unknown]

        return step

    carry = [c for c in docs.columns if c != text] if carry is None else carry
    return carry_map(docs, start, {"__text": F.col(f"`{text}`")}, RESULT, carry, "__text")
