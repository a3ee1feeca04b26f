"""BPE encoding and decoding in batched numpy merge rounds.

The distinct words of a batch lie as symbols in one flat array. Every round finds the rank of each
adjacent pair by binary search over the sorted pair keys, takes the lowest rank of each word and
merges all its places at once; only pairs beside a merge are looked up again. Words are remembered
within a task, so a frequent word is merged once.

Handled files: BPE with an end-of-word suffix over byte-level symbols, text normalised by NFC and
lower-casing, words cut by the contraction, letter, digit and other-symbol rule, special tokens
taken out of the raw text. Merges are applied in rank order, as such files are trained.

Cases: null text counts as empty (no tokens, empty decoded text); empty texts and texts of white
space have no tokens; repeated rows are encoded alike; an empty table gives an empty result; carried
columns named like a result are left out; a text of any length is encoded whole. Every code point is
lower-cased and classed as by the library; compositions that are newer than the running
Python's own tables are left apart.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import carry_map

#: Words remembered by a task; when more are known, the memory starts anew. Results are the same.
REMEMBERED_WORDS = 1 << 17
NO_RANK = np.iinfo(np.int32).max
#: Words merged at once, so that the arrays of a round stay small.
WORDS_AT_ONCE = 8192

# Fixed value: the word rule of the tokenizer file.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The library lower-cases by Unicode 17.0 and classes by Unicode 16.0. Capitals that came
# with 16.0 and 17.0, and what they become in lower case; Python's own tables may be older.
NEW_CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
# Code points that version 16.0 leaves unassigned, so that they are neither letters nor
# digits, and that newer tables, as those behind the word rule, may class as such.
AFTER_16 = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 "
    "187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 "
    "1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
AFTER = "".join(
    f"\\U{int(r.split('-')[0], 16):08X}-\\U{int(r.split('-')[-1], 16):08X}" for r in AFTER_16.split()
)
#: The word rule with those code points taken out of its letters and digits.
RULE_OF_16 = (
    WORD_RULE.split("|[", 1)[0]
    + rf"|(?:(?![{AFTER}])\p{{L}})+|(?![{AFTER}])\p{{N}}|(?:[^\s\p{{L}}\p{{N}}]|[{AFTER}])+"
)

RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("decoded", T.StringType()),
    ]
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def load_model(path: str) -> dict:
    """Plain arrays of a tokenizer file: pair keys in order, their ranks and merged ids, symbols."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model = file["model"]
    suffix = model.get("end_of_word_suffix")
    if model["type"] != "BPE" or not suffix or file.get("decoder"):
        raise ValueError(f"{path}: not a byte-level BPE file with an end-of-word suffix")
    vocab: dict[str, int] = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
    order = np.argsort(key, kind="stable")
    merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    names = {i: t for t, i in (vocab | special).items()}
    symbols = byte_symbols()
    return {
        "key": key[order],
        "rank": order.astype(np.int32),
        "merged": merged[order],
        "inner": np.array([vocab[s] for s in symbols], np.int64),
        "final": np.array([vocab[s + suffix] for s in symbols], np.int64),
        "names": [names.get(i, "").encode() + b" " for i in range(max(names) + 1)],
        "special": special,
    }


def merge_words(words: list[bytes], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words (none is empty) in one array, and where each word ends in it."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    symbol = model["inner"][flat]
    symbol[ends - 1] = model["final"][flat[ends - 1]]
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    keys, ranks, merged = model["key"], model["rank"], model["merged"]
    done: list[tuple[np.ndarray, np.ndarray]] = []

    # A pair stands at its left symbol: its rank, and the symbol it merges into.
    rank = np.full(len(symbol), NO_RANK, np.int32)
    into = np.zeros(len(symbol), np.int64)
    stale = np.flatnonzero(word[1:] == word[:-1])
    while True:
        pair = symbol[stale] << 32 | symbol[stale + 1]
        at = np.searchsorted(keys, pair)
        at[at == len(keys)] = 0
        rank[stale] = np.where(keys[at] == pair, ranks[at], NO_RANK)
        into[stale] = merged[at]

        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(starts, append=len(word))
        lowest_here = np.repeat(lowest, sizes)
        active = lowest_here < NO_RANK
        if not active.all():
            done.append((word[~active], symbol[~active]))
            if not active.any():
                break
            word, symbol, rank, into = word[active], symbol[active], rank[active], into[active]
            lowest_here = lowest_here[active]
        left = np.flatnonzero(rank == lowest_here)
        # Of overlapping places (a a a) every second one, from the left.
        run = np.diff(left, prepend=-2) != 1
        if not run.all():
            place = np.arange(len(left))
            left = left[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
        symbol[left] = into[left]
        keep = np.ones(len(symbol), bool)
        keep[left + 1] = False
        rank[left] = NO_RANK
        word, symbol, rank, into = word[keep], symbol[keep], rank[keep], into[keep]
        left -= np.arange(len(left))
        # New pairs: the merged symbol with the next one, and the one before with it.
        stale = np.concatenate([left, left[left > 0] - 1])
        stale = stale[stale < len(word) - 1]
        outside = word[stale] != word[stale + 1]
        rank[stale[outside]] = NO_RANK
        stale = stale[~outside]
    word = np.concatenate([w for w, _ in done])
    symbol = np.concatenate([s for _, s in done])
    order = np.argsort(word, kind="stable")
    return symbol[order].astype("<u4"), np.cumsum(np.bincount(word, minlength=len(words)))


class Encoder:
    """Encodes texts with a loaded model and remembers words between calls."""

    def __init__(self, model: dict):
        self.model = model
        self.rule, self.rule_of_16 = regex.compile(WORD_RULE), regex.compile(RULE_OF_16)
        self.newer = regex.compile(f"[{AFTER}{''.join(map(chr, NEW_CAPITALS))}]")
        special = sorted(model["special"], key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text; special tokens are kept as single items with a leading NUL mark."""
        if self.special is None or not (found := self.special.search(text)):
            return self._plain(text)
        out, at = [], 0
        while found:
            out += self._plain(text[at : found.start()])
            out.append("\0" + found.group())
            at = found.end()
            found = self.special.search(text, at)
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # Lower-casing goes character by character: a final sigma is like any other.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self.newer.search(text):
                return self.rule_of_16.findall(text.translate(NEW_CAPITALS).lower())
        return self.rule.findall(text.lower())

    def learn(self, words: set[str]) -> None:
        names = self.model["names"]
        fresh = []
        for w in words:
            token = self.model["special"].get(w[1:]) if w[0] == "\0" else None
            if token is None:
                fresh.append(w)
            else:
                self.known[w] = (np.array([token], "<u4").tobytes(), names[token])
        for first in range(0, len(fresh), WORDS_AT_ONCE):
            some = fresh[first : first + WORDS_AT_ONCE]
            ids, ends = merge_words([w.encode() for w in some], self.model)
            packed, shown, start = ids.tobytes(), [names[i] for i in ids.tolist()], 0
            for w, end in zip(some, ends.tolist()):
                self.known[w] = (packed[4 * start : 4 * end], b"".join(shown[start:end]))
                start = end

    def encode(self, texts: list[str | None]) -> tuple[list[int], list[bytes], list[bytes]]:
        """Counts, ids as packed little-endian 32-bit integers, decoded texts as UTF-8."""
        per_text = [self.words(t) if t else [] for t in texts]
        wanted = set(chain.from_iterable(per_text))
        if len(self.known) + len(wanted) > REMEMBERED_WORDS:
            self.known.clear()
        self.learn(wanted - self.known.keys())
        known = self.known
        ids, decoded = [], []
        for words in per_text:
            pairs = [known[w] for w in words]
            ids.append(b"".join([p[0] for p in pairs]))
            decoded.append(b"".join([p[1] for p in pairs])[:-1])
        return [len(i) // 4 for i in ids], ids, decoded


def encode_decode(
    docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """`n_tokens`, `ids` (packed little-endian 32-bit integers) and `decoded` beside `carry`."""
    model = docs.sparkSession.sparkContext.broadcast(load_model(path))

    def start():
        encoder = Encoder(model.value)

        def step(part: pa.RecordBatch) -> list:
            counts, ids, decoded = encoder.encode(part.column(0).to_pylist())
            return [counts, ids, pa.array(decoded, pa.binary()).cast(pa.string())]

        return step

    carry = [c for c in docs.columns if c != text] if carry is None else carry
    return carry_map(docs, start, {"__text": F.col(f"`{text}`")}, RESULT, carry, "__text")
