"""Language identification with error-correcting output codes.

Each language has a codeword. For every bit a binary classifier over hashed byte n-grams tells the
languages with a set bit from the others; its weights are log ratios of n-gram counts, which Spark
adds up over all training rows. A second pass measures how large each classifier's outputs are and
how often they are right. A text's language is the codeword with the least loss, bits weighted by
how reliable they are; the text is ambiguous when the second codeword's loss is nearly as small.

Up to seven languages get the exhaustive code (all two-part splits); more get random splits whose
number grows with the logarithm of the number of languages. What the driver holds is the model:
one row of counts per language, of fixed width.

Cases: null texts and texts without a letter are `und` with score 0; a text too short for any
n-gram gets the first language and is ambiguous; rows with a null language or id teach nothing; with
one language all texts with letters get it; with none, they are `und`; repeated rows are judged
alike; an empty table gives an empty result; carried columns named like a result are left out; a
text of any length is read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import as_bytes, carry_map, pieces, released

UNKNOWN = "und"
#: Hash slots per n-gram order, and the orders in bytes.
SLOT_BITS = 14
SLOTS = 1 << SLOT_BITS
ORDERS = (2, 3)
WIDTH = SLOTS * len(ORDERS)
#: Slots per message while counts are added up.
BLOCK = 2048
#: Added to every count.
SMOOTHING = 0.5
EXHAUSTIVE_UP_TO = 7
#: A second codeword whose loss is within this share of the first makes a text ambiguous.
AMBIGUITY = 0.05

RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def codewords(n: int, seed: int = 1) -> np.ndarray:
    """A row of +1 and -1 for each of n languages; rows differ in many places."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= EXHAUSTIVE_UP_TO:
        columns = [[1 if i == 0 or m >> (i - 1) & 1 else -1 for i in range(n)]
                   for m in range(2 ** (n - 1) - 1)]
        return np.array(columns, float).T
    bits, best, best_distance = math.ceil(10 * math.log2(n)), None, -1
    rng = np.random.default_rng(seed)
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code[:, np.abs(code.sum(0)) == n] = np.where(np.arange(n) % 2, 1.0, -1.0)[:, None]
        distance = min(((code[i] != code[i + 1 :]).sum(1).min() for i in range(n - 1)))
        if distance > best_distance:
            best, best_distance = code, distance
    return best


def gram_slots(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all n-grams (one row per order), start of each text, number of its n-grams.

    An n-gram that would reach over the end of its text has slot WIDTH, which weighs nothing.
    """
    reach = max(ORDERS)
    sizes = np.fromiter(map(len, raws), np.int64, len(raws)) + reach
    starts = np.cumsum(sizes) - sizes
    gap = b"\0" * reach
    data = np.frombuffer((gap.join(raws) + gap).translate(LOWER), np.uint8).astype(np.uint32)
    padded = np.concatenate([data, np.zeros(reach, np.uint32)])
    left = np.repeat(starts + sizes - reach, sizes) - np.arange(len(data))
    slots = np.empty((len(ORDERS), len(data)), np.uint32)
    code = np.zeros(len(data), np.uint32)
    for k in range(reach):
        code = code << np.uint32(8) | padded[k : k + len(data)]
        if k + 1 in ORDERS:
            row = ORDERS.index(k + 1)
            hashed = (code + np.uint32((k + 1) << 24)) * np.uint32(2654435761)
            slots[row] = (hashed >> np.uint32(32 - SLOT_BITS)) + np.uint32(row * SLOTS)
            slots[row][left < k + 1] = WIDTH
    counts = sum(np.maximum(sizes - reach - n + 1, 0) for n in ORDERS)
    return slots, starts, counts


def language_counts(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """n-gram counts per language (one row each) over all rows with `__lang` and `__text`."""
    place = {name: i for i, name in enumerate(languages)}

    def count(batches):
        held = np.zeros((len(place), WIDTH + 1), np.int64)
        for batch in batches:
            for part in pieces(batch, "__text"):
                slots, starts, _ = gram_slots(as_bytes(part.column(1)))
                kind = np.array([place[x] for x in part.column(0).to_pylist()])
                kinds = np.repeat(kind, np.diff(starts, append=slots.shape[1]))
                for row in slots:
                    held += np.bincount(
                        kinds * (WIDTH + 1) + row, minlength=held.size
                    ).reshape(held.shape)
        flat = held[:, :WIDTH].reshape(-1, BLOCK)
        full = np.flatnonzero(flat.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int64()), pa.array([flat[i].tobytes() for i in full], pa.binary())],
            names=["block", "counts"],
        )

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, packed in zip(*(c.to_pylist() for c in batch.columns)):
                some = np.frombuffer(packed, np.int64)
                total[block] = total[block] + some if block in total else some
        yield pa.RecordBatch.from_arrays(
            [pa.array([*total], pa.int64()),
             pa.array([a.tobytes() for a in total.values()], pa.binary())],
            names=["block", "counts"],
        )

    shape = "block long, counts binary"
    found = rows.select("__lang", "__text").mapInArrow(released(count), shape)
    added = found.repartition("block").mapInArrow(released(add), shape)
    counts = np.zeros((len(languages) * WIDTH // BLOCK, BLOCK), np.int64)
    for block, packed in added.collect():  # the model: languages x WIDTH numbers
        counts[block] = np.frombuffer(packed, np.int64)
    return counts.reshape(len(languages), WIDTH)


def outputs(raws: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Mean log ratio per n-gram for each text (row) and bit (column)."""
    slots, starts, counts = gram_slots(raws)
    out = np.zeros((len(raws), len(weights)))
    for b, w in enumerate(weights):
        for row in slots:
            out[:, b] += np.add.reduceat(w[row], starts)
    return out / np.maximum(counts, 1)[:, None]


def bit_weights(counts: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A row per bit: log ratio of each slot's share on either side; a last slot that is 0."""
    weights = np.zeros((code.shape[1], WIDTH + 1))
    for b, side in enumerate(code.T):
        sides = [counts[side == s].sum(0) + SMOOTHING for s in (1, -1)]
        weights[b, :WIDTH] = np.log(sides[0] / sides[0].sum()) - np.log(sides[1] / sides[1].sum())
    return weights


def calibration(
    rows: DataFrame, languages: list[str], code: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Mean size of each bit's outputs and its share of wrong signs, over all training rows."""
    place = {name: i for i, name in enumerate(languages)}
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def measure(batches):
        size, wrong, n = np.zeros(code.shape[1]), np.zeros(code.shape[1]), 0
        for batch in batches:
            for part in pieces(batch, "__text"):
                out = outputs(as_bytes(part.column(1)), sent.value)
                truth = code[[place[x] for x in part.column(0).to_pylist()]]
                size += np.abs(out).sum(0)
                wrong += (out * truth <= 0).sum(0)
                n += len(out)
        bits = range(code.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(bits, pa.int64()), pa.array(size), pa.array(wrong),
             pa.array([n] * len(bits), pa.int64())],
            names=["bit", "size", "wrong", "n"],
        )

    found = rows.select("__lang", "__text").mapInArrow(
        released(measure), "bit long, size double, wrong double, n long"
    )
    sums = found.groupBy("bit").agg(*[F.sum(c).alias(c) for c in ("size", "wrong", "n")])
    size, error = np.ones(code.shape[1]), np.full(code.shape[1], 0.5)
    for r in sums.collect():  # one row per bit
        size[r["bit"]] = max(r["size"] / max(r["n"], 1), 1e-9)
        error[r["bit"]] = (r["wrong"] + 1) / (r["n"] + 2)
    return size, error


def fit(labelled: DataFrame, text: str, lang: str) -> dict:
    """A model from all rows with a language; plain arrays."""
    rows = labelled.filter(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{lang}`").cast("string").alias("__lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"),
    )
    languages = sorted(r[0] for r in rows.select("__lang").distinct().collect())
    code = codewords(len(languages))
    model = {"languages": languages, "code": code}
    if code.shape[1]:
        weights = bit_weights(language_counts(rows, languages), code)
        size, error = calibration(rows, languages, code, weights)
        model |= {
            "weights": weights / size[:, None],
            "trust": np.maximum(np.log((1 - error) / error), 0.01),
        }
    return model


def decode(out: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword of each row of bit outputs, its share among all, and ambiguity.

    The loss of a codeword is the trust-weighted logistic loss of its bits against the outputs.
    """
    trust = model["trust"] / model["trust"].sum()
    loss = np.stack(
        [np.logaddexp(0, -2 * out * word) @ trust for word in model["code"]], axis=1
    )
    order = np.argsort(loss, axis=1, kind="stable")
    rows = np.arange(len(out))
    first, second = loss[rows, order[:, 0]], loss[rows, order[:, 1]]
    share = np.exp(-(loss - first[:, None]) * model["code"].shape[1])
    return order[:, 0], 1 / share.sum(1), second - first <= AMBIGUITY * first


def identify(
    docs: DataFrame, model: dict, text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """`lang_pred`, `score` and `ambiguous` beside `carry`; only the text is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = sent.value
        names = model["languages"]

        def step(part: pa.RecordBatch) -> list:
            raws, letters = as_bytes(part.column(0)), part.column(1).to_pylist()
            if len(names) < 2:
                found = [names[0] if names and x else UNKNOWN for x in letters]
                return [found, [float(x != UNKNOWN) for x in found], [False] * len(found)]
            best, score, close = decode(outputs(raws, model["weights"]), model)
            return [
                [names[b] if x else UNKNOWN for b, x in zip(best.tolist(), letters)],
                [s if x else 0.0 for s, x in zip(score.tolist(), letters)],
                [bool(c and x) for c, x in zip(close.tolist(), letters)],
            ]

        return step

    content = F.col(f"`{text}`")
    inputs = {
        "__text": content,
        "__letters": F.coalesce(content.rlike(r"\p{L}"), F.lit(False)),
    }
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    return carry_map(docs, start, inputs, RESULT, carry, "__text")


def held_out(key: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, mod 3, is 1. A null id is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify_split(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    carry: list[str] | None = None,
) -> DataFrame:
    """Learn from the rows that are not held out, judge all rows; adds `held_out`."""
    known = docs.filter(~held_out(F.col(f"`{key}`")) & F.col(f"`{key}`").isNotNull())
    model = fit(known, text, lang)
    carry = [key] if carry is None else carry
    marked = docs.withColumn("held_out", held_out(F.col(f"`{key}`")))
    kept = [c for c in carry if c.lower() != "held_out"]
    return identify(marked, model, text, [*kept, "held_out"])
