"""Removal of repeated strings by difference-cover blockwise suffix sorting.

A string of `length` bytes that starts at two places makes their suffixes tie. Two places i and j
always have a common shift below the period v that takes both onto the difference cover, so:

1. Suffixes at cover places (q + 1 in every v = q^2 + q + 1) are sorted first, by their next
   length - v + 1 bytes. Only ties matter here, not the order of different strings: a rank is a
   class of equal content, kept when it has more than one member, and buckets are ranges of digests
   instead of ranges of letters.
2. A suffix without a ranked cover place in its first v bytes ties with nothing. The others are
   sorted one bucket at a time by digests of their `length` bytes; long ties are never compared
   byte by byte. A task holds the digests of one bucket, never text, so memory is bounded by
   the bucket.

Texts travel as compressed blocks of whole texts. Within a block equal digests are sent once, so a
string found anywhere reaches its bucket at most once per block, and buckets answer with one bit
per digest. Of equal texts one stands for all in the search: the others repeat it from end to end.

Equality of strings rests on a 64-bit digest besides the bucket's own bits, equality of texts on a
128-bit digest.

Cases: null text counts as empty; texts shorter than `length` keep all bytes; matches do not reach
over the end of a text; a text may repeat itself, overlapping or not; repeated rows remove each
other's bytes; an empty table gives an empty result; other columns of the input are not read; a
text of any length is one piece of a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrow import as_bytes, pieces
from millrace.runtime import BROADCAST_LIMIT_BYTES, lookup_join, materialized

LENGTH = 400
#: Text bytes per block and digests per bucket, about; larger ones suit larger clusters.
BLOCK_BYTES = 8 << 20
BUCKET_ENTRIES = 1 << 20
#: Digests made at once, so that few Python objects live at a time.
DIGESTS_AT_ONCE = 1 << 15


def is_prime(q: int) -> bool:
    return q > 1 and all(q % d for d in range(2, int(q**0.5) + 1))


def singer_cover(q: int) -> list[int]:
    """q + 1 places modulo q^2 + q + 1 whose differences are all residues (q prime).

    The powers of a generator of the field of q^3 elements whose last coordinate is 0.
    """
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                # x^3 = a x^2 + b x + c
                x, found = (0, 1, 0), [0, 1]
                for e in range(2, v):
                    low, mid, high = x
                    x = (c * high % q, (low + b * high) % q, (mid + a * high) % q)
                    if x[2] == 0:
                        found.append(e)
                if len(found) == q + 1 and len(
                    {(m - n) % v for m in found for n in found}
                ) == v:
                    return found
    raise ValueError(f"no cover for {q}")


def choose_cover(length: int) -> tuple[int, np.ndarray]:
    """Period and places of the cover for strings of this length: the sparsest that leaves the
    cover suffixes a fifth of the length to be told apart by."""
    fit = [q for q in range(2, 60) if is_prime(q) and q * q + q + 1 + max(length // 5, 4) <= length + 1]
    if not fit:
        return 1, np.zeros(1, np.int64)
    q = fit[-1]
    return q * q + q + 1, np.array(singer_cover(q), np.int64)


class Block:
    """Texts of a block, one behind another. `copies` are texts that another one stands for."""

    def __init__(self, packed: bytes, sizes: list[int], copies: np.ndarray, length: int):
        self.data = zstandard.ZstdDecompressor().decompress(packed) if packed else b""
        self.view = memoryview(self.data)
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        searched = self.sizes >= length
        searched[copies] = False
        self.searched = np.flatnonzero(searched)
        self.length = length

    def cover_places(self, period: int, cover: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cover places of the searched texts that leave room for a short string, and their text."""
        short = self.length - period + 1
        places, owner = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in self.searched.tolist():
            own = (np.arange(0, self.sizes[i], period)[:, None] + cover).ravel()
            own = own[own <= self.sizes[i] - short]
            places.append(self.starts[i] + own)
            owner.append(np.full(len(own), i))
        return np.concatenate(places), np.concatenate(owner)

    def short_digests(self, places: np.ndarray, length: int) -> np.ndarray:
        view, digest = self.view, xxhash.xxh3_64_intdigest
        out = np.empty(len(places), np.uint64)
        for i in range(0, len(places), DIGESTS_AT_ONCE):
            some = places[i : i + DIGESTS_AT_ONCE].tolist()
            out[i : i + len(some)] = [digest(view[p : p + length]) for p in some]
        return out

    def open_places(self, at: np.ndarray, owner: np.ndarray, period: int) -> np.ndarray:
        """Suffixes with one of the ranked cover places in their first `period` bytes."""
        low = np.maximum(self.starts[owner], at - period + 1)
        high = np.minimum(at, self.ends[owner] - self.length) + 1
        use = low < high
        return np.flatnonzero(marked(len(self.data), low[use], high[use]))

    def string_digests(self, places: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and 64-bit digest of the string at each place."""
        view, digest, length = self.view, xxhash.xxh3_128_digest, self.length
        bucket = np.empty(len(places), np.int64)
        out = np.empty(len(places), np.uint64)
        for i in range(0, len(places), DIGESTS_AT_ONCE):
            some = places[i : i + DIGESTS_AT_ONCE].tolist()
            packed = b"".join([digest(view[p : p + length]) for p in some])
            words = np.frombuffer(packed, np.uint64).reshape(-1, 2)
            bucket[i : i + len(some)] = bucket_of(words[:, 1], buckets)
            out[i : i + len(some)] = words[:, 0]
        return bucket, out


def marked(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Places inside any of the ranges [low, high)."""
    steps = np.bincount(low, minlength=size + 1) - np.bincount(high, minlength=size + 1)
    return np.cumsum(steps)[:size] > 0


def runs(mask: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of a mask, as rows."""
    steps = np.diff(np.r_[False, mask, False].astype(np.int8))
    return np.stack([np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)], axis=1)


def first_of_equal(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (first key first), and where in it a new value of them begins."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, new


def repeated(*keys: np.ndarray) -> np.ndarray:
    """Rows that have an equal row."""
    order, new = first_of_equal(*keys)
    group = np.cumsum(new) - 1
    out = np.empty(len(order), bool)
    out[order] = np.bincount(group, minlength=1)[group] > 1
    return out


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def cut_by_bucket(place: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, first, last) of the runs of equal buckets."""
    if not len(place):
        return []
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return [*zip(place[first].tolist(), first.tolist(), np.r_[first[1:], len(place)].tolist())]


class Sent:
    """A block's digests as sent: sorted by bucket, each once; and how places map onto them."""

    def __init__(self, bucket: np.ndarray, digest: np.ndarray):
        order, new = first_of_equal(bucket, digest)
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.bucket, self.digest = bucket[order][new], digest[order][new]
        self.repeated = np.bincount(self.group, minlength=len(self.digest)) > 1

    def cuts(self) -> list[tuple[int, int, int]]:
        return cut_by_bucket(self.bucket)

    def tied(self, notes: list[dict]) -> np.ndarray:
        """Places whose digest is found again, here or (by the buckets' bits) in another block."""
        tied, cuts = self.repeated.copy(), {b: i for b, i, _ in self.cuts()}
        for note in notes:
            i = cuts[note["bucket"]]
            tied[i : i + note["count"]] |= unpack(note)
        return tied[self.group]


ANSWER = "bucket int, block long, count long, payload binary"
#: Buckets of a block's own notes: copies, and runs of open places.
COPIES, OPEN = -1, -2


def answers(rows: list[tuple]) -> pa.RecordBatch:
    columns = [*zip(*rows)] if rows else [(), (), (), ()]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        names=["bucket", "block", "count", "payload"],
    )


def unpack(note: dict) -> np.ndarray:
    return np.unpackbits(np.frombuffer(note["payload"], np.uint8), count=note["count"]).astype(bool)


def notes_of(notes: list[dict] | None, *, own: int | None = None) -> list[dict]:
    """The block's own notes of a kind, or (without one) the answers of buckets."""
    return [n for n in notes or [] if (n["bucket"] >= 0 if own is None else n["bucket"] == own)]


def copies_of(notes: list[dict] | None) -> np.ndarray:
    found = notes_of(notes, own=COPIES)
    return np.frombuffer(found[0]["payload"], np.int64) if found else np.empty(0, np.int64)


def make_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Whole texts packed into stored blocks, with their keys and digests."""
    kind = docs.schema[key].dataType
    shape = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(kind)),
         T.StructField("digests", T.ArrayType(T.BinaryType())),
         T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("packed", T.BinaryType())]
    )

    def pack(batches):
        zip_up = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in pieces(batch, "text", BLOCK_BYTES):
                texts = as_bytes(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row").slice(0, 1),
                        pa.ListArray.from_arrays(
                            pa.array([0, len(texts)], pa.int32()), part.column("key")
                        ),
                        pa.array([[*map(xxhash.xxh3_128_digest, texts)]], pa.list_(pa.binary())),
                        pa.array([[*map(len, texts)]], pa.list_(pa.int64())),
                        pa.array([zip_up.compress(b"".join(texts))], pa.binary()),
                    ],
                    names=shape.names,
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"),
        F.col(f"`{text}`").alias("text"),
    )
    return materialized(rows.mapInArrow(pack, shape), "suffix-blocks")


def copy_notes(blocks: DataFrame, length: int) -> DataFrame:
    """Per block the places of texts of which an equal one exists, all but the first of each; a
    first one is noted as -1 - place, since it is removed too but searched."""
    texts = blocks.select("block", F.posexplode(F.arrays_zip("digests", "sizes")).alias("at", "text"))
    texts = texts.filter(F.col("text.sizes") >= length).select(
        "block", "at", F.col("text.digests").alias("digest")
    )
    first = (
        texts.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("block", "at")).alias("first"))
        .filter("n > 1").select("digest", "first")
    )
    found = lookup_join(texts, materialized(first, "suffix-copies"), ["digest"], "inner")
    place = F.when(
        (F.col("block") == F.col("first.block")) & (F.col("at") == F.col("first.at")), -1 - F.col("at")
    ).otherwise(F.col("at"))

    def pack(table: pa.Table) -> pa.Table:
        packed = table.column("place").to_numpy().astype(np.int64)
        return pa.Table.from_batches(
            [answers([(COPIES, table.column("block")[0].as_py(), len(packed), packed.tobytes())])]
        )

    return materialized(
        found.select("block", place.cast("long").alias("place")).groupBy("block").applyInArrow(pack, ANSWER),
        "suffix-copies",
    )


def with_notes(blocks: DataFrame, notes: DataFrame) -> DataFrame:
    """Blocks with the notes about them. Blocks stay where they are when the notes are small."""
    size = notes.agg(F.sum(F.octet_length("payload") + 64)).first()[0] or 0
    each = notes.groupBy("block").agg(  # a block's notes are about its own content
        F.collect_list(F.struct("bucket", "count", "payload")).alias("notes")
    )
    return blocks.join(F.broadcast(each) if size <= BROADCAST_LIMIT_BYTES else each, "block", "left")


def meet(kind: str):
    """Sorts one bucket; answers each block with a bit per digest, where any is found again."""

    def work(table: pa.Table) -> pa.Table:
        bucket, block, count, payload = (
            table.column(c).to_pylist() for c in ("bucket", "block", "count", "payload")
        )
        if bucket[0] < 0:
            return table.select(["bucket", "block", "count", "payload"])
        digest = np.concatenate([np.frombuffer(p, kind) for p in payload])
        tied = repeated(digest)
        rows, at = [], 0
        for b, n in zip(block, count):
            bits = tied[at : at + n]
            if bits.any():
                rows.append((bucket[0], b, n, np.packbits(bits).tobytes()))
            at += n
        return pa.Table.from_batches([answers(rows)])

    return work


def rank_cover(
    blocks: DataFrame, buckets: int, length: int, period: int, cover: np.ndarray
) -> DataFrame:
    """Stored answers about cover suffixes."""

    def send(batches):
        for batch in batches:
            for block, sizes, packed, notes in zip(*(c.to_pylist() for c in batch.columns)):
                own = Block(packed, sizes, searched_copies(notes), length)
                at, _ = own.cover_places(period, cover)
                sent = brief(own, at, period, buckets)
                yield answers(
                    [(b, block, j - i, sent.digest[i:j].tobytes()) for b, i, j in sent.cuts()]
                )

    sent = blocks.select("block", "sizes", "packed", "notes").mapInArrow(send, ANSWER)
    return materialized(sent.groupBy("bucket").applyInArrow(meet("u4"), ANSWER), "suffix-ranks")


def searched_copies(notes: list[dict] | None) -> np.ndarray:
    places = copies_of(notes)
    return places[places >= 0]


def brief(own: Block, at: np.ndarray, period: int, buckets: int) -> Sent:
    """Digests of cover suffixes; they only rule suffixes out, so 32 bits a bucket are enough."""
    short = own.short_digests(at, own.length - period + 1)
    return Sent(bucket_of(short, buckets), short.astype(np.uint32))


def sort_rest(
    blocks: DataFrame, ranked_in: int, buckets: int, length: int, period: int, cover: np.ndarray
) -> DataFrame:
    """Stored answers about the suffixes that may tie, and each block's runs of them."""

    def send(batches):
        for batch in batches:
            for block, sizes, packed, notes in zip(*(c.to_pylist() for c in batch.columns)):
                own = Block(packed, sizes, searched_copies(notes), length)
                at, owner = own.cover_places(period, cover)
                ranked = brief(own, at, period, ranked_in).tied(notes_of(notes))
                places = own.open_places(at[ranked], owner[ranked], period)
                mask = np.zeros(len(own.data), bool)
                mask[places] = True
                stretches = runs(mask)
                sent = Sent(*own.string_digests(places, buckets))
                yield answers(
                    [(OPEN, block, len(stretches), stretches.tobytes())]
                    + [(b, block, j - i, sent.digest[i:j].tobytes()) for b, i, j in sent.cuts()]
                )

    sent = blocks.select("block", "sizes", "packed", "notes").mapInArrow(send, ANSWER)
    # Runs need no meeting; they are spread over many groups.
    meeting = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("block"), F.lit(buckets))).otherwise(
        F.col("bucket")
    )
    return materialized(
        sent.groupBy(meeting.alias("meeting")).applyInArrow(meet("u8"), ANSWER), "suffix-rest"
    )


def removed_bytes(own: Block, notes: list[dict], buckets: int) -> np.ndarray:
    """The mask of bytes that some repeated string covers."""
    mask = np.zeros(len(own.data), bool)
    for note in notes_of(notes, own=OPEN):
        mask |= marked(len(mask), *np.frombuffer(note["payload"], np.int64).reshape(-1, 2).T)
    places = np.flatnonzero(mask)
    tied = places[Sent(*own.string_digests(places, buckets)).tied(notes_of(notes))]
    mask = marked(len(mask), tied, tied + own.length)
    copies = copies_of(notes)
    for i in np.where(copies < 0, -1 - copies, copies).tolist():
        mask[own.starts[i] : own.ends[i]] = True
    return mask


def finish(blocks: DataFrame, buckets: int, length: int, key: str) -> DataFrame:
    kind = blocks.schema["keys"].dataType.elementType
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    shape = T.StructType(
        [T.StructField(key, kind), T.StructField("n_bytes", T.LongType()),
         T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.BinaryType())]
    )
    span_list = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys, sizes, packed, notes = (c[i] for c in batch.columns)
                notes = notes.as_py() or []
                own = Block(packed.as_py(), sizes.as_py(), searched_copies(notes), length)
                removed = removed_bytes(own, notes, buckets)
                spans, kept = [], []
                data = np.frombuffer(own.data, np.uint8)
                for start, end in zip(own.starts.tolist(), own.ends.tolist()):
                    mask = removed[start:end]
                    found = runs(mask).tolist()
                    spans.append([{"start": a, "end": b} for a, b in found])
                    kept.append(data[start:end][~mask].tobytes() if found else own.data[start:end])
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(own.sizes), pa.array(spans, span_list),
                     pa.array(kept, pa.binary())],
                    names=shape.names,
                )

    return blocks.select("keys", "sizes", "packed", "notes").mapInArrow(work, shape)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per document: `key`, n_bytes, the removed `spans` and the `kept` bytes."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    period, cover = choose_cover(length)
    blocks = make_blocks(docs, key, text)
    copies = copy_notes(blocks, length)
    ranked_in = max(8, size * len(cover) // period // BUCKET_ENTRIES)
    ranks = rank_cover(with_notes(blocks, copies), ranked_in, length, period, cover)
    buckets = max(8, size // 4 // BUCKET_ENTRIES)
    rest = sort_rest(
        with_notes(blocks, copies.unionByName(ranks)), ranked_in, buckets, length, period, cover
    )
    return finish(with_notes(blocks, copies.unionByName(rest)), buckets, length, key)
