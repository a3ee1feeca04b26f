"""N-gram Jaccard join by T-occurrence search.

1. Texts become sets of word-shingle digests; equal sets are one node from then on.
2. A link leaves at most H different shingles between two sets, so of H + T parts of the digest
   space at least T hold equal shingles in both; one is enough to make a candidate. Each set sends one key per part (and size class it
   may meet a partner in); keys meet in buckets, each sorted alone. Parts that hold nothing but shingles
   of very many documents (counted first, over all of them) or nothing at all are weak: a common
   line would chain all its documents through them. T is chosen so that hardly any set has T empty
   parts. Two linked sets with T equal parts share one that is not weak, or both have T weak ones;
   sets with T weak parts send the keys of those too, so nothing is lost.
   A key of few sets makes pairs. A pair stays when the parity bits of the two sets (per set a bit for
   each place of about half a shingle) differ in no more places than linked sets have differences: a
   difference turns one bit, so no link is lost and chance pairs go. The sets of a key of many sets are
   chained to the smallest, but only those with so many such keys that a partner may share no other.
3. Chains of candidates are gathered into blocks of bounded size: many small chains share one, a
   large chain is split by set size and hash into blocks that are met in pairs.
4. In a block, inverted lists from shingle to sets answer each set's query with DivideSkip: the
   short lists are merged, sets that miss the reduced count fall out, and the long lists are
   only probed by binary search for those that are left. Counts of shared shingles are exact, so
   links are verified, not estimated.
5. Links give components by contraction in Spark.

Copies are never paired, blocks and buckets are bounded, and no group passes through one task.

Cases: null and empty texts have no shingles and no links; texts with fewer words than a shingle
have the whole sequence as their one shingle; a row with a null id has no links and a null
component; repeated rows are copies of one set; rows of one id with different texts are judged apart; an empty table gives an empty result; other
columns of the input are not read; a text of any length is read whole.
"""

from __future__ import annotations

import bisect
import heapq
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import as_bytes, pieces, released, released_group
from millrace.llm.graph import components
from millrace.runtime import (
    BROADCAST_LIMIT_BYTES,
    freed_shuffles,
    lookup_join,
    materialized,
    measured_bytes,
    owned_scratch,
    scratch,
)

WORDS_PER_SHINGLE = 3
#: A link needs OVER * shared >= PERCENT * united shingles.
PERCENT, OVER = 90, 100
#: Sizes below this have a class of their own; above, a class spans this factor, or what a link spans.
SINGLE_SIZES, CLASS_FACTOR = 64, 1.12
#: Sets of a key that are paired; keys of more sets are hot.
PAIRED_SETS = 8
#: Parity bits per shingle, at least; keys that a task packs at once, and bytes of a packed key or name.
PARITY_BITS, LOT_KEYS, PACKED = 2, 1 << 19, 6
#: A set has T empty parts with at most this probability.
POOR = 1e-3
#: Shingles in one of so many documents are frequent. One in twice as many may be taken for it, so
#: there are at most twice this times the mean set size of them; of more than the second number
#: the most frequent count, which changes the work and no result.
FREQUENT, FREQUENT_MOST = 256, 1 << 17
#: No shingle of fewer documents is frequent, and shingles counted at once in a task.
FREQUENT_LEAST, LOT_SHINGLES = 64, 1 << 19
#: Entries per bucket and shingles per block, about.
BUCKET_ENTRIES = 1 << 20
#: A usual number of shingles of a text, for the number of buckets.
USUAL_SIZE = 256
#: Text bytes shingled at once, or one text.
PIECE_BYTES = 1 << 20
BLOCK_SHINGLES = 1 << 21
#: Entries of short lists up to which a heap merges them; more are sorted at once.
HEAP_ENTRIES = 1 << 10

SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * STEP)


_POWERS: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """Powers of STEP and of its inverse, at least n of each; kept by the task."""
    if not _POWERS or len(_POWERS[0]) < n:
        ones = np.full(1 << max(20, (n - 1).bit_length()), np.uint64(1))
        _POWERS[:] = []
        for base in (STEP, STEP_BACK):
            table = ones * base
            table[0] = 1
            _POWERS.append(np.cumprod(table, out=table))
    return _POWERS


def shingle_sets(raws: list[bytes], width: int = WORDS_PER_SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle digests of each text."""
    data = np.frombuffer(b"\n".join([*raws, b""]).translate(LOWER), np.uint8)
    if not len(data):
        return []
    up, down = powers(len(data))
    blank = SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[True, blank].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    word = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    sizes = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    bounds = np.searchsorted(starts, np.cumsum(sizes)).tolist()
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(len(word) - width + 1, 0)
    runs = np.zeros(n, np.uint64)
    for k in range(width):
        runs += word[k : k + n] * factors[k]
    runs = mixed(runs)
    out, first = [], 0
    for last in bounds:
        count = last - first
        if count >= width:
            out.append(np.unique(runs[first : last - width + 1]))
        elif count:
            whole = np.sum(word[first:last] * factors[:count], dtype=np.uint64)
            out.append(mixed(whole[None] + np.uint64(count)))
        else:
            out.append(np.empty(0, np.uint64))
        first = last
    return out


def needed(size: int, other: int, percent: int = PERCENT, over: int = OVER) -> int:
    """Fewest shared shingles of a link between sets of these sizes."""
    return -(-percent * (size + other) // (over + percent))


NONE = np.empty(0, np.uint64)


class Parts:
    """How sets of a size class are cut: differences allowed, parts, and needed equal parts."""

    def __init__(self, percent: int, over: int):
        self.percent, self.over = percent, over
        self.factor = max(CLASS_FACTOR, over / percent)
        self.bounds = [*range(1, SINGLE_SIZES)]
        self.cuts: dict[int, tuple[int, int]] = {}

    def class_of(self, size: int) -> int:
        while self.bounds[-1] <= size:
            self.bounds.append(
                self.bounds[-1] + 1 if len(self.bounds) < SINGLE_SIZES
                else max(self.bounds[-1] + 1, int(self.bounds[-1] * self.factor))
            )
        return int(np.searchsorted(self.bounds, size, "right")) - 1

    def classes(self, size: int) -> range:
        """Classes in which a set of this size may be the larger one, and its own."""
        smallest = -(-self.percent * size // self.over)
        return range(self.class_of(max(smallest, 1)), self.class_of(size) + 1)

    def cut(self, c: int) -> tuple[int, int]:
        """Parts and needed equal parts T of class c."""
        if c not in self.cuts:
            self.class_of(self.bounds[c])
            low, high = self.bounds[c], self.bounds[c + 1] - 1
            differences = high * (self.over - self.percent) // self.percent
            best = None
            for t in range(1, 100):
                parts = differences + t
                mean = parts * math.exp(-low / parts)
                tail = 1.0 - sum(
                    math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(t)
                )
                if best is None or tail < best[0]:
                    best = (tail, parts, t)
                if tail <= POOR:
                    break
            self.cuts[c] = best[1:]
        return self.cuts[c]

    def rate(self, size: int) -> float:
        """Keys per shingle of a set of this size, about."""
        cuts = [self.cut(c)[0] for c in self.classes(size)]
        return sum(parts * -math.expm1(-size / parts) for parts in cuts) / size

    def keys(self, shingles: np.ndarray, frequent: np.ndarray = NONE) -> np.ndarray:
        """One key per class and part that is not weak; also for weak ones where T or more are."""
        return self.sent(shingles, frequent)[0]

    def sent(self, shingles: np.ndarray, frequent: np.ndarray = NONE) -> tuple[np.ndarray, bytes]:
        """The keys, whose last byte is the class, and per class the fewest keys shared with a linked set.

        `frequent` is sorted and the same for all sets. Linked sets have T equal parts; those that
        either of them does not send are weak in both. The first byte names the first class.
        """
        out, scrambled = [], mixed(shingles)
        rare = np.ones(len(shingles), bool)
        if len(frequent):
            rare = frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] != shingles
        high = shingles >> np.uint64(32)
        classes = self.classes(len(shingles))
        least = [classes[0] & 0xFF]
        for c in classes:
            parts, t = self.cut(c)
            part = (high * np.uint64(parts)) >> np.uint64(32)
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            sums = np.add.reduceat(scrambled, first)
            names = part[first]
            strong = np.logical_or.reduceat(rare, first)
            weak = parts - np.count_nonzero(strong)
            least.append(max(t - weak, 1))
            if weak < t:
                names, sums = names[strong], sums[strong]
            else:
                empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), names)
                names = np.r_[names, empty]
                sums = np.r_[sums, np.zeros(len(empty), np.uint64)]
            keys = mixed(sums + mixed(names + np.uint64((c + 1) << 32)))
            out.append((keys & ~np.uint64(0xFF)) | np.uint64(c & 0xFF))
        return np.concatenate(out), bytes(least)


def parity(shingles: np.ndarray) -> bytes:
    """Bits that tell, for each place of the digest space, whether it holds an odd number of shingles."""
    bits = max(64, 1 << (PARITY_BITS * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(
    sizes: np.ndarray, others: np.ndarray, left: list[bytes], right: list[bytes], percent: int, over: int
) -> np.ndarray:
    """Which pairs of sets may be linked, by their sizes and parity bits; every linked pair may."""
    low, high = np.minimum(sizes, others), np.maximum(sizes, others)
    out = percent * high <= over * low
    most = sizes + others - 2 * -(-percent * (sizes + others) // (over + percent))
    widths = np.array([*map(len, left)]) * (1 << 32) + np.array([*map(len, right)])
    for width in np.unique(widths[out]).tolist():
        at = np.flatnonzero(out & (widths == width))
        bits = [
            np.frombuffer(b"".join(side[i] for i in at.tolist()), np.uint64).reshape(len(at), -1)
            for side in (left, right)
        ]
        for k in (0, 1):  # the wider bits folded to the narrower
            while bits[k].shape[1] > bits[1 - k].shape[1]:
                half = bits[k].shape[1] // 2
                bits[k] = bits[k][:, :half] ^ bits[k][:, half:]
        out[at] = np.bitwise_count(bits[0] ^ bits[1]).sum(1, dtype=np.int64) <= most[at]
    return out


def set_name(digest: bytes) -> int:
    """A short name of a set for candidate search; two sets of one name only add a candidate."""
    return int.from_bytes(digest[:PACKED], "little")


FOUND = "kind int, bucket int, id long, n long, digest binary, payload binary, least binary, a long, b long"
MEMBER, KEYS, PAIR, HOT = 0, 1, 2, 3


def _found(kind: int, rows: int, **columns) -> pa.RecordBatch:
    types = {
        "kind": pa.int32(), "bucket": pa.int32(), "id": pa.int64(), "n": pa.int64(),
        "digest": pa.binary(), "payload": pa.binary(), "least": pa.binary(),
        "a": pa.int64(), "b": pa.int64(),
    }
    columns |= {"kind": np.full(rows, kind, np.int32)}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in types.items()],
        names=[*types],
    )


def packed(numbers: np.ndarray) -> np.ndarray:
    """The low bytes of each number, one row each."""
    return numbers.view(np.uint8).reshape(-1, 8)[:, :PACKED]


def unpacked(raw: bytes) -> np.ndarray:
    rows = np.frombuffer(raw, np.uint8).reshape(-1, PACKED)
    return np.pad(rows, ((0, 0), (0, 8 - PACKED))).view(np.uint64).ravel()


def distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of equally long columns, and how often each occurs."""
    order = np.lexsort(columns)
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.diff(np.r_[first, len(order)])


def met_names(keys: np.ndarray, names: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Distinct pairs (a, b) of names of one key; for hot keys distinct (name, smallest name of
    the key, class), the smallest with itself too, and the number of keys of each."""
    (names, keys), _ = distinct(names, keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    count = np.diff(np.r_[first, len(keys)])
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in range(2, PAIRED_SETS + 1):
        at = first[count == n]
        for i in range(n if len(at) else 0):
            for j in range(i + 1, n):
                a.append(names[at + i])
                b.append(names[at + j])
    pairs, _ = distinct(np.concatenate(a), np.concatenate(b))
    hot = np.repeat(count > PAIRED_SETS, count)
    low = np.repeat(names[first], count)[hot]
    links, times = distinct(names[hot], low, (keys[hot] & np.uint64(0xFF)).astype(np.int64))
    return pairs, links, times


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted digests of the shingles that at least one of FREQUENT documents holds.

    Every document is counted. A task counts lots of sets and passes on what one of 2 * FREQUENT
    documents of a lot holds: what falls out of the lots is less than half of a frequent shingle's
    count, so none is missed, and few rows leave the tasks.
    """

    def lots(batches):
        held: list[np.ndarray] = []

        def counted():
            shingles, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(2, len(held) // (2 * FREQUENT))
            # A row without a shingle tells how many documents the lot has.
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *shingles[often].view(np.int64).tolist()], pa.int64()),
                 pa.array(np.r_[len(held), n[often]], pa.int64())],
                names=["shingle", "n"],
            )
            held.clear()

        mass = 0
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                made = [s for s in shingle_sets(as_bytes(part.column("text")), width) if len(s)]
                held += made
                mass += sum(map(len, made))
                if mass > LOT_SHINGLES:
                    yield from counted()
                    mass = 0
        if held:
            yield from counted()

    counts = materialized(
        docs.select("text").mapInArrow(released(lots), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")),
        "join-frequent",
    )
    documents = counts.filter("shingle IS NULL").agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT_LEAST, documents // (2 * FREQUENT))
    rows = (
        counts.filter((F.col("n") >= least) & F.col("shingle").isNotNull())
        .orderBy(F.desc("n"), "shingle").limit(FREQUENT_MOST).collect()
    )
    return np.sort(np.array([r["shingle"] for r in rows], np.int64).view(np.uint64))


def candidates(
    docs: DataFrame, buckets: int, width: int, parts: Parts, frequent: np.ndarray
) -> DataFrame:
    """Stored rows of three kinds: members (id, n, digest, a, the set's name, payload, its parity bits, and
    least, see `Parts.sent`), pairs (a, b) of set names, and of hot keys (a, b, bucket, the class,
    and n, the number of such keys) with b the smallest name of the key."""

    def send(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def lot():
            """The keys held, a row per bucket."""
            keys, names = (np.concatenate(x) for x in zip(*held))
            held.clear()
            where = (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(where, kind="stable")
            keys, names, where = packed(keys[order]), packed(names[order]), where[order]
            cut = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
            ends = np.r_[cut[1:], len(keys)]
            return _found(
                KEYS, len(cut), bucket=where[cut],
                payload=[keys[i:j].tobytes() + names[i:j].tobytes() for i, j in zip(cut, ends)],
            )

        mass = 0
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                ids = part.column(0)
                sets = shingle_sets(as_bytes(part.column(1)), width)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                place = [int.from_bytes(d[:4], "little") * buckets >> 32 if d else 0 for d in digests]
                seen = {
                    d: s for d, s, i in zip(digests, sets, ids.is_valid().to_pylist()) if d and i
                }
                own = {d: parts.sent(s, frequent) for d, s in seen.items()}
                bits = {d: parity(s) for d, s in seen.items()}
                yield _found(
                    MEMBER, len(sets), bucket=pa.array(place, pa.int32()), id=ids,
                    n=[*map(len, sets)], digest=digests, payload=[bits.get(d) for d in digests],
                    least=[own[d][1] if d in own else None for d in digests],
                    a=[set_name(d) if d else None for d in digests],
                )
                for d, (keys, _) in own.items():
                    held.append((keys, np.full(len(keys), set_name(d), np.int64)))
                    mass += len(keys)
                if mass > LOT_KEYS:
                    yield lot()
                    mass = 0
        if held:
            yield lot()

    def meet(table: pa.Table) -> pa.Table:
        """One bucket: its keys are sorted alone; members pass."""
        kinds = table.column("kind")
        rows = table.filter(pa.compute.equal(kinds, KEYS)).column("payload").to_pylist()
        out = [table.filter(pa.compute.not_equal(kinds, KEYS))]
        if rows:
            keys = unpacked(b"".join(p[: len(p) // 2] for p in rows))
            names = unpacked(b"".join(p[len(p) // 2 :] for p in rows)).view(np.int64)
            del rows
            (a, b), (name, low, kind), times = met_names(keys, names)
            out += [
                pa.Table.from_batches([made]).cast(table.schema) for made in (
                    _found(PAIR, len(a), a=a, b=b),
                    _found(HOT, len(name), a=name, b=low, bucket=kind.astype(np.int32), n=times),
                )
            ]
        return pa.concat_tables(out)

    sent = docs.mapInArrow(released(send), FOUND)
    # Members need no meeting: they only ride along, spread by digest.
    return materialized(sent.groupBy("bucket").applyInArrow(released_group(meet), FOUND), "join-found")


def edges_of(found: DataFrame, sets: DataFrame, percent: int, over: int) -> DataFrame:
    """Edges (a, b) between names: pairs that may be linked, and the chains of hot keys.

    Sets that share nothing but hot keys share as many of them as `least` says, in one class; who has fewer leaves the
    chains, as all its partners have met it in pairs.
    """
    pairs = found.filter(F.col("kind") == PAIR).select("a", "b").distinct()
    bits = sets.select(F.col("name").alias("a"), F.col("n").alias("na"), F.col("bits").alias("left"))
    other = sets.select(F.col("name").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("right"))

    def near(batches):
        for batch in batches:
            for part in pieces(batch, "left", PIECE_BYTES):
                fits = may_link(
                    *(part.column(c).to_numpy() for c in ("na", "nb")),
                    *(part.column(c).to_pylist() for c in ("left", "right")), percent, over,
                )
                yield part.select(["a", "b"]).filter(pa.array(fits))

    near_pairs = pairs.join(bits, "a").join(other, "b").select("a", "b", "na", "nb", "left", "right").mapInArrow(
        released(near), "a long, b long"
    )
    hot = found.filter(F.col("kind") == HOT).select("a", "b", "n", F.col("bucket").alias("class"))

    def byte(at):
        return F.conv(F.hex(F.substring("least", at, F.lit(1))), 16, 10).cast("int")

    chained = (
        hot.groupBy("a", "class").agg(F.sum("n").alias("times"))
        .join(sets.select(F.col("name").alias("a"), "least"), "a")
        .filter(F.col("times") >= byte(F.col("class") - byte(F.lit(1)) + 2))
        .select("a", "class").distinct()
    )
    return materialized(
        near_pairs.unionByName(hot.join(chained, ["a", "class"]).filter("a != b").select("a", "b").distinct()), "join-edges"
    )


def merge_skip(lists: list[list[int]], least: int) -> tuple[list[int], list[int]]:
    """Ids in at least `least` of the sorted lists, and in how many, by one heap over the lists.

    When the smallest id is in too few lists, the least - 1 lists at the top jump by binary search
    to the id that follows: what they pass over cannot be in enough of the others.
    """
    heap = [(ids[0], i, 0) for i, ids in enumerate(lists) if ids]
    heapq.heapify(heap)
    found, counts = [], []
    while len(heap) >= least:
        low, popped = heap[0][0], []
        while heap and heap[0][0] == low:
            popped.append(heapq.heappop(heap))
        if len(popped) >= least:
            found.append(low)
            counts.append(len(popped))
            target = low + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                break
            target = max(heap[0][0], low + 1)
        for _, i, at in popped:
            at = bisect.bisect_left(lists[i], target, at)
            if at < len(lists[i]):
                heapq.heappush(heap, (lists[i][at], i, at))
    return found, counts


class Linked:
    """What the links of a block come to: link counts, and enough pairs to connect what they connect.

    Groups know their members; the smaller joins the larger, so pairs are never stored.
    """

    def __init__(self, copies: np.ndarray, side: np.ndarray):
        self.copies, self.side = copies, side
        #: Two blocks meet here: pairs inside either belong to its own task.
        self.across = bool((side != side[0]).any()) if len(side) else False
        self.counts = np.zeros(len(copies), np.int64)
        self.group = np.arange(len(copies))
        self.members = [np.array([i]) for i in range(len(copies))]
        self.pairs: list[tuple[int, int]] = []

    def add(self, q: int, partners: np.ndarray) -> None:
        """Links from q to each of the partners."""
        if self.across:
            partners = partners[self.side[partners] != self.side[q]]
        if not len(partners):
            return
        self.counts[q] += self.copies[partners].sum()
        self.counts[partners] += self.copies[q]
        groups, first = np.unique(self.group[partners], return_index=True)
        for g, i in zip(groups.tolist(), first.tolist()):
            mine = int(self.group[q])
            if g == mine:
                continue
            self.pairs.append((q, int(partners[i])))
            small, large = sorted((g, mine), key=lambda x: len(self.members[x]))
            self.group[self.members[small]] = large
            self.members[large] = np.concatenate([self.members[large], self.members[small]])
            self.members[small] = self.members[small][:0]


def linked_in_block(
    sets: list[np.ndarray],
    percent: int = PERCENT,
    over: int = OVER,
    copies: np.ndarray | None = None,
    side: np.ndarray | None = None,
) -> Linked:
    """The links of the block, each pair met once and then forgotten.

    `sets` are sorted distinct shingles, in order of size; `copies` are the documents of each and `side`
    tells two blocks apart, of which only pairs across are wanted. T-occurrence search with DivideSkip: the
    short lists are merged by a heap, or by one sort when they hold many entries; the long ones
    are probed by binary search.
    """
    sizes = np.array([*map(len, sets)], np.int64)
    n = len(sets)
    found = Linked(
        np.ones(n, np.int64) if copies is None else copies, np.zeros(n, np.int64) if side is None else side
    )
    if n < 2:
        return found
    tokens, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    lists = np.sort(token.astype(np.int64) * n + owner)  # inverted lists, one behind another
    length = np.bincount(token, minlength=len(tokens))
    start = np.cumsum(length) - length
    ends = np.cumsum(sizes)
    for q in range(n):
        own = token[ends[q] - sizes[q] : ends[q]]
        own = own[length[own] > 1]
        # A partner is at least as large (smaller ones ask themselves), so it shares at least t.
        t = needed(int(sizes[q]), int(sizes[q]), percent, over)
        if len(own) < t:
            continue
        own = own[np.argsort(length[own], kind="stable")]
        longest = int(length[own[-1]])
        skipped = min(t - 1, int(t / (0.0085 * math.log2(longest + 1) + 1)))
        short, long = own[: len(own) - skipped], own[len(own) - skipped :]
        counts = length[short]
        at = np.repeat(start[short] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        hits = lists[at] - np.repeat(short, counts) * n
        if len(hits) <= HEAP_ENTRIES:
            cuts = np.cumsum(counts).tolist()
            ids = hits.tolist()
            later = [
                ids[bisect.bisect_right(ids, q, i, j) : j] for i, j in zip([0, *cuts], cuts)
            ]
            partner, shared = (np.array(x, np.int64) for x in merge_skip(later, t - skipped))
        else:
            partner, shared = np.unique(hits[hits > q], return_counts=True)
            enough = shared >= t - skipped
            partner, shared = partner[enough], shared[enough]
        fits = percent * sizes[partner] <= over * sizes[q]
        partner, shared = partner[fits], shared[fits]
        if not len(partner):
            continue
        if skipped:
            probe = (long[:, None] * n + partner).ravel()
            place = np.minimum(np.searchsorted(lists, probe), len(lists) - 1)
            shared = shared + (lists[place] == probe).reshape(skipped, -1).sum(0)
        linked = over * shared >= percent * (sizes[q] + sizes[partner] - shared)
        found.add(q, partner[linked])
    return found


def block_table(chains: DataFrame) -> tuple[DataFrame, int]:
    """Blocks (cluster, step, slots) of chains too large for one block; packs for the others.

    A step is a class of sizes: partners are in the same or the next few steps.
    """
    steps = materialized(
        chains.groupBy("cluster", "step")
        .agg(F.sum("n").alias("mass"), F.min("n").alias("low"), F.max("n").alias("high")),
        "join-steps",
    )
    masses = steps.groupBy("cluster").agg(F.sum("mass").alias("mass"))
    large = masses.filter(F.col("mass") > BLOCK_SHINGLES).select("cluster")
    small = masses.filter(F.col("mass") <= BLOCK_SHINGLES).agg(F.sum("mass")).first()[0] or 0
    slots = F.ceil(F.col("mass") / BLOCK_SHINGLES).cast("int")
    return steps.join(large, "cluster").withColumn("slots", slots), 1 + 2 * small // BLOCK_SHINGLES


def links(
    docs: DataFrame, sets: DataFrame, edges: DataFrame, width: int, percent: int, over: int
) -> DataFrame:
    """Stored verified links: connecting pairs (a, b) of sets, by `rep`, and per set (a) how many
    documents it is linked to (`links`, b null)."""
    chains = components(edges).select(F.col("node").alias("name"), F.col("component").alias("cluster"))
    step = F.floor(F.log("n") / math.log(CLASS_FACTOR)).cast("int")
    chained_sets = materialized(
        sets.join(chains, "name").select(
            "rep", "id", "digest", "n", "copies", "cluster", step.alias("step")
        ),
        "join-chains",
    )
    blocks, packs = block_table(chained_sets)
    blocks = materialized(blocks, "join-blocks")
    one = blocks.select("cluster", "step", "low", "high",
                        F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    two = one.select("cluster", *[F.col(c).alias(f"{c}2") for c in ("step", "low", "high", "slot")])
    # Pairs of blocks whose sizes can link, the smaller first; each pair is one task.
    pairs = one.join(two, "cluster").filter(
        (F.struct("step", "slot") <= F.struct("step2", "slot2"))
        & (percent * F.col("low2") <= over * F.col("high"))
    ).withColumn("task", F.concat_ws("/", "cluster", "step", "slot", "step2", "slot2"))
    seats = materialized(
        pairs.select("cluster", "step", "slot", "task", F.lit(1).alias("side"))
        .unionByName(
            pairs.filter((F.col("step") != F.col("step2")) | (F.col("slot") != F.col("slot2")))
            .select("cluster", F.col("step2").alias("step"), F.col("slot2").alias("slot"), "task",
                    F.lit(2).alias("side"))
        ),
        "join-seats",
    )
    whole = chained_sets.join(blocks.select("cluster", "step", "slots"), ["cluster", "step"], "left")
    packed = whole.filter("slots IS NULL").select(
        "rep", "id", "digest", "copies",
        F.array(F.struct(
            F.concat(F.lit("pack "), F.pmod(F.xxhash64("cluster"), F.lit(packs))).alias("task"),
            F.lit(1).alias("side"),
        )).alias("seats"),
    )
    split = (
        whole.filter("slots IS NOT NULL")
        .withColumn("slot", F.pmod(F.xxhash64("rep"), F.col("slots")).cast("int"))
        .join(seats.groupBy("cluster", "step", "slot").agg(
            F.collect_list(F.struct("task", "side")).alias("seats")), ["cluster", "step", "slot"])
        .select("rep", "id", "digest", "copies", "seats")
    )
    wanted = materialized(packed.unionByName(split), "join-wanted")
    asked, size = docs.filter("id IS NOT NULL"), measured_bytes(wanted)
    if size > BROADCAST_LIMIT_BYTES:  # then texts move, but only those of the wanted sets
        ids = materialized(wanted.select("id").distinct(), "join-ids")
        asked = lookup_join(asked, ids, ["id"], "inner", size=2 * 8 * ids.count())
    texts = lookup_join(asked, wanted, ["id"], "inner", size=size).select(
        "rep", "text", "digest", "copies", "seats"
    )

    def gather(batches):
        """Shingles of the wanted sets; a row of the same id with another text is not meant."""
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                made = shingle_sets(as_bytes(part.column("text")), width)
                keep = [
                    i for i, (s, d) in enumerate(zip(made, part.column("digest").to_pylist()))
                    if len(s) and xxhash.xxh3_128_digest(s.tobytes()) == d
                ]
                rest = part.select(["rep", "copies", "seats"]).take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, pa.array([made[i].tobytes() for i in keep], pa.binary())],
                    names=["rep", "copies", "seats", "shingles"],
                )

    seated = texts.mapInArrow(
        released(gather), "rep long, copies long, seats array<struct<task string, side int>>, shingles binary"
    ).select("rep", "copies", "shingles", F.explode("seats").alias("seat")).select(
        "rep", "copies", "shingles", "seat.task", "seat.side"
    )

    def search(table: pa.Table) -> pa.Table:
        rows: dict[int, tuple] = {}
        columns = (table.column(x).to_pylist() for x in ("rep", "copies", "shingles", "side"))
        for i, c, s, side in zip(*columns):
            rows[i] = (len(s), i, np.frombuffer(s, np.uint64), c, side)
        order = sorted(rows.values(), key=lambda r: r[:2])
        ids, copies, side = (np.array([r[k] for r in order], np.int64) for k in (1, 3, 4))
        found = linked_in_block([r[2] for r in order], percent, over, copies, side)
        counts, some = found.counts, np.flatnonzero(found.counts)
        pairs = np.array(found.pairs, np.int64).reshape(-1, 2)
        del found, rows, order
        return pa.table({
            "a": pa.array(np.r_[ids[pairs[:, 0]], ids[some]]),
            "b": pa.array([*ids[pairs[:, 1]].tolist(), *[None] * len(some)], pa.int64()),
            "links": pa.array([*[None] * len(pairs), *counts[some].tolist()], pa.int64()),
        })

    return materialized(
        seated.groupBy("task").applyInArrow(released_group(search), "a long, b long, links long"), "join-links"
    )


def similarity_join(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WORDS_PER_SHINGLE,
    percent: int = PERCENT,
    over: int = OVER,
) -> DataFrame:
    """One row per document: `key`, n_shingles, component_id (smallest id that links lead to) and
    n_links (documents it is linked to, copies included)."""
    if not 0 < 2 * percent <= 2 * over or 10 * percent < 7 * over:
        raise ValueError("the similarity is between 0.7 and 1")
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "join-result")
    with owned_scratch(spark, "join"):  # the tables of the search go with it
        joined = _joined(docs, key, text, width, percent, over)
        with freed_shuffles(spark):
            joined.write.parquet(path)
    return spark.read.schema(joined.schema).parquet(path)


def _joined(docs: DataFrame, key: str, text: str, width: int, percent: int, over: int) -> DataFrame:
    read = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About one shingle in eight bytes, and one key for four shingles or more, as texts of usual sizes send.
    parts = Parts(percent, over)
    buckets = max(8, int(size / 8 * max(0.25, parts.rate(USUAL_SIZE))) // BUCKET_ENTRIES)
    found = candidates(read, buckets, width, parts, frequent_shingles(read, width))
    members = found.filter(F.col("kind") == MEMBER).select("id", "n", "digest", "a", "payload", "least")
    sets = materialized(
        members.filter("id IS NOT NULL AND n > 0")
        .withColumn("row", F.monotonically_increasing_id())
        .groupBy("digest")
        .agg(F.min("row").alias("rep"), F.min("id").alias("id"), F.max("n").alias("n"), F.count("*").alias("copies"),
             F.max("a").alias("name"), F.max("payload").alias("bits"), F.max("least").alias("least")),
        "join-sets",
    )
    found_links = links(read, sets, edges_of(found, sets, percent, over), width, percent, over)
    joined = components(found_links.filter("b IS NOT NULL")).withColumnRenamed("node", "rep")
    counts = found_links.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(
        F.sum("links").alias("links")
    )
    grouped = materialized(sets.select("rep", "id").join(joined, "rep"), "join-grouped")
    lowest = grouped.groupBy("component").agg(F.min("id").alias("lowest"))
    special = materialized(
        sets.join(grouped.select("rep", "component").join(lowest, "component"), "rep", "left")
        .join(counts, "rep", "left")
        .filter("copies > 1 OR lowest IS NOT NULL")
        .select(
            "digest", F.coalesce("lowest", "id").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "join-special",
    )
    return lookup_join(members.drop("payload", "least"), special, ["digest"], "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
    )
