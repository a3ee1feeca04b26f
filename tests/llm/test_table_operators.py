"""Operators over whole tables, against plain Python."""

import hashlib
import itertools
import os
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import exact_dedup, graph, mixing, ngram_join, suffix_dedup, url_filter
from millrace.runtime import SHUFFLE_CLEANUP_KEY, materialized, shared_base
from tests.llm.common import ascii_lower, docs, hard_rows, random_text, words_of

SMOKE = "/root/testdata/sf0.001"


# Mixing sources


def plain_targets(sizes, weights, share, cap):
    """Water level by bisection: targets are min(level * weight, cap * size)."""
    total = share * sum(sizes)
    low, high = 0.0, 10.0 * total + 1
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(level * w, cap * s) for s, w in zip(sizes, weights)) < total:
            low = level
        else:
            high = level
    return [min(high * w, cap * s) for s, w in zip(sizes, weights)]


def test_capped_shares():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.choice([0, rng.randint(1, 1000)]) for _ in range(rng.randint(1, 12))]
        weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
        got = mixing.capped_shares(sizes, weights, 1.5, 2)
        assert got == pytest.approx(plain_targets(sizes, weights, 1.5, 2), rel=1e-6, abs=1e-6)


def check_mix(rows, out):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, mixing.capped_shares(
        [sizes[s] for s in order], [(5.0, 2.0, 1.0)[i % 3] for i in range(len(order))], 1.5, 2)))
    taken, smallest = Counter(), defaultdict(lambda: 10**9)
    assert len(out) == len(rows)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        if r.size:
            smallest[r.source] = min(smallest[r.source], r.size)
    return taken, targets, smallest


def test_mix_of_hard_rows(spark):
    out = mixing.mix(docs(spark)).collect()
    check_mix(hard_rows(), out)
    assert Counter((r.doc_id, r.size) for r in out) == Counter(
        (r[0], len(words_of(r[1]))) for r in hard_rows()
    )
    assert mixing.mix(docs(spark, [])).collect() == []


def test_mix_comes_near_targets_and_reruns_agree(spark):
    rng = random.Random(9)
    rows = [
        (i, random_text(rng, int(rng.paretovariate(1.1) * 5) % 900), None, "hot" if i % 3 else f"s{i % 5}")
        for i in range(900)
    ]
    out = mixing.mix(docs(spark, rows)).collect()
    taken, targets, smallest = check_mix(rows, out)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 2 + smallest[s]
    again = mixing.mix(docs(spark, rows[::-1]).repartition(7)).collect()
    assert {r.doc_id: r.copies for r in again} == {r.doc_id: r.copies for r in out}


def test_rates_solve_the_dual(spark):
    rng = random.Random(8)
    sizes = {s: [rng.randint(0, 400) for _ in range(60)] for s in range(3)}
    sources = [
        mixing.Source(str(s), 60, sum(v), target=t * sum(v))
        for (s, v), t in zip(sizes.items(), (0.3, 1.2, 1.9))
    ]
    rows = [(s, n, c) for s, v in sizes.items() for n, c in Counter(v).items()]
    mixing.solve(spark.createDataFrame(rows, "s int, size long, n long"), sources, 2)
    for s, source in zip(sizes.values(), sources):
        x = np.array(s) / (source.size / 60)
        r = mixing.rates(x, source.tilt, 2)
        assert (r * s).sum() == pytest.approx(source.target, rel=1e-6)


def test_mixed_documents_repeat_rows(spark):
    rows = [r for r in hard_rows() if r[0] is not None]
    decided = Counter()
    for r in mixing.mix(docs(spark, rows)).collect():
        decided[r.doc_id, r.size] += r.copies
    out = mixing.mixed_documents(docs(spark, rows))
    assert out.columns == docs(spark, rows).columns
    assert Counter((r.doc_id, len(words_of(r.text))) for r in out.collect()) == +decided


def test_equal_rows_come_near_their_target(spark):
    """1,000 equal rows of a source whose target lies between one and two copies of all."""
    same = "ten words in a text that every row has alike"
    rows = [(1, same, None, "a")] * 1000 + [(i, same, None, "b") for i in range(2, 1500)]
    out = mixing.mix(docs(spark, rows)).collect()
    taken, targets, smallest = check_mix(rows, out)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 2 + smallest[s]
    # Equal rows of one id may differ in a column the mix does not read.
    mixed = [(i, t, str(n % 3), s) for n, (i, t, _, s) in enumerate(rows)]
    made = mixing.mixed_documents(docs(spark, mixed))
    assert made.columns == docs(spark, []).columns
    decided = Counter()
    for r in out:
        decided[r.doc_id] += r.copies
    got = made.collect()
    assert Counter(r.doc_id for r in got) == +decided
    most = Counter((r.doc_id, r.lang) for r in got)
    rows_of = Counter((i, lang) for i, _, lang, _ in mixed)
    assert all(n <= 2 * rows_of[k] for k, n in most.items())


def test_a_run_of_equal_rows_is_split():
    rows = pd.DataFrame({"size": [10, 10, 0], "rate": [1.25, 0.4, 1.0], "n": [1000, 5, 3], "u1": [1, 2, 3], "u2": [1, 2, 3]})
    out = mixing.round_copies(rows, 2)
    assert out[["low", "more"]].values.tolist() == [[1, 250], [0, 2], [1, 0]]


# Suffix-array dedup


def plain_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in regex.finditer(b"\1+", bytes(gone))]
        yield len(t), spans, bytes(c for c, g in zip(t, gone) if not g)


@pytest.mark.parametrize("length", [5, 20, 60])
def test_removed_bytes_equal_brute_force(spark, length):
    rng = random.Random(length)
    passages = [random_text(rng, rng.randint(4, 25)) for _ in range(10)]
    rows = []
    for i in range(140):
        parts = [
            rng.choice(passages)[rng.randint(0, 9):] if rng.random() < 0.4 else random_text(rng, rng.randint(1, 15))
            for _ in range(rng.randint(0, 7))
        ]
        rows.append((i, "".join(parts), None, None))
    rows += [(200, None, None, None), (201, "", None, None), (202, "a" * 500, None, None),
             (203, "ab" * 300, None, None), (204, "a" * length, None, None), (205, rows[5][1], None, None)]
    out = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept))
           for r in suffix_dedup.remove_repeats(docs(spark, rows).repartition(5), length=length).collect()}
    wanted = plain_repeats([(r[1] or "").encode() for r in rows], length)
    assert out == {r[0]: w for r, w in zip(rows, wanted)}


def test_removed_bytes_of_documents(spark):
    table = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    rows = table.collect()
    out = {r.doc_id: (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept))
           for r in suffix_dedup.remove_repeats(table).collect()}
    wanted = plain_repeats([(r.text or "").encode() for r in rows], 400)
    assert out == {r.doc_id: w for r, w in zip(rows, wanted)}


def test_suffix_dedup_of_hard_rows_and_empty_table(spark):
    out = suffix_dedup.remove_repeats(docs(spark), length=30).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in hard_rows())
    assert suffix_dedup.remove_repeats(docs(spark, [])).collect() == []


@pytest.mark.parametrize("q", [2, 3, 5, 7, 11, 17])
def test_covers_hold_every_difference(q):
    v, cover = q * q + q + 1, suffix_dedup.singer_cover(q)
    assert len(cover) == q + 1
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))


# N-gram Jaccard join


def plain_shingles(text):
    w = words_of(ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)])


def plain_join(rows):
    sets = [plain_shingles(r[1]) for r in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= 90 * len(a | b):
                links[i] += 1
                links[j] += 1
                up[top(i)] = top(j)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            smallest[top(i)] = min(smallest.get(top(i), r[0]), r[0])
    return Counter(
        (r[0], len(sets[i]), None if r[0] is None else smallest[top(i)], None if r[0] is None else links[i])
        for i, r in enumerate(rows)
    )


def near_copies(seed):
    rng = random.Random(seed)
    rows = []
    for g in range(25):
        words = random_text(rng, rng.choice([2, 4, 12, 14, 25, 60, 150, 300])).split()
        for _ in range(rng.randint(1, 7)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 999)}"
            if rng.random() < 0.3:
                copy = copy[: max(1, int(len(copy) * rng.uniform(0.85, 1)))]
            text = " ".join(copy)
            rows.append((len(rows), text.upper() if rng.random() < 0.2 else text, None, None))
    rng.shuffle(rows)
    return rows


def join_rows(out):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in out.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join_equals_brute_force(spark, seed):
    rows = near_copies(seed)
    assert join_rows(ngram_join.similarity_join(docs(spark, rows).repartition(4))) == plain_join(rows)


def test_join_of_hard_rows(spark):
    rows = [r for r in hard_rows()]
    got = join_rows(ngram_join.similarity_join(docs(spark, rows)))
    assert got == plain_join(rows)
    assert ngram_join.similarity_join(docs(spark, [])).collect() == []


def test_join_with_split_chains(spark, monkeypatch):
    """Chains larger than a block: blocks meet in pairs."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 300)
    rows = near_copies(4)
    assert join_rows(ngram_join.similarity_join(docs(spark, rows))) == plain_join(rows)


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(0)
    parts = ngram_join.Parts(90, 100)
    tried = 0
    for size in (10, 11, 19, 20, 40, 63, 64, 70, 120, 400, 1500):
        for _ in range(60):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            out = rng.integers(0, size // 9 + 1)
            gone = rng.integers(0, out + 1)
            b = np.unique(np.r_[rng.permutation(a)[gone:], rng.integers(0, 2**64, out - gone, dtype=np.uint64)])
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 90 * (len(a) + len(b) - shared):
                tried += 1
                assert len(np.intersect1d(parts.keys(a), parts.keys(b)))
    assert tried > 300


def test_poor_sets_share_keys_of_empty_parts():
    parts = ngram_join.Parts(90, 100)
    crowded = np.arange(1, 65, dtype=np.uint64)  # all in the first part
    assert np.intersect1d(parts.keys(crowded), parts.keys(crowded + np.uint64(3))).size


def test_linked_sets_share_a_key_whatever_is_frequent():
    rng = np.random.default_rng(1)
    parts = ngram_join.Parts(80, 100)
    tried = 0
    for size in (9, 16, 40, 64, 150, 700):
        for share in (0.05, 0.5, 0.9, 1.0):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                out = rng.integers(0, size // 4 + 1)
                b = np.unique(np.r_[rng.permutation(a)[out // 2 :], rng.integers(0, 2**64, out // 2, dtype=np.uint64)])
                shared = len(np.intersect1d(a, b))
                frequent = np.sort(rng.permutation(np.union1d(a, b))[: int(share * size)])
                if 100 * shared >= 80 * (len(a) + len(b) - shared):
                    tried += 1
                    assert len(np.intersect1d(parts.keys(a, frequent), parts.keys(b, frequent)))
    assert tried > 300


def test_parts_of_a_common_line_send_no_key():
    rng = np.random.default_rng(3)
    parts = ngram_join.Parts(80, 100)
    line = np.unique(rng.integers(0, 2**64, 12, dtype=np.uint64))
    sets = [np.union1d(line, rng.integers(0, 2**64, 140, dtype=np.uint64)) for _ in range(2000)]

    def met(frequent):
        keys = np.concatenate([np.unique(parts.keys(s, frequent)) for s in sets])
        return np.count_nonzero(np.unique(keys, return_counts=True)[1] > 1)

    assert met(ngram_join.NONE) > 10 * met(line)


def common_line_rows():
    """Near copies, and texts that share a line with all others and little else."""
    rng = random.Random(11)
    line = random_text(rng, 12)
    rows = [(i, f"{t}\n{line}" if i % 2 else t, None, None) for i, t, _, _ in near_copies(5)]
    return rows + [(1000 + i, f"{line} {random_text(rng, 25)} {line}", None, None) for i in range(40)]


def test_frequent_shingles_are_counted_over_all_documents(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", 3)
    monkeypatch.setattr(ngram_join, "LOT_SHINGLES", 500)
    rows = common_line_rows()
    got = set(ngram_join.frequent_shingles(docs(spark, rows).repartition(3), 3).tolist())
    counts = Counter(s for r in rows for s in ngram_join.shingle_sets([r[1].encode()])[0].tolist())
    least = len(rows) / 4
    assert {s for s, n in counts.items() if n >= least} <= got
    assert got <= {s for s, n in counts.items() if n >= len(rows) // 8}
    assert not len(ngram_join.frequent_shingles(docs(spark, []), 3))


@pytest.mark.parametrize("most", [5, 1 << 17])
def test_join_with_a_common_line(spark, monkeypatch, most):
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", 3)
    monkeypatch.setattr(ngram_join, "FREQUENT_MOST", most)
    rows = common_line_rows()
    assert join_rows(ngram_join.similarity_join(docs(spark, rows).repartition(4))) == plain_join(rows)


def test_parity_bits_lose_no_link_and_tell_chance_pairs_apart():
    rng = np.random.default_rng(12)
    linked, apart = 0, 0
    for size in (1, 2, 9, 31, 33, 64, 300, 1500):
        for _ in range(60):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            out, added = rng.integers(0, size // 8 + 1), rng.integers(0, size // 8 + 1)
            b = np.unique(np.r_[rng.permutation(a)[out:], rng.integers(0, 2**64, added, dtype=np.uint64)])
            other = np.unique(np.r_[a[: size // 3], rng.integers(0, 2**64, size - size // 3, dtype=np.uint64)])
            sets = [a, b, a, other]
            sizes, bits = np.array([*map(len, sets)]), [ngram_join.parity(s) for s in sets]
            near, far = ngram_join.may_link(sizes[::2], sizes[1::2], bits[::2], bits[1::2], 80, 100)
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 80 * (len(a) + len(b) - shared):
                linked += 1
                assert near
            apart += size >= 64 and not far
    assert linked > 300 and apart == 180


def test_hot_keys_make_chains_and_others_pairs():
    keys = np.repeat(np.array([1 << 8 | 3, 2 << 8 | 4, 3 << 8 | 4], np.uint64), [3, 20, 1])
    names = np.r_[[7, 5, 7], np.arange(20)[::-1], 9]
    (a, b), (name, low, kind), times = ngram_join.met_names(keys, names)
    assert [*zip(a.tolist(), b.tolist())] == [(5, 7)]
    assert sorted(zip(name.tolist(), low.tolist(), kind.tolist(), times.tolist())) == [(i, 0, 4, 1) for i in range(20)]
    assert all(not len(x) for x in ngram_join.met_names(keys[:0], names[:0])[0])


def test_chance_matches_make_no_chains(spark, monkeypatch):
    """Texts that share half of their words, and a passage of many texts: candidates, but no edges."""
    monkeypatch.setattr(ngram_join, "PAIRED_SETS", 4)
    rng = random.Random(21)
    passage = random_text(rng, 8)
    rows = [(i, f"{passage}\n{random_text(rng, 80)}", None, None) for i in range(150)]
    rows += [(1000 + i, " ".join([*r[1].split()[:60], random_text(rng, 40)]), None, None) for i, r in enumerate(rows)]
    edges, whole = [], ngram_join.edges_of

    def counted(*args):
        edges.append(whole(*args))
        assert not edges[-1].count()
        return edges[-1]

    monkeypatch.setattr(ngram_join, "edges_of", counted)
    assert join_rows(ngram_join.similarity_join(docs(spark, rows).repartition(4))) == plain_join(rows)
    assert len(edges) == 1


@pytest.mark.parametrize("paired", [1, 3])
def test_join_by_hot_keys(spark, monkeypatch, paired):
    """Keys of more sets than are paired lead to the same links."""
    monkeypatch.setattr(ngram_join, "PAIRED_SETS", paired)
    monkeypatch.setattr(ngram_join, "LOT_KEYS", 500)
    for rows in (near_copies(8), common_line_rows()):
        assert join_rows(ngram_join.similarity_join(docs(spark, rows).repartition(4))) == plain_join(rows)


def test_scratch_and_shuffle_files_go_with_their_work(spark, tmp_path):
    base = f"{shared_base(spark)}/millrace"
    before = {*os.listdir(base)} if os.path.exists(base) else set()
    rows = near_copies(9)
    kept = exact_dedup.survivors(docs(spark, rows + rows))
    left = {n.rsplit("-", 1)[0] for n in {*os.listdir(base)} - before}
    assert left == {"dedup-repeated"} and kept.count() == len({r[1] for r in rows})
    assert spark.conf.get(SHUFFLE_CLEANUP_KEY) == "false"
    shuffled = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = shuffles.shuffleStatuses().size()
    assert materialized(shuffled, "freed").count() == 7
    assert shuffles.shuffleStatuses().size() <= held + 1  # that of the count above, none of the table


def test_merge_skip_equals_counting():
    rng = random.Random(2)
    for _ in range(300):
        lists = [sorted(rng.sample(range(30), rng.randint(0, 20))) for _ in range(rng.randint(1, 9))]
        least = rng.randint(1, len(lists))
        counts = Counter(i for ids in lists for i in ids)
        wanted = sorted((i, n) for i, n in counts.items() if n >= least)
        assert [*zip(*ngram_join.merge_skip(lists, least))] == wanted


@pytest.mark.parametrize("heap_entries", [0, 1 << 20])
def test_divide_skip_equals_pairwise(monkeypatch, heap_entries):
    monkeypatch.setattr(ngram_join, "HEAP_ENTRIES", heap_entries)
    rng = np.random.default_rng(6)
    base = [np.unique(rng.integers(0, 2**64, rng.integers(1, 200), dtype=np.uint64)) for _ in range(10)]
    sets = []
    for b in base:
        for _ in range(15):
            k = rng.integers(0, max(1, len(b) // 6))
            sets.append(np.unique(np.r_[rng.permutation(b)[k:], rng.integers(0, 2**64, k, dtype=np.uint64)]))
    sets = sorted((s for s in sets if len(s)), key=len)
    side = np.array([i % 2 + 1 for i in range(len(sets))])
    copies = np.array([1 + i % 3 for i in range(len(sets))])
    for sides in (None, side):
        found = ngram_join.linked_in_block(sets, copies=copies, side=sides)
        counts, up = [0] * len(sets), [*range(len(sets))]
        for i, j in itertools.combinations(range(len(sets)), 2):
            shared = len(np.intersect1d(sets[i], sets[j]))
            linked = 100 * shared >= 90 * (len(sets[i]) + len(sets[j]) - shared)
            if linked and (sides is None or sides[i] != sides[j]):
                counts[i] += copies[j]
                counts[j] += copies[i]
                up = [min(up[i], up[j]) if x in (up[i], up[j]) else x for x in up]
        assert found.counts.tolist() == counts and any(counts)
        ours = [*range(len(sets))]
        for i, j in found.pairs:
            ours = [min(ours[i], ours[j]) if x in (ours[i], ours[j]) else x for x in ours]
        assert ours == up and len(found.pairs) == len(sets) - len(set(up))


def test_a_large_group_of_near_copies_keeps_memory_flat():
    """Sets of 20 shingles, 19 of them common: every pair is linked, none is stored."""
    rng = np.random.default_rng(8)
    common = np.unique(rng.integers(0, 2**64, 19, dtype=np.uint64))
    sets = [np.sort(np.r_[common, rng.integers(0, 2**64, 1, dtype=np.uint64)]) for _ in range(4000)]
    tracemalloc.start()
    found = ngram_join.linked_in_block(sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(found.counts.tolist()) == {3999} and len(found.pairs) == 3999
    assert peak < 40e6


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(9, 9)]
    edges += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(90)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = sorted((top(a), top(b)))
        up[q] = p
    linked = {x for e in edges if e[0] != e[1] for x in e}
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in linked}


# Exact dedup


def plain_dedup(rows):
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[r[1] or ""].append(i)
    out = Counter()
    for text, members in groups.items():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        keep = max(ids, default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        stays = 1
        for i in sorted(members, key=lambda i: rows[i][0] != keep):
            out[rows[i][0], keep, len(members), bool(stays), sha] += 1
            stays = 0
    return out


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.length(t).cast("string")])
def test_dedup_equals_plain_groups(spark, digest):
    """Also with a digest that different texts share: then the bytes decide."""
    rng = random.Random(5)
    rows = hard_rows() + [(100 + i, f"text {rng.randint(0, 30)}", None, None) for i in range(90)]
    rng.shuffle(rows)
    out = exact_dedup.dedup(docs(spark, rows).repartition(6), digest=digest)
    assert Counter(map(tuple, out.collect())) == plain_dedup(rows)


def test_dedup_of_empty_table(spark):
    assert exact_dedup.dedup(docs(spark, [])).collect() == []


def test_dedup_state_goes_on_with_new_files(spark, tmp_path):
    out, seen = str(tmp_path / "state"), str(tmp_path / "in")

    def arrive(first, n):
        rows = spark.range(first, first + n).selectExpr("id AS locator", "id AS key", "cast(id % 4 AS string) AS digest")
        rows.write.mode("append").parquet(seen)
        exact_dedup.run_stream(spark, seen, rows.schema, out, str(tmp_path / "checkpoint"), 2, 2)
        return {r.digest: (r.key, r.group_size) for r in exact_dedup.latest_state(spark, out).collect()}

    assert arrive(0, 6) == {"0": (4, 2), "1": (5, 2), "2": (2, 1), "3": (3, 1)}
    assert arrive(6, 3) == {"0": (8, 3), "1": (5, 2), "2": (6, 2), "3": (7, 2)}


def test_survivors_keep_one_row_of_each_text(spark):
    out = exact_dedup.survivors(docs(spark)).collect()
    assert sorted((r.text or "") for r in out) == sorted({r[1] or "" for r in hard_rows()})
    keep = {t: max((r[0] for r in hard_rows() if (r[1] or "") == t and r[0] is not None)) for t in {r[1] or "" for r in hard_rows()}}
    assert {r.text or "": r.doc_id for r in out} == keep


# URL filter


def plain_host_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = regex.match(r"[^/?#]*", rest).group()
    return ascii_lower(host), regex.match(r"[^?#]*", rest[len(host):]).group()


def plain_rule(host, path):
    fit = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


PAGES = "page_id long, url string, html string"


def link(*hosts):
    return "".join(f'<a href="https://{h}/x">y</a>' for h in hosts) + '<a href="/local">z</a>'


def plain_walk(edges, seeds, damping=0.85):
    hosts = sorted({h for e in edges for h in e[:2]} | set(seeds))
    place = {h: i for i, h in enumerate(hosts)}
    w = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        w[place[a], place[b]] += n
    out = w.sum(1)
    s = np.array([seeds.get(h, 0.0) for h in hosts])
    s /= s.sum()
    x = s.copy()
    for _ in range(400):
        passed = (x / np.where(out > 0, out, 1)) @ w
        x = (1 - damping) * s + damping * (passed + (1 - passed.sum()) * s)
    return dict(zip(hosts, x))


def url_pages():
    return [
        (1, "https://good.org/a", link("friend.net", "other.net")),
        (2, "https://friend.net/a", link("far.net", "FRIEND.net", "user@far.net:8080")),
        (3, "http://bad.com/de/1", link("good.org")),
        (4, "http://shill.net/", link("bad.com", "bad.com") + "<A HREF='//bad.com/q'>"),
        (5, "http://feeder.net/x?q#f", link("shill.net", "far.net")),
        (6, "http://far.net", link()), (7, None, None), (8, "no scheme", link("bad.com")),
        (9, "HTTP://WWW.Example.ORG/es/1", ""), (10, "x://example.org/en/12", None),
        (11, "x://example.org", ""), (12, "x://notorg/", ""), (13, "x://a.com/fr/", ""), (13, "x://a.com/fr/", ""),
    ]


def test_urls_rules_and_scores(spark):
    pages = spark.createDataFrame(url_pages(), PAGES)
    out = url_filter.judge_urls(pages, tolerance=1e-12).collect()
    edges = {tuple(e[:2]): e[2] for e in url_filter.host_edges(pages).collect()}
    assert edges == {
        ("good.org", "friend.net"): 1, ("good.org", "other.net"): 1, ("friend.net", "far.net"): 2,
        ("bad.com", "good.org"): 1, ("shill.net", "bad.com"): 1, ("feeder.net", "shill.net"): 1,
        ("feeder.net", "far.net"): 1,
    }
    seeds = {"allow": Counter(), "block": Counter()}
    for _, url, _ in url_pages():
        host, path = plain_host_path(url)
        rule = plain_rule(host, path)
        if rule:
            seeds[rule.verdict][host] += 1
    listed = [(a, b, n) for (a, b), n in edges.items()]
    trust = plain_walk(listed, seeds["allow"])
    distrust = plain_walk([(b, a, n) for a, b, n in listed], seeds["block"])
    assert len(out) == len(url_pages())
    urls = {p[0]: p[1] for p in url_pages()}
    for r in out:
        host, path = plain_host_path(urls[r.page_id])
        rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.trust == pytest.approx(trust.get(host, 0.0), abs=1e-9)
        assert r.distrust == pytest.approx(distrust.get(host, 0.0), abs=1e-9)
        by_links = "block" if r.distrust > r.trust else "allow"
        assert r.verdict == (rule.verdict if rule else by_links)
    verdicts = {r.page_id: r.verdict for r in out}
    assert verdicts[4] == "block" and verdicts[2] == "allow" and verdicts[5] == "block"


def test_urls_of_empty_table(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], PAGES)).collect() == []


def test_urls_with_ports_and_users_share_the_score_of_their_host(spark):
    pages = spark.createDataFrame([
        (1, "https://good.org:8443/a", link("h.net:8080")), (2, "http://h.net:8080/", link("far.net", "h.net")),
        (3, "http://user@far.net/", ""), (4, "http://bad.com:8080/de/1", ""), (5, "http://x@good.org/a", ""),
        (6, "http://shill.net:81/", link("bad.com")), (7, "http://u:p@feeder.net:82/", link("shill.net")),
        (8, "http://bad.com/other", ""),
    ], PAGES)
    assert {tuple(e) for e in url_filter.host_edges(pages).collect()} == {
        ("good.org", "h.net", 1), ("h.net", "far.net", 1), ("shill.net", "bad.com", 1), ("feeder.net", "shill.net", 1),
    }
    rules = [*url_filter.RULES, url_filter.UrlRule("allow", "good.org:8443", "/"), url_filter.UrlRule("block", "bad.com:8080", "/")]
    out = {r.page_id: r for r in url_filter.judge_urls(pages, rules=rules).collect()}
    assert [out[i].host for i in (1, 2, 3, 7)] == ["good.org:8443", "h.net:8080", "user@far.net", "u:p@feeder.net:82"]
    assert out[2].trust > 0 and out[3].trust > 0 and out[6].distrust > 0 and out[7].distrust > 0
    assert (out[1].trust, out[4].distrust) == (out[5].trust, out[8].distrust)
    assert {i: r.verdict for i, r in out.items()} == {
        1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "block", 7: "block", 8: "block",
    }


# Pipeline


def test_stages_keep_columns_and_take_effect(spark):
    table = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = [tuple(r) for r in table.limit(60).collect()]
    extra = [(9001, None, "en", "src0", 0), (9002, "12 34", "en", "src0", 5), (9003, rows[0][1], "en", "src0", 1)]
    start = spark.createDataFrame([*rows, *extra], table.schema)
    seen, frame = {}, start
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, frame, SMOKE)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.schema.names == start.schema.names
        frame = spark.createDataFrame(made.collect(), made.schema)
        seen[name] = frame
    languages = {r.doc_id for r in seen["language_id"].collect()}
    assert languages == {r[0] for r in [*rows, *extra]} - {9001, 9002}
    exact = seen["exact_dedup"].collect()
    assert Counter(r.text for r in exact) == Counter({r.text for r in seen["language_id"].collect()})
    near = {r.doc_id for r in seen["ngram_join"].collect()}
    groups = plain_join([tuple(r) for r in exact])
    assert near == {d for d, _, c, _ in groups if d == c}
    mixed = Counter(r.doc_id for r in seen["source_mix"].collect())
    assert set(mixed) <= near and max(mixed.values()) <= 2
    assert Counter(r.doc_id for r in seen["bpe"].collect()) == mixed


def plain_jaccard(a, b, width):
    a, b = (words_of(ascii_lower(t)) for t in (a, b))
    a, b = ({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} for w in (a, b))
    return len(a & b) / len(a | b)


def changed(rng, n, places):
    """A text of n distinct words, and the same with single words changed, far from one another."""
    words = [f"w{rng.getrandbits(40)}" for _ in range(n)]
    copy = list(words)
    for k in range(places):
        copy[(2 * k + 1) * n // (2 * places)] = f"c{k}"
    return " ".join(words), " ".join(copy)


def test_near_stage_takes_five_words_and_eighty_percent(spark):
    rng, rows, expected = random.Random(11), [], set()
    for n, places in [(200, 4), (400, 8), (200, 5), (400, 9), (200, 1), (60, 1), (50, 1), (1000, 40)]:
        base, copy = changed(rng, n, places)
        rows += [(len(rows), base, "en", "a"), (len(rows) + 1, copy, "en", "a")]
        expected.add(rows[-2][0])
        if plain_jaccard(base, copy, 5) < 0.8:
            expected.add(rows[-1][0])
    for a, b in ((0, 1), (2, 3)):
        assert plain_jaccard(rows[a][1], rows[b][1], 5) >= 0.8 and plain_jaccard(rows[a][1], rows[b][1], 3) < 0.9
    left = corpus_pipeline.one_of_each_group(spark, docs(spark, rows), SMOKE)
    assert {r.doc_id for r in left.collect()} == expected
    assert {0, 2} <= expected and 1 not in expected and 3 not in expected and 5 in expected


def test_near_stage_removes_rows_of_a_repeated_id_by_their_texts(spark):
    rng = random.Random(12)
    pairs = [changed(rng, 200, 4) for _ in range(4)]
    alone = [changed(rng, 100, 1)[0] for _ in range(2)]
    rows = [
        (1, pairs[0][0]), (2, pairs[0][1]), (2, alone[0]),  # a near copy beside an unrelated text
        (3, pairs[1][0]), (3, pairs[1][1]), (3, alone[1]),  # near copies of one id
        (4, pairs[2][0]), (4, pairs[2][0].upper()),  # one set of shingles, one id
        (5, pairs[3][0]), (5, pairs[3][0]), (6, pairs[3][1]),  # equal rows
        (7, None), (7, ""), (None, pairs[0][0]),
    ]
    groups = [{(1, pairs[0][0])}, {(2, alone[0])}, {(3, t) for t in pairs[1]}, {(3, alone[1])},
              {(4, pairs[2][0]), (4, pairs[2][0].upper())}, {(5, pairs[3][0])}, {(7, None)}, {(7, "")},
              {(None, pairs[0][0])}]
    table = docs(spark, [(*r, "en", "a") for r in rows])
    picks = []
    for parts in (1, 5):
        left = corpus_pipeline.one_of_each_group(spark, table.repartition(parts), SMOKE).collect()
        assert len(left) == len(groups)
        assert all(sum((r.doc_id, r.text) in g for r in left) == 1 for g in groups)
        picks.append({(r.doc_id, r.text) for r in left})
    assert picks[0] == picks[1]


@pytest.mark.parametrize("seed", [1, 2])
def test_join_of_five_words_equals_brute_force(spark, seed):
    rows = near_copies(seed)
    sets = [words_of(ascii_lower(r[1])) for r in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in sets]
    links = {
        rows[i][0]: sum(
            100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets) if i != j
        )
        for i, a in enumerate(sets)
    }
    out = ngram_join.similarity_join(docs(spark, rows), width=5, percent=80).collect()
    assert {r.doc_id: r.n_links for r in out} == links


def test_pipeline_runs_on_all_documents(spark):
    out = corpus_pipeline.run(spark, SMOKE)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert out.filter("length(ids) != 4 * n_tokens").count() == 0 and out.count() > 0
