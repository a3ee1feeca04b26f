"""Operators that judge one text at a time, against plain Python."""

import hashlib
import random
import weakref
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import arrow, bpe, language_id, license_scan, quality_rules, queries, token_counts
from tests.llm.common import DOCS, TOKENIZERS, ascii_lower, docs, hard_rows, random_text, words_of

SMOKE = "/root/testdata/sf0.001"
WORD_BPE = f"{TOKENIZERS}/word_bpe_49k.json"
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"

TEXT_OPERATORS = {
    "bpe": lambda df, **k: bpe.encode_decode(df, WORD_BPE, **k),
    "tokens": lambda df, **k: token_counts.token_counts(df, BYTE_BPE, **k),
    "license": license_scan.license_scan,
    "quality": quality_rules.quality,
    "language": lambda df, **k: language_id.identify_split(df, **k),
}


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_one_row_per_row_for_hard_rows(spark, name):
    out = TEXT_OPERATORS[name](docs(spark), carry=["doc_id"]).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in hard_rows())


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_empty_table(spark, name):
    assert TEXT_OPERATORS[name](docs(spark, []), carry=["doc_id"]).collect() == []


@pytest.mark.parametrize("name", TEXT_OPERATORS)
def test_results_win_over_clashing_columns(spark, name):
    plain = TEXT_OPERATORS[name](docs(spark), carry=["doc_id"])
    taken = {c: F.lit("mine") for c in plain.columns if c != "doc_id"}
    clashing = docs(spark).withColumns({c.upper(): v for c, v in taken.items()} | {"block": F.lit(1)})
    out = TEXT_OPERATORS[name](clashing, carry=clashing.columns)
    assert {"block", "source"} <= set(out.columns)
    rows = out.select(plain.columns).collect()
    assert Counter(map(str, rows)) == Counter(map(str, plain.collect()))


def smoke_texts(spark):
    return [
        (r.doc_id, r.text)
        for r in spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()
    ]


def test_bpe_equals_the_library(spark):
    library = Tokenizer.from_file(WORD_BPE)
    expected = {}
    for i, text in smoke_texts(spark):
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        expected[i] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(shown.encode()).hexdigest())
    rows = queries.op8_bpe_encode_decode(spark, SMOKE).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == expected


def test_bpe_on_odd_texts():
    rng = random.Random(3)
    odd = [
        "", "aaa aaaaaaaa", "x<|endoftext|>y <|startoftext|><|endoftext|>", "ΑΣ ὈΔΥΣΣΕΎΣ İ ﬁ e\u0301",
        "\x1c\x1f\x85 z", "日本語 한국어 🎉🎉👍🏽", "it's we'LL they'd 12345 ½", "=" * 3000, "\0a \0<|endoftext|>",
        "".join(rng.choice("abcdefg") for _ in range(5000)), "<|endof<|endoftext|>",
        *["".join(chr(rng.randint(32, 0x2FF)) for _ in range(200)) for _ in range(40)],
    ]
    library = Tokenizer.from_file(WORD_BPE)
    encoder = bpe.Encoder(bpe.load_model(WORD_BPE))
    for _ in range(2):  # the second time from memory
        counts, ids, shown = encoder.encode([None, *odd])
        assert (counts[0], ids[0], shown[0]) == (0, b"", b"")
        for text, n, packed, decoded in zip(odd, counts[1:], ids[1:], shown[1:]):
            wanted = library.encode(text, add_special_tokens=False).ids
            assert packed == b"".join(x.to_bytes(4, "little") for x in wanted) and n == len(wanted)
            assert decoded.decode() == library.decode(wanted, skip_special_tokens=False)


def test_every_code_point_is_encoded_as_by_the_library():
    texts = [f"a{chr(c)}b" for c in [*range(1, 0xD800), *range(0xE000, 0x40000)]]
    library = Tokenizer.from_file(WORD_BPE)
    encoder = bpe.Encoder(bpe.load_model(WORD_BPE))
    packed = encoder.encode(texts)[1]
    wanted = library.encode_batch(texts, add_special_tokens=False)
    off = [t for t, p, w in zip(texts, packed, wanted) if p != np.array(w.ids, "<u4").tobytes()]
    assert off == []


def greedy(word: bytes, vocab: set[bytes], longest: int) -> int:
    count, at = 0, 0
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in vocab), 0)
        if not size:
            return 0
        at, count = at + size, count + 1
    return count


def test_token_counts_equal_greedy_matching(spark):
    vocab = set(token_counts.load_pieces(BYTE_BPE))
    longest = max(map(len, vocab))
    rows = queries.op7_token_counts(spark, SMOKE).collect()
    found = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in rows}
    known = {}
    for i, text in smoke_texts(spark):
        words = [w.encode() for w in words_of(text)]
        for w in set(words) - known.keys():
            known[w] = greedy(b" " + w, vocab, longest)
        assert found[i] == (len(words), sum(known[w] for w in words), 0)


def test_automaton_with_failures_and_unknown_parts():
    rng = random.Random(5)
    for _ in range(30):
        vocab = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(12)}
        automaton = token_counts.build_automaton(sorted(vocab))
        for _ in range(200):
            word = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 12)))
            assert token_counts.count_pieces(word, automaton) == greedy(word, vocab, 5), (vocab, word)


def license_words(text: str | None) -> list[str]:
    return regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def base_places(words: list[str]) -> list[tuple[int, str]]:
    out = []
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return out


def all_labels(words: list[str]) -> set[str]:
    """Bounded-error search over the whole text, without seeds."""
    text, labels = " ".join(words), set()
    for phrase, label in license_scan.NOTICES.items():
        k = len(phrase) // license_scan.CHARS_PER_EDIT
        if regex.search(rf"(?<![^ ])(?:{phrase}){{e<={k}}}(?![^ ])", text):
            labels.add(label)
    return labels


def test_license_scan_equals_whole_text_search(spark):
    rng = random.Random(11)
    rows = [(i, t, None, None) for i, t in smoke_texts(spark)]
    for i in range(120):
        phrase = list(rng.choice([*license_scan.NOTICES]))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(phrase))
            phrase[at] = rng.choice(["", rng.choice("abcxyz "), phrase[at] + rng.choice("pq")])
        cased = "".join(c.upper() if rng.random() < 0.2 else c for c in phrase)
        text = f"{random_text(rng, rng.randint(0, 6))} {cased.replace(' ', rng.choice([' ', ', ', chr(10)]))}, {random_text(rng, 3)}"
        rows.append((10_000 + i, text, None, None))
    rows += [(20_000, "MIT License mit  license\nCC-BY cc by cc by", None, None), (20_001, None, None, None)]
    found = {r.doc_id: r for r in license_scan.license_scan(docs(spark, rows), carry=["doc_id"]).collect()}
    for i, text, *_ in rows:
        r, words = found[i], license_words(text)
        places = base_places(words)
        base = {label for _, label in places}
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (
            min((p for p, _ in places), default=None), max((p for p, _ in places), default=None)
        )
        assert r.base_labels == ",".join(sorted(base))
        assert r.labels == ",".join(sorted(base | all_labels(words))), text
        assert 0 <= r.score <= 1 and (r.score == 1) == (bool(places) or any(s.edits == 0 for s in r.spans))
        for s in r.spans:
            assert 0 <= s.start_word < s.end_word <= len(words)


def test_quality_equals_plain_measures(spark):
    rng = random.Random(2)
    rows = [*hard_rows(), *[(100 + i, random_text(rng, rng.randint(0, 90), "ab"), None, None) for i in range(60)]]
    rows += [(200 + i, f"a b c # $ {'x y z ' * i}\nq\nq\r\n \n q", None, None) for i in range(6)]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    found = {r.doc_id: r for r in quality_rules.quality(docs(spark, rows), carry=["doc_id"]).collect()}
    for i, text, *_ in rows:
        words, t = words_of(text), text or ""
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {
            k + d for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)
        }
        lines = [x for x in t.split("\n") if words_of(x)]
        r = found[i]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(covered), text
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r.base_failed == failed and (not failed or not r.kept)


def test_quality_plan_has_no_python(spark):
    plan = quality_rules.quality(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_language_held_out_accuracy(spark):
    rows = queries.op5_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.filter("held_out").join(truth, "doc_id")
    n, right = held.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and right / n >= 0.98


def test_language_of_texts_without_letters_or_training(spark):
    out = {r.doc_id: r for r in language_id.identify_split(docs(spark, [
        (1, None, "en", None), (2, "12 34 !", "en", None), (3, "é", None, None), (4, "the words", "en", None),
    ])).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 4)] == ["und", "und", "en", "en"]
    assert out[1].score == 0.0
    none = language_id.identify_split(docs(spark, [(1, "words", None, None)])).collect()
    assert none[0].lang_pred == "und"


@pytest.mark.parametrize("n", [2, 3, 7, 8, 30])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert len({tuple(row) for row in code.tolist()}) == n
    assert (abs(code.sum(0)) < n).all()


def test_many_languages_are_told_apart(spark):
    rng = random.Random(4)
    letters = ["abcde", "fghij", "klmno", "pqrst", "uvwxy", "éàüöß", "abfgk", "lmpqu", "vwaeo"]
    rows = [
        (i, random_text(rng, 40, letters[i % 9]), f"l{i % 9}", None) for i in range(360)
    ]
    out = language_id.identify_split(docs(spark, rows), carry=["doc_id", "lang"]).filter("held_out").collect()
    assert len(out) > 60 and sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)


def test_schema_of_documents_is_kept(spark):
    assert docs(spark).schema == DOCS


def test_what_a_task_holds_is_freed_before_memory_is_given_back(monkeypatch):
    """A release while the task's own objects live would leave them with an idle worker."""
    class Held:
        pass

    alive, refs = [], []

    def holding():
        held = Held()
        refs.append(weakref.ref(held))
        return held

    def task(batches):
        held = holding()
        for batch in batches:
            yield held and batch

    def group(rows):
        held = holding()
        return held and rows

    monkeypatch.setattr(arrow, "release", lambda: alive.append(refs[-1]() is not None))
    assert list(arrow.released(task)(iter([1, 2]))) == [1, 2]
    assert arrow.released_group(group)([3]) == [3]
    assert alive == [False, False]
