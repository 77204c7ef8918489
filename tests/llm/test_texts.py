"""Operators on single texts: token counts, quality rules, BPE, LM scores."""

import hashlib
import re
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from workwindow.llm import bpe, lm_scores, quality, token_counts
from workwindow.llm.common import text_buffers, tokenizer

ODD = [
    None,
    "",
    " \n\t ",
    "one",
    "x" * 100_000,
    "!?" * 20_000,
    "it's we'll CAN'T ÉCOLE ΑΣ naïve\x0b日本語 12½Ⅷ",
    "<|endoftext|> a<|startoftext|>b <|endof Ᲊ",
    "a b c d e f a b c d e f\na b c d e f\n\n x|y #tag $5",
    "long " * 30_000,
]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# token counts


def greedy(pieces: set[bytes], word: bytes) -> int:
    word, n = b" " + word, 0
    while word:
        cut = next((k for k in range(min(len(word), 40), 0, -1) if word[:k] in pieces), 0)
        if not cut:
            return 1
        word, n = word[cut:], n + 1
    return n


def test_token_counts_are_those_of_the_longest_match(spark, docs):
    pieces = token_counts.read_ranks(tokenizer("byte_bpe_50k.tiktoken"))
    known = set(pieces)
    texts = [t for t in ODD if t is None or len(t) < 50_000] + ["repeated", "repeated"]
    found = token_counts.token_counts(docs(enumerate(texts), more=True), pieces)
    want = [
        (i, len((t or "").encode().split()), sum(greedy(known, w) for w in (t or "").encode().split()))
        for i, t in enumerate(texts)
    ]
    assert rows_of(found, "doc_id", "n_words", "n_tokens") == sorted(want, key=str)
    assert token_counts.token_counts(docs([]), pieces).count() == 0


def test_failure_links_cut_what_cannot_go_on():
    automaton = token_counts.Automaton.compile([b" a", b" abcx", b"b", b"bcy", b"c", b"z"])
    automaton = token_counts.Automaton.load(automaton.dump())
    assert [automaton.count(w) for w in (b"abcx", b"abcy", b"abcz", b"abq", b"q")] == [1, 2, 4, 1, 1]


# quality rules


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, again = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def test_base_rules_and_their_verdict(docs, prose):
    texts = [*ODD, *(prose(i) for i in range(5)), prose(1)]
    found = quality.judge(docs(enumerate(texts), more=True), quality.Field.all_content())
    for row in found.collect():
        want = base_counts(texts[row.doc_id])
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert got == want
        assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert row.kept == (not row.base_failed)
    assert quality.judge(docs([]), quality.Field.all_content()).count() == 0


def test_viterbi_finds_the_best_labelling():
    random = np.random.default_rng(1)
    field = quality.Field(random.normal(size=3), random.normal(size=(2, 2)), random.normal(size=2))
    lengths = [1, 4, 2, 7]
    row = np.repeat(np.arange(4), lengths)
    features = random.normal(size=(len(row), 3))
    labels = field.viterbi(row, features)
    for r, n in enumerate(lengths):
        x = features[row == r] @ field.emission

        def score(y):
            inside = sum(field.transition[a, b] for a, b in zip(y, y[1:]))
            return field.first[y[0]] + inside + sum(s for s, one in zip(x, y) if one)

        best = max((tuple(map(int, f"{k:0{n}b}")) for k in range(2**n)), key=score)
        assert tuple(labels[row == r]) == best


def test_training_lines_come_from_the_whole_of_a_text():
    random = np.random.default_rng(2)
    starts = set()
    for _ in range(60):
        lines = random.normal(size=(200, 3)).astype("<f4")
        part = quality.stretch(lines)
        assert len(part) == quality.SAMPLE_LINES and quality.stretch(lines).tolist() == part.tolist()
        starts.add(int(np.flatnonzero((lines == part[0]).all(1))[0]))
    assert min(starts) < 40 and max(starts) > 130
    assert quality.stretch(lines[:32]) is not None and len(quality.stretch(lines[:5])) == 5


def test_labelled_documents_teach_the_field(spark, docs, prose):
    junk = ["\n".join(" | ".join(prose(i, 1).split()) for _ in range(4)) for i in range(60)]
    texts = [*(prose(i) for i in range(60)), *junk]
    labels = spark.createDataFrame(
        [(i, int(i < 60)) for i in range(120) if i % 3] + [(None, 1), (5, None), (999, 0)],
        "doc_id bigint, quality int",
    )
    documents = docs(enumerate(texts))
    field = quality.train(documents, labels)
    kept = {r.doc_id for r in quality.judge(documents, field).filter("kept").collect()}
    held_out = {i for i in range(120) if i % 3 == 0}
    assert kept & held_out == {i for i in held_out if i < 60}
    nothing = quality.train(documents, labels.filter("false"))
    assert nothing.emission[0] > 0
    stay = quality.keep_good(docs([*enumerate(texts), (7, None)], more=True), field)
    assert {r.doc_id for r in stay.collect()} == kept and len(stay.columns) == 20


# BPE


@pytest.fixture(scope="module")
def path():
    return tokenizer("word_bpe_49k.json")


def test_bpe_is_the_library_exactly(docs, path, prose):
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    texts = [*ODD, *(prose(i) for i in range(20)), prose(3)]
    found = {r.doc_id: r for r in bpe.encode_documents(docs(enumerate(texts), more=True), path).collect()}
    digests = {r.doc_id: r for r in bpe.encode_digests(docs(enumerate(texts)), path).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (found[i].ids, found[i].decoded) == (ids, decoded)
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_digests(docs([]), path).count() == 0


def test_lexicon_is_minimal_and_exact():
    words = sorted(a + b for a in (b"walk", b"talk", b"stalk") for b in (b"", b"s", b"ed", b"ing"))
    entries = {w: [i, i + 1] for i, w in enumerate(words)}
    lexicon = bpe.Lexicon(bpe.Lexicon.compile(entries.items()))
    assert all(lexicon.find(w) == ids for w, ids in entries.items())
    assert lexicon.find(b"walke") is None and lexicon.find(b"") is None and lexicon.find(b"walkings") is None
    assert len(lexicon.finals) < 20  # the endings are shared
    assert bpe.Lexicon(bpe.Lexicon.compile([])).find(b"a") is None


def test_short_and_long_merges_agree(path):
    merges = bpe._parsed(path)
    for word in ("internationalisation", "aaaaaaaaaaaaaaaaaaaaaaa", "straße", "thethethethe"):
        start = [merges.first[b] for b in word.encode()[:-1]] + [merges.last[word.encode()[-1]]]
        assert merges._merge_short(list(start)) == merges._merge_long(list(start))


# LM scores


def brute_scores(texts, order=2):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]

    def grams(w, k):
        padded = [0] * (k - 1) + w
        return Counter(tuple(padded[i : i + k]) for i in range(len(w)))

    own = [[Counter(), *(grams(w, k) for k in range(1, order + 1))] for w in words]
    for w, counts in zip(words, own):
        for k in range(1, order):
            counts[k][(0,) * k] += bool(w)
    everywhere = [sum((counts[k] for counts in own), Counter()) for k in range(order + 1)]
    total = sum(map(len, words))
    out = []
    for w, counts in zip(words, own):
        rest = [Counter({g: n - counts[k][g] for g, n in everywhere[k].items()}) for k in range(order + 1)]
        score, backed = 0.0, 0
        for i in range(len(w)):
            gram = tuple(([0] * (order - 1) + w)[i : i + order])
            k = next((k for k in range(order, 1, -1) if rest[k][gram[order - k :]] > 0), 1)
            gram = gram[order - k :]
            score += (order - k) * log(0.4) + (
                log(rest[k][gram] / rest[k - 1][gram[:-1]]) if k > 1 else log(max(rest[1][gram], 1) / total)
            )
            backed += k < order
        out.append((len(w), backed, round(score, 6)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_leave_the_own_text_out(docs, prose, order):
    texts = [None, "", "one", "the the the", *(prose(i) for i in range(12)), prose(2), "x " * 3000]
    found = lm_scores.lm_scores(docs(enumerate(texts), more=True), order, slice_bytes=500, part_bytes=900)
    found = {r.doc_id: r for r in found.collect()}
    for i, want in enumerate(brute_scores(texts, order)):
        got = (found[i].n_words, found[i].n_backed_off, round(found[i].log_score, 6))
        assert got[:2] == want[:2] and got[2] == pytest.approx(want[2], abs=2e-5)
    assert found[0].mean_log_score is None
    assert lm_scores.lm_scores(docs([])).count() == 0
    twice = lm_scores.lm_scores(docs([(1, "a b"), (1, "a b"), (None, "a")])).collect()
    assert {(r.doc_id, r.n_words) for r in twice} == {(1, 4), (None, 1)}


def test_text_buffers_of_a_sliced_column_with_nulls():
    column = pa.array(["zero", None, "äb", ""], pa.string()).slice(1)
    data, offsets = text_buffers(column)
    assert bytes(data) == "äb".encode() and offsets.tolist() == [0, 0, 3, 3]


def test_frequent_grams_have_one_entry_a_slice(docs, prose):
    texts = [None, "", "a b", "a b c", *["a b a b"] * 40, *(prose(i) for i in range(12)), "x " * 300]
    slices = lm_scores.sliced(docs(enumerate(texts)).repartition(3), 200)
    n_slices = slices.select("slice").distinct().count()
    blocks = lm_scores.explode(slices, 3, 2).collect()
    assert len({(r.part, r.slice) for r in blocks}) == len(blocks) and {r.part for r in blocks} <= set(range(8))
    entries = Counter(h for r in blocks for h in lm_scores._values([r.hashes], np.uint64).tolist())
    assert 3 < n_slices < len(texts) and max(entries.values()) <= n_slices
    n = sum(int(lm_scores._values([r.n], np.int64).sum()) for r in blocks)
    words = [len((t or "").split()) for t in texts]
    assert n == 2 * sum(words) + sum(map(bool, words))
