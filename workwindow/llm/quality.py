"""Quality rules: base rules of a text and a line labeller that decides retention.

The labeller is a linear-chain conditional random field with two labels, content and
boilerplate, over the lines of a text that hold a word. Emissions are linear in line
features (lengths, shares of character classes, repetition), transitions and the first
label have weights of their own. Viterbi decoding labels all lines of a text together;
a text is kept if its content lines hold at least ``KEEP_SHARE`` of its words and no
base rule fails.

Training: at most ``SAMPLE`` labelled documents of each quality, chosen by a hash of
the id, and of each a stretch of at most ``SAMPLE_LINES`` lines drawn from anywhere in it,
reach the driver as features. Lines
start with the label of their document; a first model without transitions corrects
lines of bad documents that look like content, then the field is fitted by its
likelihood. Without documents of both qualities every line counts as content.

Everything else covers whole texts. Windows and lines are compared by 64-bit hashes.

Defined results: a null or blank text has no words and fails the base rules; a document
with several labels counts as bad if one of them is; null labels or ids do not train;
repeated rows stay; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workwindow.llm.common import (
    gram_hashes,
    mix,
    range_hashes,
    runs_in_rows,
    parts_of,
    text_buffers,
    twins,
    word_ranges,
)

WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
KEEP_SHARE = 1 / 3
SAMPLE, SAMPLE_LINES = 800, 32
# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"


def _class(members) -> np.ndarray:
    out = np.zeros(256, np.int8)
    out[list(members)] = 1
    return out


_CLASSES = np.stack(
    [
        _class(b for b in range(256) if not 0x80 <= b < 0xC0),  # starts of code points
        _class([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]),  # letters
        _class(range(0x41, 0x5B)),  # capitals
        _class(range(0x30, 0x3A)),  # digits
        _class(SYMBOLS),
        _class(b"!?"),
        _class(b".,;:"),
        _class(b" \t\n\x0b\x0c\r"),
        _class([ord("\n")]),
    ]
)
START, LETTER, CAPITAL, DIGIT, SYMBOL, SHOUT, STOP, SPACE, BREAK = range(len(_CLASSES))
N_FEATURES = 26


def _sums(data: np.ndarray, kind: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_CLASSES[kind][data], out=total[1:])
    return total[ends] - total[starts]


@dataclass
class Lines:
    """Counts of the rows of a slice, and features of their lines that hold a word."""

    counts: dict[str, np.ndarray]
    row: np.ndarray  # of each line
    n_words: np.ndarray  # of each line
    features: np.ndarray


def measure(data: np.ndarray, offsets: np.ndarray) -> Lines:
    n_rows = len(offsets) - 1
    starts, ends = word_ranges(data, offsets)
    first = np.searchsorted(starts, offsets)
    words = range_hashes(data, starts, ends)
    row_of_word = np.repeat(np.arange(n_rows), np.diff(first))

    # windows of five words that occur twice in their text
    places = runs_in_rows(first, WINDOW)
    own = mix(row_of_word[places].astype(np.uint64) + np.uint64(1))
    repeated, _ = twins(gram_hashes(words, WINDOW)[places] ^ own)
    covered = np.zeros(len(words) + WINDOW, np.int32)
    hits = places[repeated]
    np.add.at(covered, hits, 1)
    np.add.at(covered, hits + WINDOW, -1)
    covered = np.cumsum(covered)[: len(words)] > 0

    # lines
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    line_starts = line_starts[line_starts < len(data)] if len(data) else line_starts[:0]
    line_ends = np.append(line_starts[1:], len(data)) if len(line_starts) else line_starts
    line_ends = line_ends - (data[line_ends - 1] == 10) if len(line_starts) else line_ends
    line_first = np.searchsorted(starts, line_starts)
    line_words = np.diff(np.append(line_first, len(starts)))
    has_word = line_words > 0
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_first, line_words = line_first[has_word], line_words[has_word]
    row = np.searchsorted(offsets, line_starts, "right") - 1
    line_keys = range_hashes(data, line_starts, line_ends) ^ mix(row.astype(np.uint64) + np.uint64(1))
    line_repeated, line_later = twins(line_keys)

    def per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, values, n_rows).astype(np.int64)

    from_, to = offsets[:-1], offsets[1:]
    counts = {
        "n_words": np.diff(first),
        "word_chars": _sums(data, START, from_, to) - _sums(data, SPACE, from_, to),
        "n_symbols": _sums(data, SYMBOL, from_, to),
        "n_dup_lines": per_row(line_later, row),
        "n_repeat_words": per_row(covered, row_of_word),
    }

    sums = {k: _sums(data, k, line_starts, line_ends) for k in (START, LETTER, CAPITAL, DIGIT, SYMBOL, SHOUT, STOP)}
    n_lines = len(line_starts)
    line_of_word = np.repeat(np.arange(n_lines), line_words)
    follows = np.zeros(len(words), bool)
    follows[1:] = (words[1:] == words[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    again, _ = twins(words ^ mix(line_of_word.astype(np.uint64) + np.uint64(1)))

    def per_line(values: np.ndarray) -> np.ndarray:
        return np.bincount(line_of_word, values, n_lines) / np.maximum(line_words, 1)

    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    penultimate = data[np.maximum(ends - 2, 0)] if len(ends) else last
    doubled = (last == penultimate) & (_CLASSES[SYMBOL][last] + _CLASSES[SHOUT][last] + _CLASSES[STOP][last] > 0) & (ends - starts > 1)
    alone = (ends - starts == 1) & (_CLASSES[LETTER][last] + _CLASSES[DIGIT][last] == 0)
    chars = np.maximum(sums[START], 1)
    share = {k: v / chars for k, v in sums.items()}
    line_end = data[np.maximum(line_ends - 1, 0)] if n_lines else np.zeros(0, np.uint8)
    word_length = sums[START] / np.maximum(line_words, 1)
    columns = [
        np.ones(n_lines),
        np.minimum(np.log1p(chars) / 6, 2),
        np.minimum(np.log1p(line_words) / 4, 2),
        line_words < 4,
        np.minimum(word_length / 10, 3),
        share[LETTER],
        np.minimum(4 * share[CAPITAL], 2),
        share[CAPITAL] > 0.3,
        np.minimum(5 * share[DIGIT], 2),
        np.minimum(10 * share[SYMBOL], 2),
        share[SYMBOL] > 0.05,
        np.minimum(10 * share[SHOUT], 2),
        share[SHOUT] > 0.05,
        np.minimum(10 * share[STOP], 2),
        per_line(follows),
        per_line(follows) > 0.3,
        per_line(again),
        per_line(again) > 0.8,
        per_line(covered),
        per_line(covered) > 0.5,
        per_line(doubled),
        per_line(doubled) > 0.3,
        per_line(alone),
        per_line(alone) > 0.2,
        line_repeated,
        np.isin(line_end, list(b'.!?"')),
    ]
    features = np.stack(columns, 1).astype(np.float64) if n_lines else np.zeros((0, N_FEATURES))
    return Lines(counts, row, line_words, features)


@dataclass
class Field:
    """Weights for content against boilerplate, transitions by (from, to), first label."""

    emission: np.ndarray
    transition: np.ndarray
    first: np.ndarray

    @classmethod
    def all_content(cls) -> Field:
        emission = np.zeros(N_FEATURES)
        emission[0] = 1.0
        return cls(emission, np.zeros((2, 2)), np.zeros(2))

    def viterbi(self, row: np.ndarray, features: np.ndarray) -> np.ndarray:
        """The most likely label of every line; ``row`` (sorted) says which lines are a text.
        All texts advance together, line by line."""
        if not len(row):
            return np.zeros(0, np.int8)
        score = features @ self.emission
        starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        lengths = np.diff(np.append(starts, len(row)))
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        back = np.zeros((len(row), 2), np.int8)
        best = np.tile(self.first, (len(starts), 1))
        best[:, 1] += score[starts]
        for t in range(1, lengths[0]):
            n = int(np.searchsorted(-lengths, -t))
            ways = best[:n, :, None] + self.transition
            at = starts[:n] + t
            back[at] = ways.argmax(1)
            best[:n] = ways.max(1)
            best[:n, 1] += score[at]
        labels = np.zeros(len(row), np.int8)
        now = best.argmax(1).astype(np.int8)
        for t in range(lengths[0] - 1, -1, -1):
            n = int(np.searchsorted(-lengths, -t))
            at = starts[:n] + t
            labels[at] = now[:n]
            now[:n] = back[at, now[:n]]
        return labels


def stretch(features: np.ndarray) -> np.ndarray:
    """At most ``SAMPLE_LINES`` lines in a row, from a place that a hash of all of them draws."""
    spare = len(features) - SAMPLE_LINES
    if spare <= 0:
        return features
    start = zlib.crc32(np.ascontiguousarray(features, "<f4").tobytes()) % (spare + 1)
    return features[start : start + SAMPLE_LINES]


def fit(texts: list[tuple[np.ndarray, int]], steps: int = 120) -> Field:
    """Fit the field to line features of texts and the quality (0 or 1) of each text."""
    texts = [(stretch(f), q) for f, q in texts if len(f)]
    if len({q for _, q in texts}) < 2:
        return Field.all_content()
    n, longest = len(texts), max(len(f) for f, _ in texts)
    x = np.zeros((n, longest, N_FEATURES))
    mask = np.zeros((n, longest), bool)
    for i, (f, _) in enumerate(texts):
        x[i, : len(f)], mask[i, : len(f)] = f, True
    quality = np.array([q for _, q in texts])
    y = np.repeat(quality[:, None], longest, 1)
    weight = mask / mask.sum(1, keepdims=True)  # every text counts alike
    for q in (0, 1):
        weight[quality == q] /= (quality == q).sum()

    w = np.zeros(N_FEATURES)
    adam = _Adam(w.size)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        w = w - adam.step(np.einsum("nt,ntf->f", (p - y) * weight, x) + 1e-4 * w)
    y = np.where((x @ w > 2) & (quality == 0)[:, None], 1, y)

    each = weight.sum(1) / weight.sum()
    params = np.concatenate((w, np.zeros(6)))
    adam = _Adam(params.size)
    for _ in range(steps):
        field = Field(params[:-6], params[-6:-2].reshape(2, 2), params[-2:])
        gradient = _gradient(field, x, y, mask, each)
        params = params - adam.step(gradient + 1e-4 * params)
    return Field(params[:-6], params[-6:-2].reshape(2, 2), params[-2:])


class _Adam:
    def __init__(self, size: int, rate: float = 0.1):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient**2
        m, v = self.m / (1 - 0.9**self.t), self.v / (1 - 0.99**self.t)
        return self.rate * m / (np.sqrt(v) + 1e-9)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


def _gradient(field: Field, x, y, mask, each) -> np.ndarray:
    """Of the negative log likelihood: expected less observed features."""
    n, longest, _ = x.shape
    score = np.zeros((n, longest, 2))
    score[..., 1] = x @ field.emission
    ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    ahead[:, 0] = field.first + score[:, 0]
    for t in range(1, longest):
        new = _logsum(ahead[:, t - 1, :, None] + field.transition, 1) + score[:, t]
        ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        new = _logsum(field.transition + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
    total = _logsum(ahead[:, -1], 1)
    label = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
    seen = np.stack((y == 0, y == 1), -1) * mask[..., None]
    d_emission = np.einsum("nt,ntf->f", (label - seen)[..., 1] * each[:, None], x)
    pair = np.exp(
        ahead[:, :-1, :, None] + field.transition + (score + behind)[:, 1:, None, :] - total[:, None, None, None]
    )
    pair = pair - seen[:, :-1, :, None] * seen[:, 1:, None, :]
    d_transition = np.einsum("ntab,nt->ab", pair, mask[:, 1:] * each[:, None])
    d_first = ((label - seen)[:, 0] * each[:, None]).sum(0)
    return np.concatenate((d_emission, d_transition.ravel(), d_first))


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Fit on at most ``sample`` labelled documents of each quality."""
    by_id = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    order = F.xxhash64("doc_id", F.lit(11))
    rows = [r for q in (0, 1) for r in by_id.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(sample).collect()]
    if len({r.quality for r in rows}) < 2:
        return Field.all_content()
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    chosen = spark.createDataFrame([(r.doc_id, r.quality) for r in rows], f"doc_id {kind}, quality int")

    def line_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, "text"):
            lines = measure(*text_buffers(part.column("text")))
            of = [stretch(lines.features[lines.row == i]) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("quality"), pa.array([f.astype("<f4").tobytes() for f in of], pa.binary())],
                ["doc_id", "quality", "features"],
            )

    # at most 2 * sample ids
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = texts.mapInArrow(line_features, f"doc_id {kind}, quality int, features binary").orderBy("doc_id", "features").limit(4 * sample).collect()
    return fit([(np.frombuffer(r.features, "<f4").reshape(-1, N_FEATURES).astype(float), r.quality) for r in found])


def judge(documents: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    content_share and kept of every row of ``documents`` (doc_id, text)."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, "text"):
            lines = measure(*text_buffers(part.column("text")))
            content = field.viterbi(lines.row, lines.features)
            inside = np.bincount(lines.row, content * lines.n_words, part.num_rows)
            n = lines.counts["n_words"]
            share = inside / np.maximum(n, 1)
            failed = (n < MIN_WORDS) | (100 * lines.counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *(pa.array(lines.counts[c].astype(np.int64)) for c in names),
                    pa.array(failed),
                    pa.array(share),
                    pa.array(~failed & (share >= KEEP_SHARE)),
                ],
                ["doc_id", *names, "base_failed", "content_share", "kept"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in names)
    return documents.select("doc_id", "text").mapInArrow(
        label, f"doc_id {kind}, {counts}, base_failed boolean, content_share double, kept boolean"
    )


def keep_good(documents: DataFrame, field: Field) -> DataFrame:
    """The rows of ``documents`` that ``judge`` keeps, with all their columns, in one pass."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, "text"):
            lines = measure(*text_buffers(part.column("text")))
            content = field.viterbi(lines.row, lines.features)
            inside = np.bincount(lines.row, content * lines.n_words, part.num_rows)
            n = lines.counts["n_words"]
            failed = (n < MIN_WORDS) | (100 * lines.counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
            yield part.filter(pa.array(~failed & (inside >= KEEP_SHARE * n)))

    return documents.mapInArrow(keep, documents.schema)
