"""Stupid-backoff language model scores of documents against the rest of the corpus.

A word scores the count of its longest n-gram that occurs elsewhere over that of the words
before it, times ``BACKOFF`` for every order given up; a word that occurs nowhere else
counts once. Texts start with start marks. All counts are of the whole corpus less the
document's own, so no document vouches for itself; only the number of all words is not.

1. Texts are dealt out in slices of about ``SLICE`` bytes. A slice explodes its n-grams of
   all orders, adds up equal ones, and sends them by the first bits of their hashes: a row
   for each slice and part. So no n-gram, however frequent, has more entries than there
   are slices.
2. In a part all entries of an n-gram meet: the count table of the part, joined to the
   entries at once. Each row goes back to its slice with the totals in the same order.
3. The slice, again with its texts, subtracts own counts and adds up the scores of each
   document; rows of one doc_id are added up last.

N-grams are named by 64-bit hashes; a part holds those of about ``PART`` bytes of text, and
the number of parts follows from the size of the texts.

Defined results: one row per doc_id; rows that share one are scored as texts of their
own and added, those without one likewise; a null or blank text has no words, score 0 and
a null mean; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workwindow.llm.common import mix, slices, text_buffers, word_hashes
from workwindow.session import stage

BACKOFF, ORDER = 0.4, 2
#: Bytes of text that make one slice, and whose n-grams make a part.
SLICE, PART = 4 << 20, 8 << 20
START = np.uint64(0x2545F4914F6CDD1D)
_NEXT = np.uint64(0x9FB21C651E98DF25)


def sliced(documents: DataFrame, size: int = SLICE) -> DataFrame:
    """slice, doc_id and text: the documents of a task, cut by bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in slices(batch, "text", size):
                number += 1
                columns = [pa.array(np.full(part.num_rows, number)), part.column("doc_id").cast(pa.int64()), part.column("text")]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "doc_id", "text"])

    return documents.select("doc_id", "text").mapInArrow(cut, "slice bigint, doc_id bigint, text string")


class Grams:
    """The n-grams that end at each word of a slice, by order."""

    def __init__(self, texts: pa.ChunkedArray, order: int):
        column = texts.combine_chunks()
        words, first = word_hashes(*text_buffers(column))
        self.n_words = np.diff(first)
        self.row = np.repeat(np.arange(len(column)), self.n_words)
        self.opens = np.zeros(len(words), bool)
        self.opens[first[:-1][self.n_words > 0]] = True
        self.by_order = [words]
        for k in range(1, order):
            before = np.empty_like(words)
            before[1:] = self.by_order[-1][:-1]
            before[self.opens] = START
            # orders apart, also after a start mark alone
            self.by_order.append(mix(before * _NEXT + words + np.uint64(k)))
        # different hashes in order: blocks by their first bits are ranges of them
        all_ = np.append(np.concatenate(self.by_order), np.full(self.opens.sum(), START))
        self.hashes, self.at, self.n = np.unique(all_, return_inverse=True, return_counts=True)

    def blocks(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Parts that the hashes fall into, and where each part's hashes start."""
        part = (self.hashes >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        return part[starts], np.append(starts, len(part))

    def scores(self, totals: np.ndarray) -> dict[str, np.ndarray]:
        """Per text: words, words scored by lower orders, words scored alone, and the sum of
        log scores but for the number of all words, which the latter are divided by."""
        n, order = len(self.row), len(self.by_order)
        texts = len(self.n_words)
        elsewhere, whole = [], totals[self.at]
        for k, grams in enumerate(self.by_order):
            _, inverse, own = np.unique(grams ^ mix(self.row.astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
            elsewhere.append(whole[k * n : (k + 1) * n] - own[inverse])
        start = whole[-1] - 1 if n else 0  # other texts with words
        value = np.log(np.maximum(elsewhere[0], 1)) + (order - 1) * np.log(BACKOFF)
        level = np.zeros(n, np.int64)
        for k in range(1, order):
            before = np.empty(n, np.int64)
            before[1:] = elsewhere[k - 1][:-1]
            before[self.opens] = start
            found = elsewhere[k] > 0
            level[found] = k
            higher = np.log(np.maximum(elsewhere[k], 1)) - np.log(np.maximum(before, 1)) + (order - 1 - k) * np.log(BACKOFF)
            value = np.where(found, higher, value)
        by_text = functools.partial(np.bincount, self.row, minlength=texts)
        return {
            "n_words": self.n_words.astype(np.int64),
            "backed": by_text(level < order - 1).astype(np.int64),
            "alone": by_text(level == 0).astype(np.int64),
            "score": by_text(value).astype(np.float64),
        }


def _planes(values: np.ndarray) -> bytes:
    """First all lowest bytes, last all highest: of sorted values the latter pack well."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _values(planes: list[bytes], kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = [np.frombuffer(p, np.uint8).reshape(size, -1).T for p in planes]
    return np.concatenate([np.zeros((0, size), np.uint8), *flat]).copy().view(kind).ravel()


def explode(slice_rows: DataFrame, bits: int, order: int) -> DataFrame:
    """part, slice, hashes and n: a row for each part that a slice has n-grams of."""

    def exploded(group: pa.Table) -> pa.Table:
        grams = Grams(group.column("text"), order)
        parts, cuts = grams.blocks(bits)
        n = grams.n.astype(np.int64)
        cut = list(zip(cuts.tolist(), cuts[1:].tolist()))
        return pa.table(
            {
                "part": pa.array(parts, pa.int64()),
                "slice": pa.array(np.full(len(parts), group.column("slice")[0].as_py()), pa.int64()),
                "hashes": pa.array([_planes(grams.hashes[a:b]) for a, b in cut], pa.binary()),
                "n": pa.array([_planes(n[a:b]) for a, b in cut], pa.binary()),
            }
        )

    return slice_rows.groupBy("slice").applyInArrow(exploded, "part bigint, slice bigint, hashes binary, n binary")


def total_counts(blocks: DataFrame) -> DataFrame:
    """part, slice and totals: for each hash of a block, in order, its count in all blocks."""

    def count(group: pa.Table) -> pa.Table:
        hashes = group.column("hashes").to_pylist()
        sizes = [len(h) // 8 for h in hashes]
        _, at = np.unique(_values(hashes, np.uint64), return_inverse=True)
        totals = np.bincount(at, _values(group.column("n").to_pylist(), np.int64)).astype(np.int64)[at]
        ends = np.cumsum(sizes).tolist()
        back = [_planes(totals[e - s : e]) for s, e in zip(sizes, ends)]
        return group.select(["part", "slice"]).append_column("totals", pa.array(back, pa.binary()))

    return blocks.groupBy("part").applyInArrow(count, "part bigint, slice bigint, totals binary")


def lm_scores(documents: DataFrame, order: int = ORDER, slice_bytes: int = SLICE, part_bytes: int = PART) -> DataFrame:
    """doc_id, n_words, n_backed_off (not scored by the highest order), log_score (sum of
    natural logs) and mean_log_score."""
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(0, (-(-size * order // part_bytes) - 1).bit_length())
    texts = sliced(documents, slice_bytes)
    totals = total_counts(explode(texts, bits, order))

    def score(rows: pa.Table, replies: pa.Table) -> pa.Table:
        grams = Grams(rows.column("text"), order)
        replies = replies.sort_by("part")
        found = _values(replies.column("totals").to_pylist(), np.int64)
        if len(found) != len(grams.hashes):
            raise ValueError("a slice changed between its two readings: stage the documents first")
        return pa.table({"doc_id": rows.column("doc_id"), **grams.scores(found)})

    by_slice = texts.groupBy("slice").cogroup(totals.groupBy("slice"))
    scored = by_slice.applyInArrow(score, "doc_id bigint, n_words bigint, backed bigint, alone bigint, score double")
    scored = scored.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("n_words", "backed", "alone", "score")))
    scored = stage(scored, "lm-sums")
    n_all = scored.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    log_score = F.col("score") - F.col("alone") * F.lit(float(np.log(max(n_all, 1))))
    return scored.select(
        "doc_id", "n_words", F.col("backed").alias("n_backed_off"), log_score.alias("log_score")
    ).withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
