"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

1. Pieces: every text becomes its token ids and an end id; only what is longer than a
   sequence is cut. Pieces are written once, numbered within their length in their task.
2. Counts: how many pieces of each length there are, at most ``capacity`` numbers. The plan
   is made of these numbers alone, so its cost and size do not grow with the documents.
3. Plan: a sequence is filled greedily, longest piece first. If it holds more than one,
   its shortest is replaced by the two unpacked pieces that fill the gap so expanded
   most tightly, if they fill it better. The same sequence is made again as often as the
   counts of all lengths that led to it last, at once: what packing one sequence after
   the other would do.
4. Places: the plan is a list of ranges of pieces of one length. A piece's number among
   all of its length, its task's offset and its number there, tells its range by a binary
   search, and with it its sequence and offset.

Defined results: a null or empty text is one piece of the end id; repeated rows and rows
with equal or null doc_id are packed each for itself; an empty table gives an empty
result; columns besides doc_id and text are not read. Which pieces of equal length share a
sequence depends on how the table is split, the number of sequences does not.
"""

from __future__ import annotations

import functools
import io
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workwindow.llm.bpe import SLICE, encoder_of, ship
from workwindow.llm.common import mapped_bytes, parts_of, shared_bytes
from workwindow.session import stage

CAPACITY, END = 2048, 0
#: Lengths with how many of each a sequence has, and how many such sequences there are.
Pattern = tuple[dict[int, int], int]


def best_two_fit(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """The sequences that hold ``counts[length]`` pieces of each length."""
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left)
    patterns = []
    while lengths:
        taken, room, below = {}, capacity, len(lengths)
        while at := bisect_right(lengths, room, 0, below):
            below = at - 1
            length = lengths[below]
            taken[length] = n = min(left[length], room // length)
            room -= n * length
        needed = dict(taken)
        if room and sum(taken.values()) > 1:
            smallest = min(taken)
            pair = _tightest_pair(lengths, left, taken, room + smallest)
            if sum(pair) > smallest:
                taken[smallest] -= 1
                for length in pair:
                    taken[length] = taken.get(length, 0) + 1
                    needed[length] = needed.get(length, 0) + 1
        times = min(left[length] // n for length, n in needed.items())
        taken = {length: n for length, n in taken.items() if n}
        patterns.append((taken, times))
        for length, n in taken.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
                del lengths[bisect_right(lengths, length) - 1]
    return patterns


def _tightest_pair(lengths: list[int], left: dict[int, int], taken: dict[int, int], gap: int) -> tuple[int, ...]:
    """Two of what is left whose sum is largest within ``gap``, the one with the longest piece."""
    best, total = (), 0
    free = [x for x in lengths[: bisect_right(lengths, gap - 1)] if left[x] > taken.get(x, 0)]
    low, high = 0, len(free) - 1
    while low <= high and total < gap:
        longer, shorter = free[high], free[low]
        if longer + shorter > gap or (low == high and left[longer] - taken.get(longer, 0) < 2):
            high -= 1
            continue
        if longer + shorter > total:
            best, total = (longer, shorter), longer + shorter
        low += 1
    return best


class Places:
    """The plan as ranges of pieces, numbered through all lengths in order."""

    FIELDS = ("firsts", "ends", "per_sequence", "sequences", "offsets", "lengths")

    def __init__(self, *arrays: np.ndarray):
        self.firsts, self.ends, self.per_sequence, self.sequences, self.offsets, self.lengths = arrays

    @classmethod
    def of(cls, patterns: list[Pattern], capacity: int) -> Places:
        rows, sequence = [], 0
        for taken, times in patterns:
            offset = 0
            for length, n in sorted(taken.items(), reverse=True):
                rows.append((length, n * times, n, sequence, offset))
                offset += n * length
            sequence += times
        table = np.array(rows, np.int64).reshape(-1, 5)
        table = table[np.argsort(table[:, 0], kind="stable")]
        upto = np.cumsum(table[:, 1])
        # where each length's numbers start
        firsts = np.append(0, upto)[np.searchsorted(table[:, 0], np.arange(capacity + 1))]
        return cls(firsts, upto, table[:, 2], table[:, 3], table[:, 4], table[:, 0])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, content: bytes) -> Places:
        found = np.load(io.BytesIO(content))
        return cls(*(found[name] for name in cls.FIELDS))

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these numbers among those of their length."""
        number = self.firsts[length] + number
        at = np.searchsorted(self.ends, number, "right")
        within = number - (self.ends[at] - np.diff(np.append(0, self.ends))[at])
        per = self.per_sequence[at]
        return self.sequences[at] + within // per, self.offsets[at] + within % per * length


@functools.lru_cache(1)
def _places(name: str) -> Places:
    return Places.load(mapped_bytes(name)[:])


def pieces_of(
    documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = True
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if wanted, ids (array<int>) of every
    piece; ``task`` and ``number`` tell it from the others of its length."""
    names = ship(documents.sparkSession, tokenizer_path, [])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(*names)
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for part in parts_of(batches, "text", SLICE):
            ids, rows = encoder.encode(part.column("text"))
            ids = np.insert(ids, rows[1:], end).astype("<u4", copy=False)
            rows = rows + np.arange(len(rows))
            n_pieces = -(-np.diff(rows) // capacity)
            row = np.repeat(np.arange(len(n_pieces)), n_pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            first = rows[row] + start
            length = np.minimum(capacity, rows[row + 1] - first)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            number = np.empty_like(length)
            number[order] = np.arange(len(order)) - np.searchsorted(ordered, ordered)
            number += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            raw, ends = memoryview(ids).cast("B"), first + length
            sums = [zlib.crc32(raw[a:b]) for a, b in zip((4 * first).tolist(), (4 * ends).tolist())]
            columns = {
                "doc_id": part.column("doc_id").take(pa.array(row)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
                "task": pa.array(np.full(len(row), task), pa.int32()),
                "number": pa.array(number, pa.int64()),
            }
            if with_ids:
                offsets = pa.array(np.append(first, len(ids)), pa.int32())
                columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, number bigint"
    found = documents.select("doc_id", "text").mapInArrow(cut, schema + ", ids array<int>" * with_ids)
    # numbers hold within a task's output, so it is written once
    return stage(found, "packing-pieces")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with the sequence_id and the offset of each, in place of task and number."""
    spark = pieces.sparkSession
    in_task = stage(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "packing-counts")
    # at most ``capacity`` rows
    counts = {r.length: r.n for r in in_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Places.of(best_two_fit(counts, capacity), capacity)
    name = shared_bytes(spark, "packing", plan.dump())
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    in_task = in_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    kept = [f for f in pieces.schema.fields if f.name not in ("task", "number")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _places(name).find
        for batch in batches:
            length, number, before = (np.asarray(batch.column(c)) for c in ("length", "number", "before"))
            sequence, offset = find(length, before + number)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(sequence), pa.array(offset)],
                [*(f.name for f in kept), "sequence_id", "offset"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    placed = pieces.join(in_task, ["task", "length"])
    return placed.select(*(f.name for f in kept), "number", "before").mapInArrow(
        place, f"{schema}, sequence_id bigint, offset bigint"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids of the whole sequence, and the spans of its pieces in order."""
    span = F.struct("offset", "length", "doc_id", "piece", "ids")
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return rows.select(
        "sequence_id",
        F.flatten("spans.ids").alias("ids"),
        F.transform("spans", lambda s: s.dropFields("ids")).alias("spans"),
    )
