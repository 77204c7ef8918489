"""Ranked lexical search with bag deduplication.

Terms are runs of ASCII letters, digits and other than ASCII characters, A to Z lower-cased.
A document scores, for an item, the sum over the item's terms of
``w * (10**9 * tf div (1000 * tf + 20 * m))``, see ``weights`` and ``lengths``.

1. Items are worked off in blocks of about ``BLOCK_BYTES`` of different texts, whatever their
   number; only a block's vocabulary and postings are sent to the tasks. What follows is
   done for each block over all documents.
2. Bags: a document is restricted to the block's vocabulary: term numbers and frequencies,
   in bytes, written once with its number of terms. Counts of documents come from them.
3. Classes: documents with the same bag and the same m score alike. They are dealt out by a
   hash and grouped by bag and m themselves, which verifies the hash. A class keeps the
   ``top`` smallest doc_ids, more can never be asked of it; that limit applies before
   the shuffle too, so a class of any size is a few rows from each task.
4. A class is scored once for all items that share a term. Each task keeps, of every item,
   the ``top`` best classes by score and smallest doc_id: any other has ``top`` documents
   before all of its own. Their members, by ascending doc_id, are ranked over all tasks.

Defined results: null texts and such without terms count for nothing; rows with equal
doc_id are ranked each for itself, null doc_ids last among equal scores; rows of items with
the same text have the same ranks; items without terms have no rows; an empty table gives an
empty result; columns besides ids and texts are not read.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workwindow.llm.common import mapped_bytes, parts_of, shared_bytes, text_buffers
from workwindow.session import stage

TOP = 50
#: Bytes of item texts in a block, of document texts in a slice.
BLOCK_BYTES, SLICE = 4 << 20, 2 << 20
#: Scores and contributions that are worked on at once.
AT_ONCE = 1 << 22
#: Stands for a null doc_id, last in order.
_NULL = np.iinfo(np.int64).max

# what each byte of a text becomes: a space ends a term
_LETTER = np.full(256, ord(" "), np.uint8)
_LETTER[128:] = np.arange(128, 256)
for _a, _z in ((b"0", b"9"), (b"a", b"z")):
    _LETTER[ord(_a) : ord(_z) + 1] = np.arange(ord(_a), ord(_z) + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of all rows one after the other, and the row of each."""
    data, offsets = text_buffers(column)
    plain = pa.LargeStringArray.from_buffers(
        len(column), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LETTER[data])
    )
    lists = pc.ascii_split_whitespace(plain)
    row = np.repeat(np.arange(len(column)), np.asarray(pc.list_value_length(lists)))
    terms = lists.flatten()
    real = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(real), row[np.asarray(real)]


class Items:
    """A block of items: their vocabulary and, per term, which items hold it."""

    def __init__(self, vocabulary: pa.Array, starts: np.ndarray, items: np.ndarray, n_items: int):
        self.vocabulary, self.starts, self.items, self.n_items = vocabulary, starts, items, n_items

    @classmethod
    def of(cls, texts: list[str]) -> Items:
        terms, item = terms_of(pa.array(texts, pa.large_string()))
        coded = terms.dictionary_encode()
        pair = np.unique(np.asarray(coded.indices).astype(np.int64) * max(len(texts), 1) + item)
        term, item = np.divmod(pair, max(len(texts), 1))
        starts = np.searchsorted(term, np.arange(len(coded.dictionary) + 1))
        return cls(coded.dictionary, starts, item, len(texts))

    def dump(self) -> bytes:
        out = io.BytesIO()
        data, offsets = text_buffers(self.vocabulary)
        np.savez(out, data=data, offsets=offsets, starts=self.starts, items=self.items, n=self.n_items)
        return out.getvalue()

    @classmethod
    def load(cls, content: bytes) -> Items:
        found = np.load(io.BytesIO(content))
        buffers = [pa.py_buffer(found["offsets"]), pa.py_buffer(found["data"])]
        vocabulary = pa.LargeStringArray.from_buffers(len(found["offsets"]) - 1, *buffers)
        return cls(vocabulary, found["starts"], found["items"], int(found["n"]))


@functools.lru_cache(1)
def _items(name: str) -> Items:
    return Items.load(mapped_bytes(name)[:])


def weights(df: np.ndarray, n_documents: int) -> np.ndarray:
    """Of terms that ``df`` documents hold."""
    return np.floor(1000 * np.log((2 * n_documents + 2) / (2 * df + 1))).astype(np.int64)


def lengths(n_documents: int, n_terms: int):
    """m of documents with ``n`` terms, as a column."""
    return F.expr(f"50 + (50L * n * {n_documents}L) div {max(n_terms, 1)}L")


def bags(documents: DataFrame, name: str) -> DataFrame:
    """doc_id, n and bag of every document with terms; a bag holds term numbers, ascending,
    each followed by its frequency, as 32-bit integers."""

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _items(name).vocabulary
        size = max(len(vocabulary), 1)
        for part in parts_of(batches, "text", SLICE):
            terms, row = terms_of(part.column("text"))
            n = np.bincount(row, minlength=part.num_rows)
            number = pc.index_in(terms, value_set=vocabulary)
            known = np.asarray(number.is_valid())
            found = np.asarray(number.drop_null()).astype(np.int64)
            pair, tf = np.unique(row[known] * size + found, return_counts=True)
            entries = np.stack([pair % size, tf], 1).astype("<i4")
            ends = 8 * np.searchsorted(pair, np.arange(part.num_rows + 1) * size)
            bag = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), part.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(entries.tobytes())]
            )
            out = pa.table(
                [part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), bag.cast(pa.binary())], ["doc_id", "n", "bag"]
            )
            yield from out.filter(pa.array(n > 0)).to_batches()

    return documents.select("doc_id", "text").mapInArrow(restrict, "doc_id bigint, n bigint, bag binary")


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers and frequencies of all bags, and the row of each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    n = (int(offsets[-1]) - int(offsets[0])) // 4
    flat = np.frombuffer(data, "<i4", n, int(offsets[0])).astype(np.int64).reshape(-1, 2) if n else np.zeros((0, 2), np.int64)
    return flat[:, 0], flat[:, 1], np.repeat(np.arange(len(column)), np.diff(offsets) // 8)


def document_counts(bagged: DataFrame) -> np.ndarray:
    """How many documents hold each term: pairs of term and count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(_entries(batch.column("bag"))[0], minlength=len(total))
            found[: len(total)] += total
            total = found
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["term", "n"])

    rows = bagged.select("bag").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    # at most the vocabulary of a block
    return np.array([(r.term, r.n) for r in rows.collect()], np.int64).reshape(-1, 2)


def classes(bagged: DataFrame, m, top: int = TOP) -> DataFrame:
    """bag, m and the ``top`` smallest doc_ids of every class of equal documents."""
    keyed = bagged.filter(F.length("bag") > 0).select("doc_id", "bag", m.alias("m"))
    keyed = keyed.withColumn("hash", F.xxhash64("bag", "m"))
    alike = ("hash", "bag", "m")
    place = F.row_number().over(Window.partitionBy(*alike).orderBy(F.col("doc_id").asc_nulls_last()))
    first = keyed.withColumn("place", place).filter(F.col("place") <= top)
    members = F.array_sort(F.collect_list(F.struct("place", "doc_id")))
    grouped = first.groupBy(*alike).agg(members.alias("members"))
    return grouped.select("bag", "m", F.transform("members", lambda x: F.coalesce(x["doc_id"], F.lit(int(_NULL)))).alias("members"))


class _Best:
    """The best classes of every item met so far."""

    def __init__(self, n_items: int, top: int):
        self.top, self.least = top, np.ones(n_items, np.int64)
        self.item = self.score = self.first = np.zeros(0, np.int64)
        self.members = np.zeros(0, object)

    def add(self, item: np.ndarray, score: np.ndarray, members: np.ndarray) -> None:
        first = np.fromiter((m[0] for m in members), np.int64, len(members))
        self.item, self.score = np.append(self.item, item), np.append(self.score, score)
        self.first, self.members = np.append(self.first, first), np.append(self.members, members)
        if len(item):
            self.keep()

    def keep(self) -> None:
        order = np.lexsort((self.first, -self.score, self.item))
        place = _places(self.item[order])
        order = order[place < self.top]
        self.item, self.score, self.first, self.members = (x[order] for x in (self.item, self.score, self.first, self.members))
        full = _places(self.item) == self.top - 1
        self.least[self.item[full]] = self.score[full]

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, doc_id and score of the members, the best ``top`` of every item."""
        sizes = [len(m) for m in self.members]
        item, score = np.repeat(self.item, sizes), np.repeat(self.score, sizes)
        doc = np.concatenate([np.zeros(0, np.int64), *self.members])
        order = np.lexsort((doc, -score, item))
        order = order[_places(item[order]) < self.top]
        return item[order], doc[order], score[order]


def _places(item: np.ndarray) -> np.ndarray:
    """Place of each entry among those of its item, given in order."""
    return np.arange(len(item)) - np.searchsorted(item, item)


def score_classes(found: DataFrame, name: str, weight: np.ndarray, top: int = TOP) -> DataFrame:
    """item (number in the block), doc_id and score: the best of every task."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(name)
        best = _Best(items.n_items, top)
        holders = np.diff(items.starts) * (weight > 0)
        for batch in batches:
            term, tf, row = _entries(batch.column("bag"))
            m = np.asarray(batch.column("m"))
            lists = batch.column("members")
            flat, cut = np.asarray(lists.flatten()), np.asarray(lists.offsets) - lists.offsets[0].as_py()
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
            size = holders[term]
            # rows whose scores and contributions fit
            upto = np.append(0, np.cumsum(np.bincount(row, size, batch.num_rows) + items.n_items))
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(upto, upto[start] + AT_ONCE, "right")) - 1)
                a, b = np.searchsorted(row, (start, stop))
                n, ends = size[a:b], np.cumsum(size[a:b])
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(items.starts[term[a:b]] - (ends - n), n)
                scores = np.zeros((stop - start) * items.n_items, np.int64)
                np.add.at(scores, np.repeat(row[a:b] - start, n) * items.n_items + items.items[at], np.repeat(part[a:b], n))
                good = np.flatnonzero(scores.reshape(stop - start, -1) >= best.least)
                at, item = np.divmod(good, items.n_items)
                members = np.empty(len(good), object)
                members[:] = [flat[cut[r] : cut[r + 1]] for r in (at + start).tolist()]
                best.add(item, scores[good], members)
                start = stop
        item, doc, points = best.documents()
        doc_id = pa.array(doc, pa.int64(), mask=doc == _NULL)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), doc_id, pa.array(points, pa.int64())], ["item", "doc_id", "score"]
        )

    return found.mapInArrow(score, "item int, doc_id bigint, score bigint")


def ranked(documents: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score: the ``top`` best documents of every item."""
    spark = documents.sparkSession
    texts = items.filter("text IS NOT NULL").select("item_id", "text", F.sha2("text", 256).alias("key"))
    different = texts.groupBy("key").agg(F.first("text").alias("text"))
    size = different.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // block_bytes))
    different = different.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)))
    results = []
    for block in range(n_blocks):
        # a block of items: bounded by ``block_bytes`` whatever the tables hold
        rows = different.filter(F.col("block") == block).orderBy("key").collect()
        name = shared_bytes(spark, "items", (asked := Items.of([r.text for r in rows])).dump())
        bagged = stage(bags(documents, name), "ranking-bags")
        n_documents, n_terms = bagged.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(asked.vocabulary), np.int64)
        term, n = document_counts(bagged).T
        df[term] = n
        weight = np.where(df > 0, weights(df, n_documents), 0)
        best = score_classes(classes(bagged, lengths(n_documents, n_terms), top), name, weight, top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        keys = spark.createDataFrame([(i, r.key) for i, r in enumerate(rows)], "item int, key string")
        results.append(best.join(F.broadcast(keys), "item").select("key", "rank", "doc_id", "score"))
    whole = functools.reduce(DataFrame.unionByName, results)
    return texts.join(whole, "key").select("item_id", "rank", "doc_id", "score")
