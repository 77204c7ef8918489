"""N-gram Jaccard join by MinHash bands, verified on whole n-gram sets.

1. Every text becomes the set of its runs of five words (64-bit hashes; a text of one to
   four words has one run of all of them). Texts with equal sets are one node, named by
   a 128-bit digest of the set, so copies never meet each other as rows.
2. Band and row counts follow from the threshold and the recall wanted at it
   (``choose_bands``). Nodes meet by band hash. Buckets of one node go, and of buckets
   with the same members one stays.
3. A bucket is verified in blocks: its nodes are dealt to blocks of bounded size, and each
   pair of blocks is one group for numpy, which compares the whole sets of all pairs but
   emits only sums: for a node the documents linked to it in this pair of blocks, and
   the smallest node it is connected to there. A pair counts in the first band that
   both nodes share. So a bucket of any size is compared in full, no task holds more
   than two blocks, and output stays linear.
4. Groups are the connected components of the links, found by alternating star steps on
   tables in shared storage.

Only texts of nodes that share a bucket are shuffled to their groups, as sets.

Defined results: a row without doc_id has class null and no links; a null or blank text
has no set, is its own class and has no links; rows of one doc_id count as documents of
their own and get the class and links of their text; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workwindow.llm.common import (
    WORD,
    gram_hashes,
    mix,
    runs_in_rows,
    parts_of,
    text_buffers,
    word_hashes,
)
from workwindow.session import stage

N_WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
MAX_HASHES = 96
#: A block holds about so many nodes, or n-grams if its sets are large.
BLOCK_NODES, BLOCK_GRAMS = 256, 400_000


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows for which enough bands fit into ``max_hashes`` that a
    pair at the threshold meets with probability ``recall``."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError(f"{max_hashes} hashes cannot reach recall {recall} at {threshold}")
    return best


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted n-gram hashes of each row, each once."""
    words, first = word_hashes(data, offsets)
    places = runs_in_rows(first, n)
    grams = gram_hashes(words, n)[places]
    bounds = np.searchsorted(places, first).tolist()
    sets = [np.unique(grams[a:b]) for a, b in zip(bounds, bounds[1:])]
    n_words = np.diff(first)
    for k in range(1, n):
        few = np.flatnonzero(n_words == k)
        if len(few):
            whole = gram_hashes(words, k)[first[few]] ^ np.uint64(0x5851F42D4C957F2D + k)
            for i, h in zip(few.tolist(), whole):
                sets[i] = h[None]
    return sets


def _digests(grams: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """128 bits for each set."""
    one = np.add.reduceat(mix(grams), starts)
    two = np.add.reduceat(mix(grams ^ np.uint64(0xA0761D6478BD642F)), starts)
    return [pair.tobytes() for pair in np.stack((one, two), 1).astype(">u8")]


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(5))
    a = random.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, random.integers(0, 1 << 63, n, dtype=np.uint64)


def signatures(documents: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, node (null: no words), n_grams and band hashes of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _factors(bands * rows)
        weights = _factors(rows)[0]
        for part in parts_of(batches, "text"):
            sets = gram_sets(*text_buffers(part.column("text")), n)
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            nodes: list[bytes | None] = [None] * len(sets)
            hashes: list[np.ndarray | None] = [None] * len(sets)
            if len(full):
                grams = np.concatenate([sets[i] for i in full])
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                least = np.stack([np.minimum.reduceat(grams * x + y, starts) for x, y in zip(a, b)])
                least = least.reshape(bands, rows, -1) * weights[None, :, None]
                keys = mix(least.sum(1, dtype=np.uint64)).astype(np.int64).T
                for i, node, key in zip(full.tolist(), _digests(grams, starts), keys):
                    nodes[i], hashes[i] = node, key
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(nodes, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                ["doc_id", "node", "n_grams", "bands"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        sign, f"doc_id {kind}, node binary, n_grams bigint, bands array<bigint>"
    )


def _shared_buckets(nodes: DataFrame, bands: int) -> DataFrame:
    """Per node that shares a bucket: node, n_grams, rep, size, and by band the hash and
    the number of blocks of the bucket (0: none that counts)."""
    rows = nodes.select("node", "n_grams", F.posexplode("bands").alias("band", "hash"))
    buckets = (
        rows.groupBy("band", "hash")
        .agg(
            F.count("*").alias("members"),
            F.sum("n_grams").alias("grams"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .filter("members > 1")
        .groupBy("members", "grams", "x", "y")
        .agg(F.min_by("hash", "band").alias("hash"), F.min("band").alias("band"))
        .select(
            "band",
            "hash",
            F.greatest(
                F.ceil(F.col("members") / BLOCK_NODES), F.ceil(F.col("grams") / BLOCK_GRAMS)
            ).cast("int").alias("blocks"),
        )
    )
    buckets = stage(buckets, "near-buckets")
    kept = rows.select("node", "band", "hash").join(buckets, ["band", "hash"])
    by_band = kept.groupBy("node").agg(
        F.map_from_entries(F.collect_list(F.struct("band", F.struct("hash", "blocks")))).alias("b")
    )
    every = F.sequence(F.lit(0), F.lit(bands - 1))
    return by_band.select(
        "node",
        F.transform(every, lambda k: F.coalesce(F.col("b")[k]["hash"], F.lit(0))).alias("hashes"),
        F.transform(every, lambda k: F.coalesce(F.col("b")[k]["blocks"], F.lit(0))).alias("blocks"),
    ).join(nodes.select("node", "n_grams", "rep", "size"), "node")


def _verify(threshold: float):
    def compare(key: tuple, group: pa.Table) -> pa.Table:
        band, own, other = key[0].as_py(), key[2].as_py(), key[3].as_py()
        nodes, at = np.unique(np.array(group.column("node").to_pylist(), object), return_index=True)
        group = group.take(at)
        sets = [np.frombuffer(s, np.uint64) for s in group.column("grams").to_pylist()]
        lengths = np.array([len(s) for s in sets])
        documents = group.column("size").to_numpy()
        block = group.column("block").to_numpy()
        hashes = np.array(group.column("hashes").to_pylist(), np.int64)[:, :band]
        common = _intersections(sets)
        links = common >= threshold * (lengths[:, None] + lengths - common) - 1e-9
        np.fill_diagonal(links, False)
        if own != other:
            links &= block[:, None] != block
        for k in range(band):
            links &= (hashes[:, None, k] != hashes[:, k]) | (hashes[:, None, k] == 0)
        linked = np.flatnonzero(links.any(1))
        label = np.arange(len(nodes))
        while True:
            lowest = np.minimum(label, np.where(links, label, len(nodes)).min(1, initial=len(nodes)))
            if (lowest == label).all():
                break
            label = lowest
        return pa.table(
            {
                "node": pa.array(nodes[linked].tolist(), pa.binary()),
                "hook": pa.array(nodes[label[linked]].tolist(), pa.binary()),
                "n_links": pa.array((links[linked] * documents).sum(1), pa.int64()),
            }
        )

    return compare


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs."""
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    new = np.append(True, grams[1:] != grams[:-1])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    if len(column):
        column = np.cumsum(np.append(False, column[1:] != column[:-1]))
    common = np.zeros((len(sets), len(sets)))
    n_columns, step = (int(column[-1]) + 1 if len(column) else 0), 8192
    for start in range(0, n_columns, step):
        a, b = np.searchsorted(column, [start, start + step])
        incidence = np.zeros((len(sets), min(step, n_columns - start)), np.float32)
        incidence[owner[a:b], column[a:b] - start] = 1
        common += incidence @ incidence.T
    return common


def linked_nodes(
    documents: DataFrame, nodes: DataFrame, n: int, bands: int, threshold: float
) -> DataFrame:
    """node, hook and n_links, for every pair of blocks in which the node has a link."""
    shared = stage(_shared_buckets(nodes, bands), "near-shared")
    texts = documents.select(F.col("doc_id").alias("rep"), "text").join(shared, "rep")
    passed = ["node", "size", "hashes", "blocks"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, "text"):
            found = gram_sets(*text_buffers(part.column("text")), n)
            sizes = np.array([len(s) for s in found])
            # rows that share the id of a representative, but not its text, are left out
            full = np.flatnonzero(sizes)
            grams = np.concatenate([found[i] for i in full]) if len(full) else None
            digests = (
                _digests(grams, np.concatenate(([0], np.cumsum(sizes[full])[:-1]))) if len(full) else []
            )
            names = part.column("node").to_pylist()
            right = [i for i, d in zip(full.tolist(), digests) if names[i] == d]
            chosen = part.take(pa.array(right, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(chosen.column(c) for c in passed), pa.array([found[i].tobytes() for i in right], pa.binary())],
                [*passed, "grams"],
            )

    with_sets = texts.select("text", *passed).mapInArrow(
        sets, "node binary, size bigint, hashes array<bigint>, blocks array<int>, grams binary"
    )
    rows = with_sets.select("*", F.posexplode("blocks").alias("band", "n_blocks")).filter("n_blocks > 0")
    rows = rows.withColumn("hash", F.get("hashes", F.col("band"))).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("n_blocks")).cast("int")
    )
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "band", "hash",
        F.least("block", "k").alias("low"), F.greatest("block", "k").alias("high"),
        "block", "node", "size", "hashes", "grams",
    )
    return rows.groupBy("band", "hash", "low", "high").applyInArrow(
        _verify(threshold), "node binary, hook binary, n_links bigint"
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v): node and its root, the smallest node.

    Large-star and small-star steps by turns, each a minimum per node and a join, until
    nothing changes; every round is a table in shared storage.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stage(edges.distinct(), "near-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # of the smaller neighbours of u, each points to the smallest, and so does u
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.*").filter("u <> v").distinct()
        edges = stage(small, "near-edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(
    documents: DataFrame, n: int = N_WORDS, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``documents``: doc_id, class_id (smallest doc_id of its group),
    copy_id (smallest doc_id with an equal set) and n_links (documents with a Jaccard
    similarity of at least ``threshold``, copies included)."""
    bands, rows = choose_bands(threshold, recall)
    signed = stage(signatures(documents, n, bands, rows), "near-signed")
    nodes = (
        signed.filter("doc_id IS NOT NULL AND node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("size"),
            F.first("n_grams").alias("n_grams"),
            F.first("bands").alias("bands"),
        )
    )
    nodes = stage(nodes, "near-nodes")
    links = stage(linked_nodes(documents, nodes, n, bands, threshold), "near-links")
    roots = components(links.select(F.col("node").alias("u"), F.col("hook").alias("v")))
    n_links = links.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    named = (
        nodes.select("node", "rep", "size").join(n_links, "node", "left").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = stage(named, "near-named")
    classes = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    named = named.join(classes, "root").select(
        "node", "rep", "class_id", (F.col("size") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links")
    )
    found = signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
    return found.join(named, "node", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("rep", "doc_id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _row_key(documents: DataFrame) -> Column:
    """Of a row's whole content, equal for equal rows only; sorts by doc_id, null last."""
    others = [F.col(c) for c in documents.columns if c != "text"]
    lowest = F.lit(-(1 << 63)).cast("long")
    order = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(lowest)), 16, "0")
    content = F.concat_ws("\0", F.xxhash64(*others).cast("string"), F.coalesce("text", F.lit("")))
    return F.concat(F.coalesce(order, F.lit("null")), F.md5(content))


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay when each group keeps one row, the first by
    doc_id (null last), then by a hash of the row. Each row is compared by its own text,
    whatever its doc_id. Rows without words have no copies and stay."""
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    # the row travels as one column, whatever its own columns are called
    keyed = documents.filter(has_words).select(_row_key(documents).alias("key"), F.struct("*").alias("row"))
    found = near_duplicates(keyed.select(F.col("key").alias("doc_id"), "row.text"))
    stay = found.filter("doc_id = class_id").select(F.col("doc_id").alias("key")).distinct()
    # one exchange of the texts by key serves the join and the removal of equal rows
    named = keyed.join(stay.hint("merge"), "key").dropDuplicates(["key"]).select("row.*")
    return named.unionByName(documents.filter(~has_words))
