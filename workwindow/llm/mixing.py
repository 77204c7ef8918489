"""Mixing sources to target weights with exact block quotas and a splitting tree.

DataFrame functions only.

1. Sizes (words) per source; targets by weight, capped at ``max_repeats`` times the
   source, the excess shared again by weight (closed form over sorted caps).
2. Documents are dealt to permuted blocks of about ``block_docs`` documents of one
   source. A source is drawn ``floor(target / size)`` times whole; of one more round
   it takes the first blocks of its permutation, and of the block on the edge the
   first documents, so that the words come as near to the target as documents allow.
3. The number of block draws of each source is its exact quota. A binary tree splits
   the quotas among ``shards``: in a node every draw is an anonymous ticket, tickets
   are put in random order, and one half goes left: counts by source then follow the
   multivariate hypergeometric law. Only counts go down the tree.
4. The quota of a shard is a run of the source's permuted draws, so shards are
   disjoint. Rows are ordered inside a shard by a hash.

Keys are MD5 of the seed and the row's id, of rows without id the seed and the text's MD5:
reruns and other engines agree, and rows without id spread over the blocks by their texts.

No group grows with the documents: windows run over blocks of a source (documents /
``block_docs``), over the tickets of a node and over the documents of the edge blocks.
Documents meet their source's row through a salted join, as a source may hold a third
of all rows; nothing is broadcast by hint.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; a source without words has target 0 and takes nothing; repeated rows count as
documents of their own, and as copies of one id share a key, they are taken in any order,
whole; no document is taken more than ``max_repeats`` times; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workwindow.llm.common import WORD
from workwindow.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_DOCS = 1024
SHARDS = 16
SALTS = 64
SEED = "mix-1"


def key_of(*parts: Column | str) -> Column:
    """A number below 2**60 from the MD5 of the parts."""
    digest = F.md5(F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id, or without, by their texts."""
    return F.md5(F.coalesce(text, F.lit("")))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], share: float, max_repeats: int
) -> DataFrame:
    """``sizes``: source, source_size, n_docs (one row per source). Adds weight and target.

    With caps c and weights w, the targets are min(c, w * level) for the one level at
    which they add up to the share. Sorted by c / w, sources below the level are
    capped; the level is tried at every place of that order. One row per source passes
    through these windows.
    """
    cap = max_repeats * F.col("source_size")
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("_fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")
    )
    rows = (
        sizes.withColumn("weight", weight.cast("long"))
        .withColumn("_fill", cap / F.col("weight"))
        .withColumn("_wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_capped", F.sum(cap).over(by_fill) - cap)
        .withColumn(
            "_rest",
            F.sum("weight").over(everything) - F.sum("weight").over(by_fill) + F.col("weight"),
        )
        .withColumn("_level", (F.col("_wanted") - F.col("_capped")) / F.col("_rest"))
        .withColumn("_fits", F.col("_level") <= F.col("_fill"))
        .withColumn("_open", F.max(F.col("_fits").cast("int")).over(by_fill) == 1)
    )
    first = F.first(F.when(F.col("_fits"), F.col("_level")), ignorenulls=True).over(
        by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("_open"), F.col("weight") * first).otherwise(cap.cast("double"))
    return rows.withColumn("target", F.coalesce(target, F.lit(0.0))).select(
        "source", "source_size", "n_docs", "weight", "target"
    )


def split_quotas(quotas: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """Split the draws of each source among ``shards`` (a power of two).

    ``quotas``: source, quota. Returns source, shard, quota, first: the shard takes the
    source's draws first .. first + quota - 1.
    """
    depth = shards.bit_length() - 1
    if shards != 1 << depth:
        raise ValueError("shards must be a power of two")
    level = quotas.select(F.lit(0).cast("long").alias("node"), "source", "quota")
    for d in range(depth):
        tickets = level.filter("quota > 0").select(
            "node", "source", F.explode(F.sequence(F.lit(1).cast("long"), "quota")).alias("ticket")
        )
        shuffled = Window.partitionBy("node").orderBy(
            key_of(seed, f"split{d}", F.col("node"), F.coalesce("source", F.lit("\0")), F.col("ticket")),
            "ticket",
        )
        half = F.ceil(F.count("*").over(Window.partitionBy("node")) / 2)
        side = (F.row_number().over(shuffled) > half).cast("long")
        level = (
            tickets.withColumn("node", F.col("node") * 2 + side)
            .groupBy("node", "source")
            .agg(F.count("*").alias("quota"))
        )
    runs = Window.partitionBy("source").orderBy("node")
    return level.select(
        "source",
        F.col("node").cast("int").alias("shard"),
        "quota",
        (F.sum("quota").over(runs) - F.col("quota") + 1).alias("first"),
    )


def deal_blocks(
    sized: DataFrame,
    targets: DataFrame,
    max_repeats: int,
    block_docs: int,
    seed: str,
) -> tuple[DataFrame, DataFrame]:
    """Documents with their block, and one row per block with the times it is drawn.

    Of the last draw of the block on the edge (``edge``) only the first ``left_over``
    words are wanted.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = targets.select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        F.ceil(F.col("n_docs") / block_docs).alias("n_blocks"),
        F.coalesce(rounds, F.lit(0)).alias("rounds"),
    ).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    spread = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null-"), F.col("text_key")))
    docs = sized.withColumn("doc_key", key_of(seed, named)).withColumn(
        "doc_salt", F.pmod("doc_key", F.lit(SALTS)).cast("int")
    )
    # null-safe, as a null source is a source of its own
    docs = docs.join(
        spread,
        F.col("source").eqNullSafe(F.col("s")) & (F.col("doc_salt") == F.col("salt")),
    )
    # the high digits choose the block, as the low ones have chosen the salt
    docs = docs.withColumn("block", F.expr(f"pmod(doc_key div {SALTS}, n_blocks)"))
    docs = stage(docs.drop("s", "salt", "doc_salt", "n_blocks"), "mix-docs")

    permuted = Window.partitionBy("source").orderBy(
        key_of(seed, "block", F.col("source"), F.col("block")), "block"
    )
    end = F.sum("block_size").over(permuted)
    blocks = (
        docs.groupBy("source", "block")
        .agg(F.sum("size").alias("block_size"), *[F.first(c).alias(c) for c in ("rounds", "rest")])
        .withColumn("block_pos", F.row_number().over(permuted).cast("long"))
        .withColumn("left_over", F.col("rest") - (end - F.col("block_size")))
        .withColumn("edge", (F.col("left_over") > 0) & (F.col("left_over") < F.col("block_size")))
        .withColumn(
            "times",
            F.least(F.col("rounds") + (F.col("left_over") > 0).cast("int"), F.lit(max_repeats)).cast("int"),
        )
        .select("source", "block", "block_pos", "left_over", "edge", "times")
    )
    return docs, stage(blocks, "mix-blocks")


def draw_blocks(blocks: DataFrame, shards: int, seed: str) -> DataFrame:
    """Give every draw of a block its shard: blocks with ``block_shards`` (one for each time)."""
    quotas = blocks.groupBy("source").agg(F.sum("times").alias("quota"))
    runs = split_quotas(quotas, shards, seed)
    taken = runs.select(
        F.col("source").alias("s"),
        "shard",
        F.explode(F.sequence("first", F.col("first") + F.col("quota") - 1)).alias("nr"),
    )
    draws = blocks.filter("times > 0").select(
        "source", "block", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("copy"), "block_pos"
    )
    in_order = Window.partitionBy("source").orderBy("copy", "block_pos")
    draws = draws.withColumn("draw", F.row_number().over(in_order).cast("long"))
    placed = draws.join(
        taken, F.col("source").eqNullSafe(F.col("s")) & (F.col("draw") == F.col("nr"))
    )
    placed = placed.groupBy("source", "block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("block_shards")
    )
    none = F.expr("CAST(array() AS array<int>)")
    placed = placed.select(F.col("source").alias("s"), F.col("block").alias("b"), "block_shards")
    return blocks.join(
        placed, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left"
    ).withColumn("block_shards", F.coalesce("block_shards", none)).drop("s", "b")


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    block_docs: int = BLOCK_DOCS,
    shards: int = SHARDS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, text_key, size, source_size, target, doc_key and
    ``shards``, the output shard of each copy that the mix takes (empty: not taken)."""
    sized = documents.select(
        "doc_id", "source", text_key(F.col("text")).alias("text_key"), n_words(F.col("text")).alias("size")
    )
    sized = stage(sized, "mix-sizes")
    by_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    targets = stage(source_targets(by_source, weights, share, max_repeats), "mix-targets")
    docs, blocks = deal_blocks(sized, targets, max_repeats, block_docs, seed)
    drawn = stage(draw_blocks(blocks, shards, seed), "mix-draws").select(
        F.col("source").alias("s"), F.col("block").alias("b"), "left_over", "edge", "block_shards"
    )
    docs = docs.join(drawn, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))

    # on the edge, documents whose middle lies before the place of the target
    on_edge = docs.filter("edge")
    inside = Window.partitionBy("source").orderBy("doc_key", "doc_id", "size", "text_key")
    middle = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    last = F.size("block_shards") - (middle > F.col("left_over")).cast("int")
    on_edge = on_edge.withColumn("shards", F.slice("block_shards", F.lit(1), last))
    whole = docs.filter("NOT edge").withColumn("shards", F.col("block_shards"))
    return whole.unionByName(on_edge).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", "doc_key", "shards"
    )


def mixed_rows(mix: DataFrame, seed: str = SEED) -> DataFrame:
    """Every copy in the mix: doc_id, source, size, copy, shard, place. Reading a shard
    in the order of ``place`` gives its rows shuffled."""
    return mix.select("doc_id", "source", "size", F.posexplode("shards").alias("copy", "shard")).withColumn(
        "place", key_of(seed, "row", F.col("doc_id"), F.col("copy"))
    )
