"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Nearness is the inner product. Equal vectors are one node, so that copies cannot fill
each other's lists; a node's name is a hash of its vector.

1. Start: in each of ``TREES`` random hyperplane cuts, nodes of one cell (in parts of at
   most ``CELL``) are compared with each other.
2. NN-descent: every node sends its vector (8-bit) to its neighbours and to a sample of
   the nodes that list it. Each node so becomes the centre of a join of neighbours of
   neighbours: numpy compares all who have sent, and pairs nearer than what they have go
   back. Lists keep ``K`` neighbours. Rounds are tables in shared storage and go on until
   at most a share of ``SETTLED`` of the entries changes.
3. Search: a query starts at its own node, if it is in the graph, and at the nearest of
   ``ENTRIES`` entry nodes. In each round it expands the ``WIDTH`` nearest nodes that it
   has not expanded; their neighbours are scored where their vectors lie, one message a
   query and bucket of nodes. It ends when all of its ``KNOWN`` nearest are expanded.
4. The nodes found are scored again on the original vectors in double precision, and
   copies are spelled out, at most as many as a result can hold.

Lists, messages and cells have fixed bounds, hot centres are sampled (as NN-descent
does), and every row is indexed. Rounds have no bound but ``GUARD``, beyond which the run
fails rather than give lists that are not done.

Defined results: vectors that are null, zero, of another length than most (ties: the
longer), or hold null or non-finite numbers take no part; repeated rows count once; a
query with fewer candidates gets what there is; ties go to the smaller vec_id; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workwindow.session import stage

K, REVERSE = 48, 40
TREES, CELL = 8, 1024
SETTLED = 0.01
#: New neighbours that a centre may name to one node in a round.
NAMED = 16
ENTRIES, WIDTH, KNOWN = 256, 48, 96
#: Rounds after which descent or search is taken to have failed.
GUARD = 200
#: Nodes in a bucket: what one group of a shuffle holds.
BUCKET = 512
_LISTS = "node bigint, v binary, s float, nbrs array<bigint>, scores array<float>, changed int"


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, node and vector (array<double>) of the rows that take part, each once."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", vector.alias("vector"))
    good = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(good & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("c"))
    most = lengths.orderBy(F.desc("c"), F.desc("n")).first()
    rows = rows.filter(F.size("vector") == (most.n if most else 0))
    return rows.select("vec_id", F.xxhash64("vector").alias("node"), "vector").distinct()


def _matrix(column: pa.Array, scale: pa.Array) -> np.ndarray:
    rows = np.frombuffer(b"".join(column.to_pylist()), np.int8)
    return rows.reshape(len(column), -1).astype(np.float32) * np.asarray(scale, np.float32)[:, None]


def _lists(nodes: np.ndarray, starts: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> list[pa.Array]:
    ends = pa.array(np.append(starts, len(ids)), pa.int32())
    return [
        pa.array(nodes, pa.int64()),
        pa.ListArray.from_arrays(ends, pa.array(ids, pa.int64())),
        pa.ListArray.from_arrays(ends, pa.array(scores, pa.float32())),
    ]


def _flat(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.asarray(table.column(column).combine_chunks().flatten(), kind)


def _lengths(table: pa.Table, column: str) -> np.ndarray:
    return np.asarray(pa.compute.list_value_length(table.column(column).combine_chunks()), np.int64)


def _best(owner: np.ndarray, ids: np.ndarray, scores: np.ndarray, keep: int) -> np.ndarray:
    """Places of each owner's nearest ``keep`` different ids, nearest first."""
    order = np.lexsort((-scores, ids, owner))
    first = np.ones(len(order), bool)
    first[1:] = (owner[order][1:] != owner[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    order = order[first]
    order = order[np.lexsort((ids[order], -scores[order], owner[order]))]
    own = owner[order]
    starts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, int)
    rank = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
    return order[rank < keep]


def _bucket(node: Column | str, n: int) -> Column:
    # the name is a hash already
    return F.pmod(node, F.lit(n)).cast("int")


def quantised(vectors: DataFrame) -> DataFrame:
    """Each node once: node, v (8-bit numbers) and s (their scale)."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("vector").flatten()).reshape(batch.num_rows, -1)
            scale = np.abs(x).max(1) / 127
            small = np.rint(x / scale[:, None]).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([r.tobytes() for r in small], pa.binary()), pa.array(scale, pa.float32())],
                ["node", "v", "s"],
            )

    return vectors.select("node", "vector").mapInArrow(shrink, "node bigint, v binary, s float").dropDuplicates(["node"])


def _merge(k: int):
    """Rows of nodes (lists, one with the vector) and messages to many nodes, to one row a node."""

    def merge(group: pa.Table) -> pa.Table:
        n = _lengths(group, "nbrs")
        packed = np.repeat(np.asarray(group.column("owners").is_valid()), n)
        owner = np.repeat(np.asarray(group.column("node").fill_null(0)), n)
        owner[packed] = _flat(group, "owners", np.int64)
        old = np.repeat(np.asarray(group.column("v").is_valid()), n)
        ids, scores = _flat(group, "nbrs", np.int64), _flat(group, "scores", np.float32)
        at = _best(owner, ids, scores + old * np.float32(1e-6), k)
        holders = group.filter(group.column("v").is_valid())
        names = np.asarray(holders.column("node"))
        order = np.argsort(names)
        holders, names = holders.take(order), names[order]
        starts = np.searchsorted(owner[at], names)
        ends = np.append(starts, len(at))
        new = np.array([(~old[at][a:b]).sum() for a, b in zip(ends, ends[1:])], np.int32)
        lists = _lists(names, starts, ids[at], scores[at])
        return pa.table([lists[0], holders.column("v"), holders.column("s"), lists[1], lists[2], pa.array(new, pa.int32())],
                        ["node", "v", "s", "nbrs", "scores", "changed"])

    return merge


def _merged(rows: DataFrame, n_buckets: int, k: int) -> DataFrame:
    bucket = F.coalesce("bucket", _bucket("node", n_buckets)).alias("bucket")
    rows = rows.select(bucket, "node", "v", "s", "owners", "nbrs", "scores")
    return rows.groupBy("bucket").applyInArrow(_merge(k), _LISTS)


def _with_candidates(graph: DataFrame, candidates: DataFrame) -> DataFrame:
    """Both as rows for ``_merged``; what one side lacks is null."""
    kinds = {"bucket": "int", "node": "bigint", "v": "binary", "s": "float", "owners": "array<bigint>"}
    both = [
        rows.select(
            *[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()],
            "nbrs",
            "scores",
        )
        for rows in (graph, candidates)
    ]
    return both[0].unionByName(both[1])


def start_graph(nodes: DataFrame, n: int, dim: int, k: int, trees: int, cell: int) -> DataFrame:
    """First lists, from the cells of random hyperplane cuts."""
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / cell))))
    planes = np.random.Generator(np.random.PCG64(17)).normal(size=(trees, bits, dim)).astype(np.float32)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), batch.column("s"))
            for tree in range(trees):
                code = ((x @ planes[tree].T) > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), tree, np.int32)), pa.array(code, pa.int64()), *(batch.column(c) for c in ("node", "v", "s"))],
                    ["tree", "code", "node", "v", "s"],
                )

    def compare(group: pa.Table) -> pa.Table:
        node, x = np.asarray(group.column("node")), _matrix(group.column("v"), group.column("s"))
        score = x @ x.T
        np.fill_diagonal(score, -np.inf)
        keep = min(k, len(node) - 1)
        at = np.argpartition(-score, max(keep - 1, 0), 1)[:, :keep]
        found = np.take_along_axis(score, at, 1)
        return pa.table(_lists(node, np.arange(len(node)) * keep, node[at].ravel(), found.ravel()), ["node", "nbrs", "scores"])

    cut = stage(nodes.mapInArrow(codes, "tree int, code bigint, node bigint, v binary, s float"), "ann-cells")
    parts = cut.groupBy("tree", "code").agg(F.ceil(F.count("*") / (2 * cell)).alias("parts"))
    cut = cut.join(parts, ["tree", "code"]).withColumn("part", F.pmod(F.xxhash64("node", "tree"), "parts"))
    lists = cut.drop("parts").groupBy("tree", "code", "part").applyInArrow(
        compare, "node bigint, nbrs array<bigint>, scores array<float>"
    )
    empty = [F.expr("CAST(array() AS array<bigint>)").alias("nbrs"), F.expr("CAST(array() AS array<float>)").alias("scores")]
    return _with_candidates(nodes.select("node", "v", "s", *empty), lists)


def _with_reverse(graph: DataFrame, reverse: int, seed: int) -> DataFrame:
    """Adds ``all``: a node's neighbours and a sample of the nodes that list it."""
    listed = graph.select(F.explode("nbrs").alias("to"), F.col("node").alias("by"))
    sampled = Window.partitionBy("to").orderBy(F.xxhash64("by", F.lit(seed)), "by")
    listed = listed.withColumn("nr", F.row_number().over(sampled)).filter(F.col("nr") <= reverse)
    listed = listed.groupBy("to").agg(F.collect_list("by").alias("by"))
    none = F.expr("CAST(array() AS array<bigint>)")
    joined = graph.join(listed, graph["node"] == listed["to"], "left")
    return joined.withColumn("all", F.array_distinct(F.concat("nbrs", F.coalesce("by", none)))).drop("to", "by")


def _local_joins(named: int, n_buckets: int):
    def join(group: pa.Table) -> pa.Table:
        center = np.asarray(group.column("center"))
        order = np.argsort(center, kind="stable")
        center, group = center[order], group.take(order)
        member, worst = np.asarray(group.column("node")), np.asarray(group.column("worst"))
        x = _matrix(group.column("v"), group.column("s"))
        bounds = np.flatnonzero(np.append(True, center[1:] != center[:-1]))
        owners, ids, scores = [], [], []
        for a, b in zip(bounds, np.append(bounds[1:], len(center))):
            if b - a < 2:
                continue
            score = x[a:b] @ x[a:b].T
            np.fill_diagonal(score, -np.inf)
            score[score <= worst[a:b, None]] = -np.inf
            keep = min(named, b - a - 1)
            at = np.argpartition(-score, keep - 1, 1)[:, :keep]
            found = np.take_along_axis(score, at, 1)
            good = found > -np.inf
            owners.append(np.repeat(member[a:b], good.sum(1)))
            ids.append(member[a:b][at[good]])
            scores.append(found[good])
        owner, ids, scores = (np.concatenate(z) if z else np.zeros(0, k) for z, k in ((owners, np.int64), (ids, np.int64), (scores, np.float32)))
        at = _best(owner, ids, scores, K)
        # one message to each bucket of nodes, not one a node
        to = np.mod(owner[at], n_buckets)
        order = np.argsort(to, kind="stable")
        at, to = at[order], to[order]
        starts = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, int)
        buckets, nbrs, scored = _lists(to[starts], starts, ids[at], scores[at])
        owners = pa.ListArray.from_arrays(nbrs.offsets, pa.array(owner[at], pa.int64()))
        return pa.table([buckets.cast(pa.int32()), owners, nbrs, scored], ["bucket", "owners", "nbrs", "scores"])

    return join


def neighbour_graph(nodes: DataFrame, k: int = K) -> DataFrame:
    """node, v, s, nbrs and scores (nearest first) of every node."""
    n = nodes.count()
    first = nodes.first()
    dim = len(first.v) if first else 1
    n_buckets = max(1, -(-n // BUCKET))
    graph = stage(_merged(start_graph(nodes, n, dim, k, TREES, CELL), n_buckets, k), "ann-graph")
    for round_ in range(GUARD):
        full = F.size("nbrs") >= k
        worst = F.when(full, F.element_at("scores", -1)).otherwise(F.lit(float("-inf")).cast("float"))
        sent = _with_reverse(graph, REVERSE, round_).select(
            F.explode("all").alias("center"), "node", "v", "s", worst.alias("worst")
        )
        sent = sent.select(_bucket("center", n_buckets).alias("bucket"), "center", "node", "v", "s", "worst")
        found = sent.groupBy("bucket").applyInArrow(
            _local_joins(NAMED, n_buckets),
            "bucket int, owners array<bigint>, nbrs array<bigint>, scores array<float>",
        )
        graph = stage(_merged(_with_candidates(graph, found), n_buckets, k), "ann-graph")
        changed = graph.agg(F.sum("changed")).first()[0] or 0
        if changed <= SETTLED * n * k:
            return graph
    raise RuntimeError(f"the graph has not settled after {GUARD} rounds")


def search(graph: DataFrame, queries: DataFrame, width: int = WIDTH) -> DataFrame:
    """query and node for the ``KNOWN`` nearest nodes that each query finds.

    ``queries``: node, v, s (a row a query; the node may or may not be in the graph).
    """
    n = graph.count()
    n_buckets = max(1, -(-n // BUCKET))
    entries = graph.select("node", "v", "s").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()
    if not entries:
        return queries.sparkSession.createDataFrame([], "query bigint, node bigint")
    entry_ids = np.array([e.node for e in entries])
    entry_x = np.frombuffer(b"".join(e.v for e in entries), np.int8).reshape(len(entries), -1).astype(np.float32)
    entry_x = entry_x * np.array([e.s for e in entries], np.float32)[:, None]
    adjacency = stage(_with_reverse(graph, REVERSE, 99).select("node", "nbrs", "scores", "all", "v", "s"), "ann-adjacency")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = _matrix(batch.column("v"), batch.column("s")) @ entry_x.T
            near = np.argsort(-score, 1, kind="stable")[:, :width]
            ids, scores, bounds = [], [], [0]
            for i in range(batch.num_rows):
                own = batch.column("nbrs")[i].as_py() or []
                if batch.column("nbrs")[i].is_valid:
                    own, got = [batch.column("query")[i].as_py(), *own], [np.inf, *batch.column("scores")[i].as_py()]
                else:
                    got = []
                own_ids = np.concatenate((np.array(own, np.int64), entry_ids[near[i]]))
                own_scores = np.concatenate((np.array(got, np.float32), score[i, near[i]]))
                at = _best(np.zeros(len(own_ids)), own_ids, own_scores, KNOWN)
                ids.append(own_ids[at])
                scores.append(own_scores[at])
                bounds.append(bounds[-1] + len(at))
            lists = _lists(np.zeros(0), np.array(bounds[:-1]), np.concatenate(ids), np.concatenate(scores))
            none = pa.array([[]] * batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("v"), batch.column("s"), lists[1], lists[2], none],
                ["query", "v", "s", "ids", "scores", "done"],
            )

    schema = "query bigint, v binary, s float, ids array<bigint>, scores array<float>, done array<bigint>"
    state = queries.select(F.col("node").alias("query"), "v", "s").dropDuplicates(["query"])
    state = state.join(adjacency.select(F.col("node").alias("query"), "nbrs", "scores"), "query", "left")
    state = stage(state.mapInArrow(begin, schema), "ann-state")

    def address(group: pa.Table) -> pa.Table:
        """Of all lists that one query has met: what it does not know yet, by bucket."""
        query = group.column("query")[0]
        known = np.asarray(group.column("ids")[0].values, np.int64)
        met = np.setdiff1d(_flat(group, "all", np.int64), known)
        bucket = np.mod(met, n_buckets)
        order = np.argsort(bucket, kind="stable")
        met, bucket = met[order], bucket[order]
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(met) else np.zeros(0, int)
        scores = np.asarray(group.column("scores")[0].values, np.float32)
        worst = scores[-1] if len(scores) >= KNOWN else -np.inf
        m = len(starts)
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(met)), pa.int32()), pa.array(met, pa.int64()))
        return pa.table(
            [pa.array(bucket[starts], pa.int32()), pa.array([query.as_py()] * m, pa.int64()), pa.array([group.column("v")[0].as_py()] * m, pa.binary()),
             pa.array([group.column("s")[0].as_py()] * m, pa.float32()), pa.array(np.full(m, worst), pa.float32()), lists],
            ["bucket", "query", "v", "s", "worst", "ids"],
        )

    def score_there(messages: pa.Table, held: pa.Table) -> pa.Table:
        names = np.asarray(held.column("node"))
        order = np.argsort(names)
        names = names[order]
        x = _matrix(held.column("v"), held.column("s"))[order] if len(names) else np.zeros((0, 1))
        q = _matrix(messages.column("v"), messages.column("s")) if messages.num_rows else np.zeros((0, 1))
        worst = np.asarray(messages.column("worst"))
        ids, scores, bounds = [], [], [0]
        for i in range(messages.num_rows):
            wanted = np.asarray(messages.column("ids")[i].values, np.int64)
            score = x[np.searchsorted(names, wanted)] @ q[i]
            good = score > worst[i]
            ids.append(wanted[good])
            scores.append(score[good])
            bounds.append(bounds[-1] + int(good.sum()))
        lists = _lists(
            np.zeros(0), np.array(bounds[:-1]), np.concatenate(ids) if ids else [], np.concatenate(scores) if ids else []
        )
        return pa.table([messages.column("query"), lists[1], lists[2]], ["query", "ids", "scores"])

    def update(group: pa.Table) -> pa.Table:
        """A query's list with what came back; what it has expanded is noted."""
        holder = group.filter(group.column("v").is_valid())
        ids, scores = _flat(group, "ids", np.int64), _flat(group, "scores", np.float32)
        at = _best(np.zeros(len(ids)), ids, scores, KNOWN)
        lists = _lists(np.zeros(0), np.zeros(1, int), ids[at], scores[at])
        return pa.table([holder.column("query"), holder.column("v"), holder.column("s"), lists[1], lists[2], holder.column("done")],
                        ["query", "v", "s", "ids", "scores", "done"])

    held = adjacency.select(_bucket("node", n_buckets).alias("bucket"), "node", "v", "s")
    ended = []
    for _ in range(GUARD):
        state = state.withColumn("next", F.slice(F.array_except("ids", "done"), 1, width))
        ended.append(state.filter(F.size("next") == 0).select("query", "ids"))
        state = state.filter(F.size("next") > 0)
        if state.isEmpty():
            break
        asked = state.select("query", "v", "s", "ids", "scores", F.explode("next").alias("at"))
        met = asked.join(adjacency.select(F.col("node").alias("at"), "all"), "at")
        messages = met.groupBy("query").applyInArrow(
            address, "bucket int, query bigint, v binary, s float, worst float, ids array<bigint>"
        )
        answers = messages.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(
            score_there, "query bigint, ids array<bigint>, scores array<float>"
        )
        state = state.withColumn("done", F.concat("done", "next")).drop("next")
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("v", "binary"), ("s", "float"), ("done", "array<bigint>"))]
        both = state.unionByName(answers.filter(F.size("ids") > 0).select("query", "ids", "scores", *nothing))
        state = stage(both.groupBy("query").applyInArrow(update, schema), "ann-state")
    else:
        raise RuntimeError(f"queries have nodes to expand after {GUARD} rounds")
    return reduce(DataFrame.unionByName, ended).select("query", F.explode("ids").alias("node"))


def nearest(embeddings: DataFrame, is_query: Column, n: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score: the ``n`` nearest other rows of each row for
    which ``is_query`` (on vec_id) holds."""
    vectors = stage(valid_vectors(embeddings), "ann-vectors")
    nodes = stage(quantised(vectors), "ann-nodes")
    graph = neighbour_graph(nodes)
    queries = vectors.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    asked = nodes.join(queries.select(F.col("query").alias("node")).distinct(), "node")
    found = stage(search(graph, asked), "ann-found")

    # a result can hold at most n copies besides the query itself
    copies = Window.partitionBy("node").orderBy("vec_id")
    members = vectors.withColumn("nr", F.row_number().over(copies)).filter(F.col("nr") <= n + 1)
    one = members.filter("nr = 1").select("node", "vector")
    dot = F.aggregate(F.zip_with("a", "b", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = (
        found.join(one.select("node", F.col("vector").alias("b")), "node")
        .join(one.select(F.col("node").alias("query"), F.col("vector").alias("a")), "query")
        .select("query", "node", dot.alias("score"))
    )
    # nearest nodes of a query: n + 1 are enough, its own among them
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first_id")
    first_ids = members.filter("nr = 1").select("node", F.col("vec_id").alias("first_id"))
    scored = scored.join(first_ids, "node").withColumn("at", F.row_number().over(best)).filter(F.col("at") <= n + 1)
    answers = scored.join(members.select("node", "vec_id"), "node").select("query", "vec_id", "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = answers.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= n + 1)
    answers = answers.join(queries, "query").filter("vec_id <> query_id")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= n)
        .select("query_id", "rank", "vec_id", "score")
    )
