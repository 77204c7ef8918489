"""Conversation structure repair by a grammar-compressed dynamic program.

A conversation's rows, by turn, are edited so that their role initials read
``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert (an
empty user or assistant row) 3. Blank rows and duplicates must go, a truncated row that
stays costs 3 more. Of the cheapest edits those are taken whose initials are least.

1. Steps: equal rows become one with a count, combined on the map side; only digests of
   texts travel. They are dealt out by ranges of (conversation, turn, role, digest), so a
   conversation of any length lies in order over as many tasks as it needs, in blocks of
   at most ``BLOCK`` steps. A row is a duplicate unless its place is the least of its
   (conversation, role, text).
2. Symbols: a row is a letter, for its role's initial and its fault. Re-Pair replaces the
   most frequent pairs of neighbouring symbols of all blocks by new symbols, some pairs
   that do not overlap a round; counts are made in Spark, the rules are at most
   ``ROUNDS * PER_ROUND``. What no rule covers stays as it is.
3. A symbol has one min-plus matrix: from each state of the role pattern to each other, the
   least cost and its audit, as a rope. A rule's matrix is the product of its two, made
   once a worker and shared by all blocks; a block's is the product of what is left of it.
   Blocks of a conversation meet in order, one row each, and a vector goes through them.
4. The audit, cut at the blocks again, tells each step its edit. Edits and texts meet by
   the ranges of step 1, and repaired rows come out in order.

Costs and audits form a semiring as needed: two audits of the same rows between the same
states and of equal cost never are one the beginning of the other, since what is longer
by inserts costs more; so the least stays least whatever follows.

Defined results: null roles and texts count as one space; a null conv_id is a conversation
of its own; null turns come first; equal turns go by role, then by the SHA-256 of the text;
roles with other initials than s, u, a can only be reroled or deleted. Very long texts stay
in Spark's rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workwindow.session import stage

SPACES = " \t\n\x0b\x0c\r"
#: Steps of a block.
BLOCK = 1024
#: Rounds of pair replacement, and new symbols of a round at most.
ROUNDS, PER_ROUND = 8, 32
#: Bytes of repaired text in a piece on the way to its digest.
PIECE = 1 << 20
KEY = ("conv_id", "turn", "role", "digest")


# steps


def keyed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the digest of the text, without nulls in role and text."""
    space = F.lit(" ")
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _steps(rows: DataFrame) -> DataFrame:
    """Different rows with their number, the class of their initial (0 to 2, 3: another) and
    their own fault: 0 none, 1 truncated, 2 blank."""
    end = F.rtrim("text", F.lit(SPACES))
    fault = F.when(end == "", 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.substring("role", 1, 1)
    class_ = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select(*KEY, class_.alias("class"), fault.alias("fault"))
    return narrow.groupBy(*KEY, "class", "fault").agg(F.count("*").alias("n"))


def _in_order(rows: DataFrame, *more: str) -> DataFrame:
    return rows.repartitionByRange(*KEY).sortWithinPartitions(*KEY, *more)


def _changes(batch: pa.RecordBatch, names: tuple[str, ...], last: list) -> np.ndarray:
    """Which rows differ from the one before; ``last`` keeps the row before the batch."""
    new = np.zeros(batch.num_rows, bool)
    for name in names:
        codes = np.asarray(batch.column(name).dictionary_encode(null_encoding="encode").indices)
        new[1:] |= codes[1:] != codes[:-1]
    values = [batch.column(name)[batch.num_rows - 1].as_py() for name in names]
    new[0] = not last or last[0] != [batch.column(name)[0].as_py() for name in names]
    last[:] = [values]
    return new


def _number(size: int):
    """Number the steps of a task in order, and the blocks of ``size`` that they lie in."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ord_, block, place, last = TaskContext.get().partitionId(), 0, -1, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _changes(batch, ("conv_id",), last)
            starts = np.flatnonzero(new)
            # the place of each step in its conversation's part of this task
            at = np.arange(batch.num_rows)
            began = np.where(np.cumsum(new) > 0, starts[np.cumsum(new) - 1] if len(starts) else 0, -place)
            places = at - began
            blocks = block + np.cumsum(places % size == 0)
            columns = [
                *batch.columns,
                pa.array(np.full(len(at), task), pa.int32()),
                pa.array(ord_ + at, pa.int64()),
                pa.array(blocks, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "task", "ord", "block"])
            ord_, block, place = ord_ + len(at), int(blocks[-1]), int(places[-1]) + 1

    return number


def _schema(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields), *more])


def _blocks(numbered: DataFrame) -> DataFrame:
    """One row a block: its rows as letters, how many rows each step has, its fault counts."""
    same = numbered.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("task", "ord")).alias("at"))
    firsts = same.select("at.task", "at.ord", F.lit(True).alias("first"))
    marked = numbered.join(firsts, ["task", "ord"], "left")
    first, blank = F.coalesce("first", F.lit(False)), F.col("fault") == 2
    own = F.when(first, F.col("fault")).otherwise(2)
    letter = lambda fault: F.char(65 + 3 * F.col("class") + fault)
    letters = F.concat(letter(own), F.repeat(letter(F.lit(2)), (F.col("n") - 1).cast("int")))
    step = F.struct("ord", letters.alias("letters"))
    counted = marked.groupBy("conv_id", "task", "block").agg(
        F.array_sort(F.collect_list(step)).alias("steps"),
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(blank, 0).otherwise(F.col("n") - first.cast("long"))).alias("duplicate"),
        F.count_if(first & (F.col("fault") == 1)).alias("truncated"),
    )
    return counted.select(
        "conv_id",
        "task",
        "block",
        F.array_join("steps.letters", "").alias("letters"),
        F.transform("steps", lambda s: F.length(s["letters"])).alias("sizes"),
        F.col("steps")[0]["ord"].alias("ord"),
        "blank",
        "duplicate",
        "truncated",
    )


# grammar


def _applied(text: str, rules: list[str]) -> str:
    for i, pair in enumerate(rules):
        text = text.replace(pair, chr(256 + i))
    return text


def learn_grammar(blocks: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> list[str]:
    """Pairs of symbols in the order of their replacement; the i-th becomes chr(256 + i)."""
    shapes = stage(blocks.groupBy("letters").agg(F.count("*").alias("n")), "repair-shapes")
    rules: list[str] = []

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for letters, n in zip(batch.column("letters").to_pylist(), batch.column("n").to_pylist()):
                text = _applied(letters, rules)
                for pair in {a + b for a, b in zip(text, text[1:])}:
                    counts[pair] += n * text.count(pair)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pair", "n"]
        )

    for _ in range(rounds):
        found = shapes.mapInArrow(pairs, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        best = found.filter("n > 1").orderBy(F.desc("n"), "pair").limit(4 * per_round).collect()
        heads, tails, new = set(), set(), []
        for row in best:
            head, tail = row.pair
            # a pair that overlaps one of this round waits for the next
            if len(new) < per_round and head not in tails and tail not in heads:
                heads.add(head)
                tails.add(tail)
                new.append(row.pair)
        if not new:
            break
        rules = rules + new
    return rules


# matrices


class Rope:
    """A text put together of shared parts."""

    __slots__ = ("size", "hash", "left", "right", "text")
    _MODULUS, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E6
    _FLAT = 48

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.hash = len(text), 0
            for c in text:
                self.hash = (self.hash * self._BASE + ord(c)) % self._MODULUS
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * pow(self._BASE, right.size, self._MODULUS) + right.hash) % self._MODULUS

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        if self.size + other.size <= self._FLAT:
            return Rope(str(self) + str(other))
        return Rope(left=self, right=other)

    def __str__(self) -> str:
        out, ahead = [], [self]
        while ahead:
            rope = ahead.pop()
            if rope.left is None:
                out.append(rope.text)
            else:
                ahead += (rope.right, rope.left)
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """Equal parts are passed over by their hashes, the first different ones compared."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.size == y.size and x.hash == y.hash):
                continue
            if x.left is None and y.left is None:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                a += [Rope(x.text[n:])] * (x.size > n)
                b += [Rope(y.text[n:])] * (y.size > n)
            elif y.left is None or (x.left is not None and x.size >= y.size):
                a += (x.right, x.left)
                b.append(y)
            else:
                a.append(x)
                b += (y.right, y.left)
        return not a and bool(b)


Entry = tuple[int, Rope] | None
#: States of the role pattern: nothing yet, after s, after u, after a.
STATES, ACCEPTED = 4, (0, 3)
# where a role may follow: (state before, state after)
_FOLLOWS = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
_CLASS_OUT = {0: "s", 1: "u", 2: "a"}


def _better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a if b is None else b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


class Matrix:
    """Least cost and audit between states, with what its rows tell of their neighbours."""

    def __init__(self, entries: dict[tuple[int, int], tuple[int, Rope]], first: int = -1, last: int = -1, illegal: int = 0):
        self.entries, self.first, self.last, self.illegal = entries, first, last, illegal

    def __matmul__(self, other: Matrix) -> Matrix:
        return Matrix(
            self._times(other),
            self.first if self.first >= 0 else other.first,
            other.last if other.last >= 0 else self.last,
            self.illegal + other.illegal + (self.last >= 0 and other.first >= 0 and not _legal(self.last, other.first)),
        )

    def _times(self, other: Matrix) -> dict[tuple[int, int], tuple[int, Rope]]:
        found: dict[tuple[int, int], Entry] = {}
        for (x, z), (cost, audit) in self.entries.items():
            for y in range(STATES):
                step = other.entries.get((z, y))
                if step is not None:
                    best = found.get((x, y))
                    if best is None or cost + step[0] <= best[0]:
                        found[x, y] = _better(best, (cost + step[0], audit + step[1]))
        return found


def _legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


@functools.cache
def inserts() -> Matrix:
    """The cheapest inserts between any two states."""
    paths = {(0, 2): "I", (0, 3): "II", (1, 2): "I", (1, 3): "II", (2, 3): "I", (3, 2): "I"}
    entries = {(s, s): (0, Rope()) for s in range(STATES)}
    return Matrix(entries | {way: (3 * len(text), Rope(text)) for way, text in paths.items()})


@functools.cache
def _letter(letter: str) -> Matrix:
    """Inserts before a row, then its edit."""
    class_, fault = divmod(ord(letter) - 65, 3)
    edits: dict[tuple[int, int], Entry] = {(s, s): (4, Rope("D")) for s in range(STATES)}
    if fault < 2:
        for role, ways in _FOLLOWS.items():
            for way in ways:
                if _CLASS_OUT.get(class_) == role:
                    edits[way] = _better(edits.get(way), (3 * fault, Rope("K")))
                elif role != "s":
                    edits[way] = _better(edits.get(way), (3 + 3 * fault, Rope("R")))
    both = inserts() @ Matrix(edits)
    return Matrix(both.entries, class_, class_)


class Grammar:
    """Matrices of all symbols, from the letters up."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrices: dict[str, Matrix] = {chr(65 + i): _letter(chr(65 + i)) for i in range(12)}
        for i, (head, tail) in enumerate(rules):
            self.matrices[chr(256 + i)] = self.matrices[head] @ self.matrices[tail]
        self.known: dict[str, Matrix] = {}

    def matrix(self, letters: str) -> Matrix:
        """Of a block; those of the shapes met most lately are kept."""
        if letters not in self.known:
            if len(self.known) >= 4096:
                self.known.clear()
            symbols = _applied(letters, self.rules)
            self.known[letters] = functools.reduce(Matrix.__matmul__, map(self.matrices.__getitem__, symbols))
        return self.known[letters]


@functools.lru_cache(1)
def _grammar(rules: str) -> Grammar:
    return Grammar(json.loads(rules))


def cheapest(blocks: list[str], grammar: Grammar) -> tuple[int, str, int]:
    """Cost, audit and illegal neighbours of a conversation given by the letters of its blocks."""
    start = Matrix({(0, 0): (0, Rope())})
    whole = functools.reduce(Matrix.__matmul__, map(grammar.matrix, blocks), start) @ inserts()
    best: Entry = None
    for state in ACCEPTED:
        best = _better(best, whole.entries.get((0, state)))
    return best[0], str(best[1]), whole.illegal


def _steps_of(audit: str, rows: int, at: int) -> int:
    """Where in ``audit`` the edits of the next ``rows`` rows end, from ``at`` on."""
    while rows:
        rows -= audit[at] != "I"
        at += 1
    return at


def _state_after(state: int, edits: str, class_: int) -> int:
    for edit in edits:
        if edit != "D":
            state = 1 if edit == "K" and class_ == 0 else 3 if state == 2 else 2
    return state


_JUDGED = (
    "task int, ord bigint, state tinyint, edits string, cost bigint, audit string,"
    " illegal bigint, blank bigint, duplicate bigint, truncated bigint"
)


def _judge(rules: list[str], names: list[str]):
    """Of blocks in order: a row for each step that is not just deleted, with the state before
    it, and a row for each conversation."""
    packed = json.dumps(rules)

    def conversation(blocks: list[dict]) -> Iterator[tuple]:
        cost, audit, illegal = cheapest([b["letters"] for b in blocks], _grammar(packed))
        state, at = 0, 0
        for i, block in enumerate(blocks):
            row = 0
            for k, size in enumerate(block["sizes"]):
                end = _steps_of(audit, 1, at)
                # the others of a step are equal to its first, so they are deleted; inserts
                # among them come after it
                rest = _steps_of(audit, size - 1, end)
                edits = audit[at:end] + audit[end:rest].replace("D", "")
                at = rest
                if i == len(blocks) - 1 and k == len(block["sizes"]) - 1:
                    edits += audit[at:]
                if edits != "D":
                    yield block["task"], block["ord"] + k, state, edits, *[None] * 6
                    state = _state_after(state, edits, (ord(block["letters"][row]) - 65) // 3)
                row += size
        sums = (sum(b[name] for b in blocks) for name in ("blank", "duplicate", "truncated"))
        yield None, None, None, None, cost, audit, illegal, *sums

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, ids, open_, last = [], [], [], []
        types = [pa.int32(), pa.int64(), pa.int8(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 4]

        def emit(kind: pa.DataType) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns], names)

        kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field("conv_id").type
            new = _changes(batch, ("conv_id",), last).tolist()
            for starts, block in zip(new, batch.to_pylist()):
                if starts and open_:
                    rows = list(conversation(open_))
                    out += rows
                    ids += [open_[0]["conv_id"]] * len(rows)
                    open_ = []
                open_.append(block)
                if len(out) > 10_000:
                    yield emit(kind)
                    out.clear()
                    ids.clear()
        if open_:
            rows = list(conversation(open_))
            out += rows
            ids += [open_[0]["conv_id"]] * len(rows)
        if out:
            yield emit(kind)

    return judge


# repaired rows


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch once, so that many copies of one row do not travel."""
    for batch in batches:
        rows = pa.array(np.arange(batch.num_rows))
        table = pa.Table.from_batches([batch.select(list(KEY))]).append_column("at", rows)
        first = table.group_by(list(KEY), use_threads=False).aggregate([("at", "min")])
        yield batch.take(first.column("at_min").combine_chunks().sort())


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits meet the texts that follow them; repaired rows in order."""
    task, place, last, edits = TaskContext.get().partitionId(), 0, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        out = []
        new = _changes(batch, KEY, last).tolist()
        given = zip(new, batch.column("state").to_pylist(), batch.column("edits").to_pylist())
        for i, (starts, *found) in enumerate(given):
            if starts:
                edits = None
            if found[1] is not None:
                edits = found
            elif edits is not None:
                (state, text), edits = edits, None
                for edit in text.replace("D", ""):
                    role = "assistant" if state == 2 else "user"
                    if edit == "K":
                        role = batch.column("role")[i].as_py()
                    state = 1 if edit == "K" and role[:1] == "s" else 3 if state == 2 else 2
                    out.append((i, place, {"I": "insert", "K": "keep", "R": "rerole"}[edit], role))
                    place += 1
        rows, places, names, roles = zip(*out) if out else [()] * 4
        rows, names = pa.array(rows, pa.int64()), pa.array(names, pa.string())
        texts = pc.if_else(pc.equal(names, "insert"), "", batch.column("text").take(rows))
        columns = [
            batch.column("conv_id").take(rows),
            pa.array([task] * len(out), pa.int32()),
            pa.array(places, pa.int64()),
            names,
            pa.array(roles, pa.string()),
            texts,
        ]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "task", "place", "edit", "role", "text"])


def repair(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Of ``turns`` (conv_id, turn, role, text): a row for each conversation with cost, audit,
    illegal, blank, duplicate, truncated and gaps; and the repaired rows (conv_id, edit,
    role, text), a conversation's in order of task and place."""
    rows = keyed(turns)
    kind = turns.schema["conv_id"].dataType.simpleString()
    steps = stage(_steps(rows), "repair-steps")
    in_order = _in_order(steps)
    numbered = in_order.mapInArrow(_number(block), _schema(steps, "task int", "ord bigint", "block bigint"))
    numbered = stage(numbered, "repair-numbered")
    blocks = stage(_blocks(numbered), "repair-blocks")
    rules = learn_grammar(blocks)
    names = ["conv_id", *(c.split()[0] for c in _JUDGED.split(", "))]
    by_conversation = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "task", "block")
    judged = stage(
        by_conversation.mapInArrow(_judge(rules, names), f"conv_id {kind}, {_JUDGED}"), "repair-judged"
    )
    turn = F.col("turn")
    seen = numbered.groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = seen.groupBy(F.col("conv_id").alias("id")).agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).alias("gaps")
    )
    found = judged.filter("audit IS NOT NULL").drop("task", "ord", "state", "edits")
    found = found.join(gaps, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")

    edits = judged.filter("edits IS NOT NULL").select("task", "ord", "state", "edits")
    edits = numbered.join(edits, ["task", "ord"]).select(*KEY, F.lit(None).cast("string").alias("text"), "state", "edits")
    nothing = {"state": F.lit(None).cast("tinyint"), "edits": F.lit(None).cast("string")}
    texts = rows.select(*KEY, "text")
    texts = texts.mapInArrow(_once, _schema(texts)).withColumns(nothing)
    both = edits.unionByName(texts).withColumn("after", F.col("edits").isNull())
    out = f"conv_id {kind}, task int, place bigint, edit string, role string, text string"
    return found, _in_order(both, "after").mapInArrow(_apply, out)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired ``role:text`` lines, joined by line breaks.

    Lines are put together where they were made; a conversation's pieces then pass
    through one hash in order."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, names = [], ["conv_id", "task", "place", "piece"]
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _changes(batch, ("conv_id",), last)
            lines = [f"{r}:{t}".encode() for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            upto = np.cumsum([len(line) + 1 for line in lines]) // PIECE
            new[0] = True
            new[1:] |= upto[1:] != upto[:-1]
            starts = np.flatnonzero(new).tolist()
            joined = [b"\n".join(lines[a:b]) for a, b in zip(starts, [*starts[1:], len(lines)])]
            head = batch.select(names[:3]).take(pa.array(starts))
            yield pa.RecordBatch.from_arrays([*head.columns, pa.array(joined, pa.binary())], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, open_ = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            done = []
            ids = batch.column("conv_id")
            for i, (starts, piece) in enumerate(zip(_changes(batch, ("conv_id",), last).tolist(), batch.column("piece"))):
                if not starts:
                    open_[1].update(b"\n")
                else:
                    done += [open_] if open_ else []
                    open_ = (ids[i].as_py(), hashlib.sha256())
                open_[1].update(piece.as_buffer())
            yield closed(done, ids.type)
        if open_:
            yield closed([open_], ids.type)

    def closed(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in done], kind), pa.array([h.hexdigest() for _, h in done], pa.string())],
            ["conv_id", "repaired_sha256"],
        )

    cut = repaired.mapInArrow(pieces, f"conv_id {kind}, task int, place bigint, piece binary")
    ordered = cut.repartition("conv_id").sortWithinPartitions("conv_id", "task", "place")
    return ordered.mapInArrow(digest, f"conv_id {kind}, repaired_sha256 string")


def report(conversations: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for every conv_id of ``conversations``: its figures in ``turns`` and the digest of
    its repaired lines; zeros and empty texts where ``turns`` has none of it."""
    found, repaired = repair(turns, block)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = [conversations.select("conv_id").distinct(), found, digests(repaired)]
    whole = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.groupBy("conv_id").agg(
        *(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts),
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults planted by a hash of conversation and turn."""
    space = F.lit(" ")
    text = lambda name: F.coalesce(F.col(name).cast("string"), space)
    kind = F.crc32(F.encode(F.concat(text("conv_id"), F.lit(":"), text("turn")), "utf-8")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    rows = rows.filter("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")
