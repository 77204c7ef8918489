"""Conversation repair and sequence packing against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from workwindow.llm import packing, repair
from workwindow.llm.common import tokenizer

# conversation repair

SPACE = " \t\n\x0b\x0c\r"
INSERTS = {(s, s): "" for s in range(4)} | {(0, 2): "I", (0, 3): "II", (1, 2): "I", (1, 3): "II", (2, 3): "I", (3, 2): "I"}
KEEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
REROLES = {0: 2, 1: 2, 3: 2, 2: 3}


def brute_repair(rows):
    """All of one conversation's figures, its rows as (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(SPACE)
        kind = "none" if body[-1:] in ".!?" else "truncated"
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else kind)
        seen.add((role, text))
    paths = {0: (0, "")}
    for (_, role, _), fault in zip(rows, faults):
        new = {}
        for x, (cost, audit) in paths.items():
            for (a, z), said in INSERTS.items():
                ways = [(z, "D", 4)]
                if fault in ("none", "truncated"):
                    more = 3 * (fault == "truncated")
                    ways.append((REROLES[z], "R", 3 + more))
                    if z in KEEPS.get(role[:1], {}):
                        ways.append((KEEPS[role[:1]][z], "K", more))
                for y, letter, price in ways if a == x else []:
                    found = (cost + 3 * len(said) + price, audit + said + letter)
                    new[y] = min(new.get(y, found), found)
        paths = new
    ends = [(c + 3 * len(said), a + said) for x, (c, a) in paths.items() for (f, z), said in INSERTS.items() if f == x and z in (0, 3)]
    cost, audit = min(ends)
    lines, state, at = [], 0, iter(rows)
    for letter in audit:
        row = next(at) if letter != "I" else None
        if letter != "D":
            role = row[1] if letter == "K" else "assistant" if state == 2 else "user"
            state = 1 if role[:1] == "s" else 3 if state == 2 else 2
            lines.append((role, row[2] if row else ""))
    turns = {t for t, _, _ in rows if t is not None}
    pairs = zip(rows, rows[1:])
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{kind: faults.count(kind) for kind in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    }, lines


@pytest.fixture(scope="module")
def talks():
    dice = random.Random(11)
    texts = ["Yes.", "No!", "cut", "Why?", "", " \n\t", "more text here", None, "end.  "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "umpire"]
    found = {i: [(dice.choice([None, *range(12)]), dice.choice(roles[: 4 + i % 6]), f"{dice.choice(texts[:4])}{k}" if dice.random() < 0.6 else dice.choice(texts))
             for k in range(dice.randint(1, 14))] for i in range(120)}
    found[None] = [(1, "user", "a."), (2, "user", "b."), (2, "user", "b.")]
    found[500] = [(5, "user", "same.")] * 300 + [(6, "assistant", "x" * 200_000 + ".")]
    found[501] = [(i, "assistant" if i % 2 else "user", f"{i}." if i % 7 else f"{i}") for i in range(700)]
    return found


def make(spark, talks):
    rows = [(c, t, r, x, "z") for c, turns in talks.items() for t, r, x in turns]
    random.Random(1).shuffle(rows)
    schema = "conv_id bigint, turn bigint, role string, text string, task string"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("block", [5, repair.BLOCK])
def test_repair_is_the_cheapest_and_least(spark, talks, block):
    turns = make(spark, talks)
    more = spark.createDataFrame([(900,), (0,)], "conv_id bigint")
    found = repair.report(turns.select("conv_id").union(more), turns, block).collect()
    assert len(found) == len(talks) + 1
    for row in found:
        want = brute_repair(talks.get(row.conv_id, []))[0]
        assert {k: row[k] for k in want} == want, row.conv_id


def test_repaired_rows_come_in_order(spark, talks):
    _, rows = repair.repair(make(spark, talks), 7)
    found = {}
    for row in sorted(rows.collect(), key=lambda r: (r.task, r.place)):
        found.setdefault(row.conv_id, []).append((row.role, row.text))
    assert found == {c: lines for c, turns in talks.items() if (lines := brute_repair(turns)[1])}


def test_repair_of_nothing(spark):
    nothing = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair.report(nothing, nothing).count() == 0


def test_grammar_changes_no_result(spark):
    dice = random.Random(3)
    texts = ["".join(dice.choice("DEGHJ") for _ in range(60)) for _ in range(6)] + ["DGDG" * 20, "F" * 40]
    blocks = spark.createDataFrame([(t,) for t in texts for _ in range(3)], "letters string")
    rules = repair.learn_grammar(blocks, rounds=5)
    assert len(rules) > 5 and max(map(len, (repair._applied(t, rules) for t in texts))) < 40
    for text in texts:
        assert repair.cheapest([text], repair.Grammar(rules)) == repair.cheapest(list(text), repair.Grammar([]))


def test_ropes_compare_as_texts():
    dice = random.Random(5)
    ropes = [repair.Rope("".join(dice.choice("DK") for _ in range(dice.randint(0, 40)))) for _ in range(30)]
    for _ in range(300):
        a, b = dice.choice(ropes), dice.choice(ropes)
        assert str(a + b) == str(a) + str(b)
        assert (a + b < b + a) == (str(a + b) < str(b + a))
        ropes.append(a + b if a.size + b.size < 5000 else a)


# packing


def one_by_one(lengths, capacity):
    """Best-two-fit, one sequence after the other: how many."""
    left, n = sorted(lengths, reverse=True), 0
    while left:
        taken, room = [], capacity
        for x in left:
            if x <= room:
                taken.append(x)
                room -= x
        rest = list((Counter(left) - Counter(taken)).elements())
        if room and len(taken) > 1:
            pairs = [a + b for i, a in enumerate(rest) for b in rest[:i] if taken[-1] < a + b <= room + taken[-1]]
            if pairs:
                total = max(pairs)
                pair = max((a, b) for i, a in enumerate(rest) for b in rest[:i] if a + b == total)
                taken = taken[:-1] + list(pair)
        left = sorted((Counter(left) - Counter(taken)).elements(), reverse=True)
        n += 1
    return n


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_that_of_one_sequence_after_the_other(seed):
    dice = random.Random(seed)
    capacity = dice.choice([20, 50, 100])
    lengths = [dice.randint(1, capacity if seed % 2 else capacity // 2) for _ in range(dice.randint(1, 80))]
    patterns = packing.best_two_fit(Counter(lengths), capacity)
    held = Counter()
    for taken, times in patterns:
        assert sum(length * n for length, n in taken.items()) <= capacity
        for length, n in taken.items():
            held[length] += n * times
    assert held == Counter(lengths)
    assert sum(times for _, times in patterns) == one_by_one(lengths, capacity)


def test_two_shorter_pieces_replace_the_shortest():
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10) == [({6: 1, 2: 2}, 1), ({3: 1}, 1)]


def test_packed_sequences_hold_every_document(spark, docs, prose):
    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    texts = [None, "", "one", "one", "x <|endoftext|> y", "naïve " * 900, *(prose(i, 1 + i % 9) for i in range(60))]
    rows = [*enumerate(texts), (None, "no id"), (3, "again")]
    pieces = packing.pieces_of(docs(rows, more=True).repartition(3), path, 64)
    packed = packing.pack(pieces, 64)
    found = packed.collect()
    want = Counter()
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), 64)):
            part = ids[start : start + 64]
            want[i, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    bins = {}
    for row in found:
        bins.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for spans in bins.values():
        ends = [0]
        for offset, length in sorted(spans):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 64
    assert len(bins) == one_by_one([r.length for r in found], 64)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for row in found:
        part = whole[row.sequence_id].ids[row.offset : row.offset + row.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == row.ids_crc32
    assert packing.pack(packing.pieces_of(docs([]), path)).count() == 0
