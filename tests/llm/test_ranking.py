"""Ranked search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from workwindow.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, top):
    bags = [(d, Counter(terms(t))) for d, t in documents]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_all = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for d, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in set(terms(text)) & set(bag)
            )
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus(prose):
    texts = [None, "", " \n!?", "one", "ONE Éa é 日本 x9", "x" * 50_000, "river mill " * 5000, "the\x00river_mill{9}~Å"]
    rows = [*enumerate(texts), *((20 + i, prose(i % 9, 1 + i % 4)) for i in range(60))]
    rows += [(1000 - i, "the old mill by the river") for i in range(40)]
    return [*rows, (25, "lighthouse mill"), (None, "lighthouse mill"), (None, prose(3)), (25, "lighthouse mill")]


@pytest.mark.parametrize(("top", "block"), [(50, ranking.BLOCK_BYTES), (3, 60)])
def test_ranking_is_that_of_all_scores(spark, docs, corpus, prose, top, block):
    items = [(1, "The river, the MILL"), (2, None), (3, "..."), (1, "lighthouse é"), (None, "one"), (4, prose(2)), (5, "zebra"), (6, "The river, the MILL")]
    table = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, key string")
    found = ranking.ranked(docs(corpus, more=True).repartition(5), table, top, block).collect()
    assert sorted(map(tuple, found), key=str) == brute(corpus, items, top)


def test_ranking_of_nothing(spark, docs):
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert ranking.ranked(docs([]), items).count() == 0
    assert ranking.ranked(docs([(1, "a")]), items.filter("false")).count() == 0


def test_a_class_is_one_row_of_its_smallest_ids(spark, docs):
    items = ranking.Items.of(["a b"])
    name = ranking.shared_bytes(spark, "items", items.dump())
    rows = [(i, "b a z" if i % 2 else "a z b") for i in range(300, 0, -1)] + [(7, "a b")]
    bagged = ranking.bags(docs(rows).repartition(4), name)
    found = ranking.classes(bagged, ranking.lengths(301, 902), 5).collect()
    assert sorted(list(r.members) for r in found) == [[1, 2, 3, 4, 5], [7]]


def test_terms_are_those_of_the_pattern():
    texts = ["".join(map(chr, range(256))), None, "", "AÄa-ß9", "ſK  x"]
    found, row = ranking.terms_of(pa.array(texts, pa.string()))
    want = [(i, t) for i, text in enumerate(texts) for t in terms(text)]
    assert list(zip(row.tolist(), found.to_pylist())) == want
    assert np.asarray(ranking.weights(np.array([1, 3]), 3)).tolist() == [980, 133]
