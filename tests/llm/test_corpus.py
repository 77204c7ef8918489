"""Operators on whole tables: licences, neighbours, chat, pages, duplicates, mixing, pipeline."""

import hashlib
import random
import json
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from workwindow.llm import chat, extraction, licenses, mixing, near_duplicates, neighbours
from workwindow.session import stage

# licences


def test_licences_of_files_and_of_directories(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    rows = [
        ("a/LICENSE", apache), ("a/b/c.py", "plain text here"), ("a/b/d.py", f"code\n{mit}\ncode and more code here"),
        ("a/b/COPYING", mit), ("a/x.py", None), ("z/y.py", ""), (None, mit), ("a/x.py", None),
        ("top.py", "We have no permission to tell."), ("z/long.py", "word " * 20_000 + "\n" + apache),
    ]
    files = spark.createDataFrame(rows, "path string, text string").withColumn("score", F.lit("clash"))
    found = {}
    for r in licenses.scan(files).collect():
        found.setdefault(r.path, []).append((r.own_license, r.license_id, r.from_dir, r.is_license_file))
    assert found["a/LICENSE"] == [("apache-2.0", "apache-2.0", None, True)]
    assert found["a/b/c.py"] == [(None, "mit", "a/b", False)]
    assert found["a/b/d.py"] == [("mit", "mit", None, False)]
    assert found["a/x.py"] == [(None, "apache-2.0", "a", False)] * 2
    assert found["z/y.py"] == [(None, None, None, False)]
    assert found["z/long.py"] == [("apache-2.0", "apache-2.0", None, False)]
    assert found["top.py"][0][:2] == (None, None) and found[None][0][:2] == (None, None)
    assert licenses.scan(files.filter("false")).count() == 0


def test_no_line_is_passed_over_that_matches(spark):
    """Short names, first lines of wrapped headers, and headers wrapped over lines."""
    lines = {
        "CC BY-SA 4.0": "cc-by-sa-4.0",
        "This Source Code Form is subject to the terms of the Mozilla": "mpl-2.0",
        "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted "
        "provided that the following\n# conditions are met: redistributions of source code must retain\n"
        "# the above copyright notice": "bsd-3-clause",
    }
    code = [f"value{i} = compute{i}(argument{i})" for i in range(4000)]
    rows = [(f"d/f{i}.py", "\n".join([text, "#", *code])) for i, text in enumerate(lines)]
    rows += [(f"e{i}/whole", text) for i, text in enumerate(lines)]
    # many texts with common words, which so weigh little
    rows += [(f"f{i}/x", "this is the thing and that is to be of a form for you in it") for i in range(300)]
    found = licenses.own_licenses(spark.createDataFrame(rows, "path string, text string")).collect()
    got = {r.path: (r.license_id, r.n_notices, r.is_license_file) for r in found}
    for i, name in enumerate(lines.values()):
        assert got[f"d/f{i}.py"] == (name, 1, False)
        assert got[f"e{i}/whole"] == (name, 1, True)


def test_matches_are_those_of_all_cosines(spark):
    dice = random.Random(4)
    texts = []
    for _ in range(400):
        terms = licenses._terms(dice.choice(licenses.TEMPLATES)[1])
        noise = ["alpha", "beta", "the", "of", "this", "software"] * 2
        texts.append(" ".join(dice.sample(terms, dice.randint(1, len(terms))) + dice.sample(noise, dice.randint(0, 8))))
    files = spark.createDataFrame(list(enumerate(texts)), "path string, text string")
    weights = {r.term: r.weight for r in licenses.term_weights(files).collect()}
    templates = [{t: licenses._terms(x).count(t) * weights[t] for t in licenses._terms(x)} for _, x in licenses.TEMPLATES]
    want = {}
    for i, text in enumerate(texts):
        unit = {t: licenses._terms(text).count(t) * weights.get(t, 1.0) for t in licenses._terms(text)}
        size = lambda v: sum(x * x for x in v.values()) ** 0.5
        score = max(sum(unit.get(t, 0) * w for t, w in v.items()) / size(v) / size(unit) for v in templates)
        if abs(score - 0.6) > 1e-6 and score >= 0.6:
            want[str(i)] = round(score, 6)
    found = {r.path: r.score for r in licenses.own_licenses(files).collect()}
    assert found.keys() == want.keys() and 50 < len(want) < 350
    assert all(found[i] == pytest.approx(score, abs=2e-6) for i, score in want.items())


def test_files_without_doc_id_are_scanned(spark, tmp_path):
    from workwindow.llm.queries import QUERIES

    rows = [(None, "Released under the MIT License", "en", "s"), (3, "plain", "en", "s"), (None, "plain", None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op2_license_scan"](spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.path, str(r.license_id)) for r in found) == [
        ("3", "s/en/3", "mit"), ("None", "//", "None"), ("None", "s/en/", "mit")]


def test_telling_terms_bound_the_cosine():
    weights = {t: 1 + 5 * (i % 7) / 7 for i, t in enumerate(licenses.VOCABULARY)}
    telling = set(licenses.telling_terms(weights))
    for _, text in licenses.TEMPLATES:
        terms = licenses._terms(text)
        vector = {t: terms.count(t) * weights[t] for t in set(terms)}
        rest = sum(w * w for t, w in vector.items() if t not in telling)
        assert rest < 0.36 * sum(w * w for w in vector.values())
        assert telling & set(terms)


def test_squares_of_counts(spark):
    texts = [[], ["a"], ["b", "a", "b", "c", "b"], ["x"] * 40]
    rows = spark.createDataFrame([(t,) for t in texts], "words array<string>")
    found = [r[0] for r in rows.select(licenses._sum_of_squares(F.col("words"))).collect()]
    assert found == [0, 1, 9 + 1 + 1, 1600]


def test_every_template_is_its_own_best_match(spark):
    rows = [(f"d/{i}", f"before it\n{text}\nafter it") for i, (_, text) in enumerate(licenses.TEMPLATES)]
    found = licenses.own_licenses(spark.createDataFrame(rows, "path string, text string")).collect()
    got = {int(r.path[2:]): r.license_id for r in found}
    assert got == {i: name for i, (name, _) in enumerate(licenses.TEMPLATES)}


# neighbours


def brute_nearest(ids, x, query, n):
    scores = x @ x[ids.index(query)]
    order = sorted((i for i in range(len(ids)) if ids[i] != query), key=lambda i: (-scores[i], ids[i]))
    return [ids[i] for i in order[:n]]


def test_neighbours_against_brute_force(spark):
    random = np.random.default_rng(4)
    x = random.normal(size=(1500, 24))
    rows = [(i, [float(np.float32(v)) for v in x[i]]) for i in range(len(x))]
    copy = rows[40][1]
    odd = [(5001, None), (5002, [0.0] * 24), (5003, [1.0]), (5004, [float("nan")] + [1.0] * 23), (5005, [None] * 24)]
    rows += [(6000 + k, copy) for k in range(30)] + odd + [rows[7], (None, copy)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("node", F.lit("x"))
    found = neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()
    good = dict(r for r in rows if r[0] is not None and r[0] not in range(5001, 5006))
    ids, vectors = list(good), np.array(list(good.values()))
    hits = total = 0
    for query in sorted({r.query_id for r in found}):
        got = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == query)
        want = brute_nearest(ids, vectors, query, 20)
        assert [g[0] for g in got] == list(range(1, 21))
        hits, total = hits + len({g[1] for g in got} & set(want)), total + 20
        assert all(s == pytest.approx(vectors[ids.index(v)] @ vectors[ids.index(query)]) for _, v, s in got)
    assert {r.query_id for r in found} == {i for i in ids if i % 20 == 0}
    assert hits / total >= 0.95
    copies = sorted((r.rank, r.vec_id) for r in found if r.query_id == 6000)
    assert [v for _, v in copies] == [40, *range(6001, 6020)]


def test_search_goes_on_until_all_it_knows_is_expanded(spark, monkeypatch):
    for name, value in (("ENTRIES", 1), ("KNOWN", 4)):
        monkeypatch.setattr(neighbours, name, value)
    x = [[float(np.cos(i / 15)), float(np.sin(i / 15))] for i in range(40)]
    table = spark.createDataFrame(list(enumerate(x)), "node bigint, vector array<double>")
    edges = [(i, [k for k in (i - 2, i - 1, i + 1, i + 2) if 0 <= k < 40]) for i in range(40)]
    lists = spark.createDataFrame([(i, k, [0.0] * len(k)) for i, k in edges], "node bigint, nbrs array<bigint>, scores array<float>")
    graph = stage(neighbours.quantised(table).join(lists, "node"), "test-arc")
    asked = spark.createDataFrame([(100, x[0]), (139, x[39])], "node bigint, vector array<double>")
    found = {}
    for r in neighbours.search(graph, neighbours.quantised(asked), width=2).collect():
        found.setdefault(r["query"], set()).add(r["node"])
    assert {0, 1, 2} <= found[100] and {37, 38, 39} <= found[139]


def test_the_graph_goes_on_until_it_has_settled(spark, monkeypatch):
    for name, value in (("K", 8), ("REVERSE", 2), ("TREES", 1), ("CELL", 16), ("NAMED", 2)):
        monkeypatch.setattr(neighbours, name, value)
    x = np.random.default_rng(6).normal(size=(1200, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node bigint, vector array<double>")
    graph = neighbours.neighbour_graph(stage(neighbours.quantised(table), "test-nodes"), 8)
    assert graph.agg(F.sum("changed")).first()[0] <= neighbours.SETTLED * 1200 * 8


def test_few_vectors_and_none(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    found = neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 1, 0.5)]
    assert neighbours.nearest(table.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


# chat


def test_chat_round_trip_and_loss(spark):
    said = r"</s>[INST] a\b <|end|> <\|end|> [\\/INST] <|body|>"
    rows = [
        (1, 0, "user", said), (1, 1, "assistant", said), (1, 1, "assistant", said), (1, None, "system", None),
        (2, 0, None, ""), (None, 3, "assistant", "x" * 50_000), (3, 1, "a<|turn|>b", "é🙂"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = turns.withColumn("parts", chat.text_part(F.col("text"))).withColumn("formatted", F.lit("clash"))
    out = chat.format_conversations(turns).select(
        "conv_id", chat.parse_turns(F.col("formatted")).alias("turns"), "formatted",
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    found = {r.conv_id: r for r in out.collect()}
    assert [tuple(t) for t in found[1].turns] == [("system", ""), ("user", said), *[("assistant", said)] * 2]
    assert found[1].loss == said * 2 and found[None].loss == "x" * 50_000
    assert [tuple(t) for t in found[2].turns] == [("", "")] and found[2].loss == ""
    assert [tuple(t) for t in found[3].turns] == [("a<|turn|>b", "é🙂")]
    assert found[1].formatted.count(chat.END) == 4
    assert chat.format_conversations(turns.filter("false")).count() == 0


def test_parts_become_placeholders_in_order(spark):
    parts = [
        {"kind": "text", "text": "see"},
        {"kind": "image", "ref": "i.png", "size_a": 56, "size_b": 29},
        {"kind": "audio", "ref": "a.wav", "size_a": 1.5},
        {"kind": "document", "ref": "d.pdf", "size_a": 3},
        {"text": "<|image|>"},
    ]
    typed = F.from_json(F.lit(json.dumps(parts)), f"array<{chat.PART}>").alias("parts")
    turns = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), typed)
    row = chat.format_conversations(turns).first()
    assert r"see<|image|><|audio|><|document|><\|image|>" in row.formatted
    assert [(a.part, a.kind, a.ref, a.n_tokens) for a in row.attachments] == [
        (1, "image", "i.png", 4), (2, "audio", "a.wav", 38), (3, "document", "d.pdf", 1536),
    ]
    assert row.n_attachment_tokens == 1578


def test_control_strings_across_text_parts_are_escaped(spark):
    cases = [
        ["a<", "|turn|>x"], ["a<", "|image|>"], ["[", "/IN", "ST]"], ["<\\", "|end|>"], ["<", {"kind": "image"}, "|end|>"],
        ["see <|image|>", {"kind": "image"}, "<|image|>", {"kind": "odd"}, "", {"kind": "audio"}], [],
    ]
    for case in cases:
        parts = [{"text": p} if isinstance(p, str) else p for p in case]
        typed = F.from_json(F.lit(json.dumps(parts)), f"array<{chat.PART}>").alias("parts")
        turns = spark.range(2).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), typed)
        out = chat.format_conversations(turns)
        row = out.select("formatted", "attachments", chat.parse_parts(F.col("formatted")).alias("turns")).first()
        want, run = [], ""
        for p in [*case, None]:
            if isinstance(p, str):
                run += p
                continue
            want += [("text", run)] if run else []
            want += [(p["kind"] if p["kind"] in chat.PLACEHOLDERS else "unknown", None)] if p else []
            run = ""
        assert [[tuple(p) for p in t.parts] for t in row.turns] == [want, want], case
        assert row.formatted.count(chat.END) == 2
        assert len(row.attachments) == 2 * sum(isinstance(p, dict) for p in case)


# pages


def test_blocks_of_broken_pages():
    page = (
        "<!doctype html><title>T</title><p>one<b>two</b> &amp; &lt;3&nbsp;x<p>a < b<br>c"
        "<script>if (a<b) '</p>'</script><!-- <p>no</p> --><ul><li>l1<li>l2</ul><div data-x='>' class=\"ad Box\">ad"
    )
    found = extraction.blocks_of(page)
    assert [b.text for b in found] == ["T", "onetwo & <3 x", "a < b c", "l1", "l2", "ad"]
    assert found[-1].path == ("div ad box",)
    assert extraction.blocks_of("") == [] and extraction.blocks_of("<div><p></p>") == []
    assert [b.text for b in extraction.blocks_of("<i " * 3000 + "x>end")][-1:] == ["end"]


def test_only_raw_elements_are_swallowed():
    page = (
        "<p>a</p><svg width='1'/><p>b</p><template-x><p>c</p></template-x><object-list><p>d</p>"
        "<svg><title>no</title></svg><p>e</p><script src=x>no</script><template>no</template><p>f"
    )
    assert [b.text for b in extraction.blocks_of(page)] == ["a", "b", "c", "d", "e", "f"]


def test_training_sees_whole_pages(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(extraction, "fit", seen.extend)
    html = "<p>" + "word " * 8_000 + "</p><footer>foot</footer>"
    extraction.train(spark.createDataFrame([(1, "u", html)], "page_id bigint, url string, html string"))
    assert seen == [html]


def test_extraction_of_held_out_layouts_and_real_pages(spark):
    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    network = extraction.train(pages)
    odd = spark.createDataFrame([(-1, "u", None), (-2, None, "<p></p>"), (-2, None, "<p></p>")], "page_id bigint, url string, html string")
    found = extraction.extract(pages.unionByName(odd).withColumn("text", F.lit("clash")), network).collect()
    html = {r.page_id: r.html for r in pages.collect()}
    right = 0
    for row in found:
        assert row.n_chars == len(row.text)
        if row.page_id < 0:
            assert row.text == ""
            continue
        article = html[row.page_id].split("<article>")[1].split("</article>")[0]
        want = [b.text for b in extraction.blocks_of(article)]
        right += row.text == "\n".join(want)
    assert right >= 0.98 * len(html) and len(found) == len(html) + 3
    import random

    texts, dice = [b.text for h in html.values() for b in extraction.blocks_of(h)], random.Random(5)
    hits = total = 0
    for _ in range(60):
        blocks, labels = extraction.draw_layout(texts, dice)
        bounds = np.array([0, len(blocks)])
        hits += int((network.label(blocks, bounds) == np.array(labels)).sum())
        total += len(blocks)
    assert hits / total > 0.97
    assert extraction.extract(pages.filter("false"), network).count() == 0


# near duplicates


def brute_groups(rows):
    sets = {}
    for i, (_, text) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    group, links = {i: {i} for i in sets}, dict.fromkeys(sets, 0)
    for a, b in combinations(sets, 2):
        if rows[a][0] is None or rows[b][0] is None or not sets[a]:
            continue
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a], links[b] = links[a] + 1, links[b] + 1
            both = group[a] | group[b]
            for i in both:
                group[i] = both
    return {(rows[i][0], min((rows[k][0] for k in group[i]), default=None) if rows[i][0] is not None else None, links[i]) for i in sets}


def test_near_duplicates_against_all_pairs(docs, prose, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_NODES", 8)  # several blocks a bucket
    base = prose(1, 20).split(" ")
    near = []
    for k in range(40):
        changed = list(base)
        changed[(7 * k) % len(base)] = f"other{k}"
        near.append(" ".join(changed))
    texts = [*near, near[0], *(prose(i) for i in range(2, 30)), prose(5), None, "", " ", "a", "a", "a b c d", "w " * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, near[0])]
    found = near_duplicates.near_duplicates(docs(rows, more=True)).collect()
    assert {(r.doc_id, r.class_id, r.n_links) for r in found} == brute_groups(rows)
    assert near_duplicates.near_duplicates(docs([])).count() == 0


def test_chains_become_one_component(spark):
    pairs = [(f"{i:03}", f"{i + 1:03}") for i in range(30)] + [("500", "700"), ("600", "700")]
    edges = spark.createDataFrame(pairs, "u string, v string").select(
        F.col("u").cast("binary").alias("u"), F.col("v").cast("binary").alias("v")
    )
    roots = {bytes(r.node).decode(): bytes(r.root).decode() for r in near_duplicates.components(edges).collect()}
    assert roots == {**{f"{i:03}": "000" for i in range(1, 31)}, "600": "500", "700": "500"}


def test_bands_reach_the_recall_asked_for():
    bands, rows = near_duplicates.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= near_duplicates.MAX_HASHES


def test_one_row_of_each_group_stays_whatever_its_id(docs, prose):
    copied, alone = prose(1, 6), prose(2, 6)
    rows = [(3, copied), (5, alone), (5, copied), (None, prose(7, 6)), (None, prose(7, 6)), (None, copied), (None, prose(8, 6))]
    rows += [(-4, prose(9, 6)), (4, prose(9, 6)), (6, None), (6, ""), (8, prose(9, 6)), (8, prose(9, 6))]
    found = near_duplicates.keep_one_of_each(docs(rows, more=True)).collect()
    want = [(3, copied), (5, alone), (None, prose(7, 6)), (None, prose(8, 6)), (-4, prose(9, 6)), (6, None), (6, "")]
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(want, key=str)


# mixing


def water_level(sizes, weights, share, top):
    targets, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    rest = share * sum(sizes.values())
    while open_:
        level = rest / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > top * sizes[s]}
        if not full:
            return {**targets, **{s: level * weights[s] for s in open_}}
        for s in full:
            targets[s] = float(top * sizes[s])
            rest -= targets[s]
        open_ -= full
    return targets


def test_mix_meets_targets_and_reruns_agree(docs, prose):
    rows = [(i, prose(i, 1 + i % 9), "en", ["a", "b", "c", None, "hot"][min(i % 7, 4)]) for i in range(700)]
    rows += [(9000, None, "en", "a"), (9001, "", "en", "empty"), (5, prose(5), "en", "a"), (None, "x y", "en", "b")]
    mix = stage(mixing.mix_sources(docs(rows, more=True), block_docs=16, shards=4), "test-mix")
    found = mix.collect()
    sizes, taken, targets = {}, {}, {}
    for r in found:
        sizes[r.source] = r.source_size
        targets[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.size * len(r.shards)
        assert len(r.shards) <= 2
    order = sorted(s for s in sizes if s is not None) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = water_level(sizes, weights, 1.5, 2)
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= 110  # one text
    again = mixing.mix_sources(docs(rows), block_docs=16, shards=4)
    key = lambda r: (str(r.doc_id), str(r.source), r.size, tuple(r.shards))
    assert sorted(map(key, again.collect())) == sorted(map(key, found))
    copies = mixing.mixed_rows(mix).groupBy("shard").count().collect()
    counts = [r["count"] for r in copies]
    assert len(counts) == 4 and max(counts) < 2 * min(counts)
    assert mixing.mix_sources(docs([])).count() == 0


def test_rows_without_id_are_mixed_by_their_texts(docs, prose):
    rows = [(None if i % 3 == 0 else i, prose(i, 2), "en", "ab"[i % 2]) for i in range(600)]
    mix = mixing.mix_sources(docs(rows, more=True), block_docs=16, shards=4).collect()
    assert len(mix) == 600 and len({r.doc_key for r in mix}) == 600
    for source in "ab":
        own = [r for r in mix if r.source == source]
        assert abs(sum(r.size * len(r.shards) for r in own) - own[0].target) <= 30


def test_pipeline_mixes_row_by_row(spark, docs, prose):
    rows = [(None if i % 3 == 0 else i // 2, prose(i, 6), "en", "ab"[i % 2]) for i in range(300)]
    table = docs(rows, more=True)
    taken = corpus_pipeline.mixed_sources(spark, table, "").collect()
    mix = mixing.mix_sources(table).collect()
    want = {(r.doc_id, r.source, r.text_key): len(r.shards) for r in mix}
    found = {}
    for row in taken:
        assert (row.near_row_key, row.key) == ("n", "m")
        key = (row.doc_id, row.source, hashlib.md5(row.text.encode()).hexdigest())
        found[key] = found.get(key, 0) + 1
    assert found == {key: n for key, n in want.items() if n}


def test_quotas_are_split_exactly(spark):
    quotas = spark.createDataFrame([("a", 70), ("b", 21), (None, 9)], "source string, quota bigint")
    parts = mixing.split_quotas(quotas, 8).collect()
    for source, quota in (("a", 70), ("b", 21), (None, 9)):
        runs = sorted((r["first"], r.quota) for r in parts if r.source == source)
        assert sum(q for _, q in runs) == quota and runs[0][0] == 1
        assert all(a + q == b for (a, q), (b, _) in zip(runs, runs[1:]))
    by_shard = {s: sum(r.quota for r in parts if r.shard == s) for s in range(8)}
    assert max(by_shard.values()) - min(by_shard.values()) <= 1


# pipeline


def test_stages_keep_columns_and_take_effect(spark, docs, prose, tmp_path):
    good = [(i, prose(i, 6), "en", f"s{i % 3}") for i in range(40)]
    rows = [*good, (100, prose(3, 6), "en", "s0"), (101, "too short", "en", "s0"), (102, None, None, None), (103, "", "en", "s1"), good[0]]
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame, seen = docs(rows, more=True), []
    for name, step in corpus_pipeline.STAGES:
        before, frame = frame, stage(step(spark, frame, str(tmp_path)), f"test-{name}")
        if name != "bpe":
            assert frame.columns == before.columns
        seen.append([r.doc_id for r in frame.select("doc_id").collect()])
    kept, unique, mixed, encoded = seen
    assert sorted(kept) == sorted([*range(40), 100, 0])
    assert sorted(unique) == list(range(40))
    assert set(mixed) <= set(unique) and all(mixed.count(i) <= 2 for i in unique) and len(mixed) > 40
    assert sorted(encoded) == sorted(mixed)
    empty = docs([])
    for name, step in corpus_pipeline.STAGES:
        empty = step(spark, empty, str(tmp_path))
    assert empty.count() == 0


def test_contract_digests_of_conversation_minus_seven(spark):
    from workwindow.llm.queries import QUERIES

    row = QUERIES["op5_chat_formatting"](spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())


def test_long_pages_are_labelled_in_parts():
    page = "".join(f"<div class='c{i % 5}'><p>Block {i} has some words, number {i * i}.</p></div>" for i in range(90))
    blocks = extraction.blocks_of(f"<body>{page}</body>")
    both = blocks + extraction.blocks_of("<p>short page</p>")
    bounds = np.array([0, len(blocks), len(both)])
    network = extraction.Network.start(5)
    network.w["skip"] = np.random.default_rng(6).normal(0, 1, extraction.DIM).astype(np.float32)
    x = extraction.vectors(blocks, bounds[:2])[None]
    whole = network.forward(x, np.array([len(blocks)]))[0]
    assert np.allclose(network.long_page(blocks, 7), whole, atol=1e-4)
    assert network.label(both, bounds, 7).tolist() == network.label(both, bounds).tolist()
