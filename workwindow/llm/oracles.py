"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

# Short notices of public licences, stated once more.
_TEMPLATES = [
    ("agpl-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License"),
    (
        "bsd-3-clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: redistributions of source code "
        "must retain the above copyright notice",
    ),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-nc-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    (
        "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    ("cc0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version",
    ),
    ("lgpl-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("proprietary", "All rights reserved"),
    ("proprietary", "Copyright. All rights reserved. No part may be reproduced without permission"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def _template_rows() -> str:
    rows = []
    for i, (name, text) in enumerate(_TEMPLATES):
        terms = re.findall("[a-z0-9]+", text.lower())
        rows += [f"({i}, '{name}', '{t}', {terms.count(t)})" for t in sorted(set(terms))]
    return ", ".join(rows)


OP2 = rf"""
WITH RECURSIVE files AS (
  SELECT doc_id, concat_ws('/', coalesce(source, ''), coalesce(lang, ''), coalesce(doc_id::VARCHAR, '')) AS path, text,
    regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS words
  FROM documents),
template_terms(template, license_id, term, n) AS (VALUES {_template_rows()}),
vocabulary AS (SELECT DISTINCT term FROM template_terms),
seen AS (
  SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(words)) AS term FROM files)
  GROUP BY term),
weights AS (
  SELECT v.term, ln(((SELECT count(*) FROM files) + 1) / (coalesce(df, 0) + 1)) + 1 AS weight
  FROM vocabulary v LEFT JOIN seen USING (term)),
templates AS (
  SELECT template, license_id, term,
    n * weight / sqrt(sum(n * weight * n * weight) OVER (PARTITION BY template)) AS w
  FROM template_terms JOIN weights USING (term)),
texts AS (SELECT DISTINCT path, text, len(words) AS all_words FROM files WHERE text IS NOT NULL),
parts AS (
  SELECT path, text, all_words, unnest(range(len(b) + 1)) AS block, unnest([text] || b) AS part
  FROM (SELECT *, regexp_split_to_array(text, '\n(?:[^A-Za-z0-9\n]*\n)+') AS b FROM texts)),
units AS (
  SELECT path, text, all_words, block, 0 AS line, part AS line_text FROM parts
  UNION ALL
  SELECT path, text, all_words, block, unnest(range(1, len(l) + 1)), unnest(l)
  FROM (SELECT *, string_split(part, chr(10)) AS l FROM parts WHERE block > 0) WHERE len(l) > 1),
split AS (
  SELECT path, text, all_words, block, line, regexp_extract_all(lower(line_text), '[a-z0-9]+') AS words FROM units),
terms AS (
  SELECT path, text, block, line, all_words, len(words) AS n_words, unnest(words) AS term FROM split),
counts AS (
  SELECT path, text, block, line, all_words, n_words, term, count(*) * coalesce(any_value(weight), 1) AS w
  FROM terms LEFT JOIN weights USING (term) GROUP BY ALL),
lengths AS (SELECT path, text, block, line, sqrt(sum(w * w)) AS norm FROM counts GROUP BY ALL),
scored AS (
  SELECT path, text, block, line, all_words, n_words, template, license_id,
    round(sum(c.w * t.w) / any_value(norm), 6) AS score
  FROM counts c JOIN templates t USING (term) JOIN lengths USING (path, text, block, line) GROUP BY ALL),
best AS (
  SELECT path, text, block, line, all_words, n_words, max((score, -template, license_id)) AS b
  FROM scored WHERE score >= 0.6 GROUP BY ALL),
blocks AS (
  SELECT path, text, block, max(all_words) AS all_words,
    CASE WHEN block = 0 THEN 0 WHEN bool_or(line = 0) THEN 1 ELSE count(*) END AS notices,
    CASE WHEN block = 0 THEN 0 WHEN bool_or(line = 0) THEN max(n_words) FILTER (line = 0) ELSE sum(n_words) END AS noted,
    arg_min(b[3], (-b[1], b[3])) AS license_id, max(b[1]) AS score
  FROM best GROUP BY path, text, block),
own AS (
  SELECT path, arg_min(license_id, (-score, license_id)) AS license_id, max(score) AS score,
    sum(notices)::BIGINT AS n_notices,
    regexp_matches(path, '(?i)(^|/)(licen[sc]e|copying|copyright|notice|unlicense)[^/]*$')
      OR bool_or(block = 0) OR sum(noted) >= 0.5 * max(all_words) AS is_license_file
  FROM blocks GROUP BY path),
speaking AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS above,
    arg_min(license_id, (-score, path, license_id)) AS dir_license
  FROM own WHERE is_license_file GROUP BY 1),
ancestors AS (
  SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS dir,
    regexp_replace(path, '/?[^/]*$', '') AS above FROM files
  UNION SELECT dir, regexp_replace(above, '/?[^/]*$', '') FROM ancestors WHERE above <> ''),
inherited AS (
  SELECT dir, arg_max(above, length(above)) AS from_dir,
    arg_max(dir_license, length(above)) AS dir_license
  FROM ancestors JOIN speaking USING (above) GROUP BY dir)
SELECT doc_id, path, license_id AS own_license, score, coalesce(n_notices, 0) AS n_notices,
  coalesce(is_license_file, false) AS is_license_file,
  coalesce(license_id, dir_license) AS license_id,
  CASE WHEN license_id IS NULL THEN from_dir END AS from_dir
FROM files LEFT JOIN own USING (path)
  LEFT JOIN inherited ON inherited.dir = regexp_replace(path, '/?[^/]*$', '')
"""

# Fixed values, as chat.py defines them.
_OPENERS = r"[<\[]"
_TAILS = r"\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|</?SYS>>|/?tool_calls?>|/?think>"


def _escaped(x: str) -> str:
    return rf"regexp_replace({x}, '({_OPENERS})(\\*)({_TAILS})', '\1\\\2\3', 'g')"


OP5 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_escaped("role")}) + length({_escaped("text")}) + 23)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

CHAT_PARTS = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n
  FROM conversations
), bodies AS (
  SELECT conv_id, turn, role, n, {_escaped("substr(text, 1, n // 2)")} || '<|image|>'
    || {_escaped("substr(text, n // 2 + 1) || '<|turn|> <|image|>'")} || '<|audio|><|document|>' AS body
  FROM turns
)
SELECT conv_id, count(*) AS n_turns, count(*) AS n_images, 3 * count(*) AS n_attachments,
  sum(ceil(n % 500 / 28) * ceil(n % 300 / 28) + n % 60 * 25 + n % 7 * 512)::BIGINT AS n_attachment_tokens,
  sha256(string_agg('<|turn|>' || {_escaped("role")} || '<|body|>' || body || '<|end|>', ''
    ORDER BY turn NULLS FIRST, role, body)) AS formatted_sha256
FROM bodies GROUP BY conv_id
"""

_KEY = "('0x' || substr(md5(concat_ws(':', {})), 1, 15))::BIGINT"
WORD_COUNT = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"


def mix_sql(documents: str) -> str:
    """CTEs ``mix_docs`` .. ``mix``: one row per document of the view with its repeats."""
    key = _KEY.format
    return rf"""
sized AS (SELECT *, {WORD_COUNT} AS size, {key("'mix-1', doc_id")} AS doc_key FROM {documents}),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, ceil(count(*) / 1024) AS n_blocks,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, (2 * source_size) / weight AS fill,
    ((sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE
      - ((sum(2 * source_size) OVER o)::BIGINT - 2 * source_size))
      / ((sum(weight) OVER ())::BIGINT - (sum(weight) OVER o)::BIGINT + weight) AS level
  FROM sources
  WINDOW o AS (ORDER BY (2 * source_size) / weight, source NULLS LAST)),
goal AS (
  SELECT arg_min(level, (fill, source IS NULL, source)) AS level,
    min((fill, source IS NULL, source)) AS first_open
  FROM filled WHERE level <= fill),
targets AS (
  SELECT source, source_size, n_blocks,
    coalesce(CASE WHEN (fill, source IS NULL, source) >= first_open THEN weight * goal.level
      ELSE (2 * source_size)::DOUBLE END, 0) AS target
  FROM filled LEFT JOIN goal ON true),
rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds,
    target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest
  FROM targets),
dealt AS (
  SELECT d.*, r.source_size, r.target, r.rounds, r.rest,
    (doc_key // 64) % n_blocks::BIGINT AS block
  FROM sized d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source),
blocks AS (
  SELECT source, block, sum(size) AS block_size, any_value(rest) AS rest
  FROM dealt GROUP BY source, block),
left_overs AS (
  SELECT source, block, block_size, rest - (sum(block_size) OVER (PARTITION BY source
    ORDER BY {key("'mix-1', 'block', source, block")}, block) - block_size) AS left_over
  FROM blocks),
mix AS (
  SELECT d.*, least(rounds + CASE
      WHEN left_over <= 0 THEN 0 WHEN left_over >= block_size THEN 1
      WHEN sum(size) OVER (PARTITION BY d.source, d.block ORDER BY doc_key, doc_id, size
        ROWS UNBOUNDED PRECEDING) - size / 2 <= left_over THEN 1 ELSE 0 END, 2)::BIGINT AS repeats
  FROM dealt d JOIN left_overs b
    ON d.source IS NOT DISTINCT FROM b.source AND d.block = b.block)
"""


def groups_sql(documents: str) -> str:
    """CTEs ending in ``near``: doc_id, class_id, copy_id and n_links of each document.
    Exact: all pairs of texts that share a run of five words are compared."""
    return rf"""
n_words AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM {documents}),
n_sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM n_words),
n_nodes AS (
  SELECT s, min(doc_id) AS rep, count(*) AS size FROM n_sets WHERE len(s) > 0 GROUP BY s),
n_grams AS (SELECT rep, len(s) AS n, size, unnest(s) AS g FROM n_nodes),
n_common AS (
  SELECT a.rep AS a, b.rep AS b, any_value(a.n + b.n) AS n, any_value(b.size) AS size, count(*) AS c
  FROM n_grams a JOIN n_grams b ON a.g = b.g AND a.rep <> b.rep GROUP BY ALL),
n_links AS (SELECT a, b, size FROM n_common WHERE c >= 0.8 * (n - c) - 1e-9),
n_reach(a, b) AS (
  SELECT a, b FROM n_links UNION SELECT r.a, l.b FROM n_reach r JOIN n_links l ON r.b = l.a),
n_class AS (
  SELECT rep, size, least(rep, (SELECT min(b) FROM n_reach WHERE a = rep)) AS class_id,
    coalesce((SELECT sum(l.size) FROM n_links l WHERE l.a = rep), 0) AS more, s
  FROM n_nodes),
near AS (
  SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(rep, d.doc_id) AS copy_id,
    coalesce(c.size - 1 + more, 0)::BIGINT AS n_links
  FROM n_sets d LEFT JOIN n_class c ON len(d.s) > 0 AND d.s = c.s)
"""


OP9 = f"""
WITH RECURSIVE {groups_sql("documents")}
SELECT doc_id, class_id, copy_id, n_links FROM near
"""

OP10 = f"""
WITH {mix_sql("documents")}
SELECT doc_id, size, source_size, target, size * repeats AS taken FROM mix
"""

OP8 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
pairs AS (
  SELECT doc_id, unnest(['<start>'] || ['=' || x for x in w[:-2]]) AS a, unnest(['=' || x for x in w]) AS b
  FROM words WHERE len(w) > 0),
own AS (SELECT doc_id, b AS word, count(*) AS n FROM pairs GROUP BY ALL
  UNION ALL SELECT doc_id, '<start>', 1 FROM pairs GROUP BY doc_id),
unigrams AS (SELECT word, sum(n)::BIGINT AS n FROM own GROUP BY word),
own_pairs AS (SELECT doc_id, a, b, count(*) AS n FROM pairs GROUP BY ALL),
bigrams AS (SELECT a, b, sum(n)::BIGINT AS n FROM own_pairs GROUP BY ALL),
scored AS (
  SELECT p.doc_id, p.n, g.n - p.n AS pair, ua.n - oa.n AS context, greatest(ub.n - ob.n, 1) AS word
  FROM own_pairs p JOIN bigrams g ON p.a = g.a AND p.b = g.b
    JOIN unigrams ua ON ua.word = p.a JOIN own oa ON oa.doc_id = p.doc_id AND oa.word = p.a
    JOIN unigrams ub ON ub.word = p.b JOIN own ob ON ob.doc_id = p.doc_id AND ob.word = p.b),
sums AS (
  SELECT doc_id, sum(n) AS n_words, sum(CASE WHEN pair > 0 THEN 0 ELSE n END) AS n_backed_off,
    sum(n * CASE WHEN pair > 0 THEN ln(pair / context)
      ELSE ln(0.4 * word / (SELECT sum(n) FROM unigrams WHERE word <> '<start>')) END) AS score
  FROM scored GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_backed_off, 0)::BIGINT AS n_backed_off,
  round(score / n_words, 6) AS mean_log_score
FROM documents d LEFT JOIN sums USING (doc_id)
"""

OP11 = """
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, b:
      list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS kind
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END))
  WHERE kind <> 0
), ordered AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS body
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM ordered
), counted AS (
  SELECT conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), inserts(x, z, said) AS (
  VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 2, 'I'), (1, 3, 'II'), (2, 3, 'I'), (3, 2, 'I')
), edits(initial, z, y, said, cost) AS (
  VALUES ('s', 0, 1, 'K', 0), ('u', 0, 2, 'K', 0), ('u', 1, 2, 'K', 0), ('u', 3, 2, 'K', 0), ('a', 2, 3, 'K', 0),
         ('*', 0, 2, 'R', 3), ('*', 1, 2, 'R', 3), ('*', 3, 2, 'R', 3), ('*', 2, 3, 'R', 3),
         ('*', 0, 0, 'D', 4), ('*', 1, 1, 'D', 4), ('*', 2, 2, 'D', 4), ('*', 3, 3, 'D', 4)
), moves AS (
  SELECT f.conv_id, f.i, a.x, e.y, a.said || e.said AS said,
         3 * length(a.said) + e.cost + CASE WHEN f.fault = 'truncated' AND e.said <> 'D' THEN 3 ELSE 0 END AS cost
  FROM faulty f JOIN edits e ON e.initial IN (f.initial, '*') AND (e.said = 'D' OR f.fault IN ('truncated', 'none'))
  JOIN inserts a ON a.z = e.z
), paths AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, struct_pack(cost := 0::BIGINT, audit := '') AS best FROM counted
  UNION ALL
  SELECT p.conv_id, m.i, m.y, min(struct_pack(cost := p.best.cost + m.cost, audit := p.best.audit || m.said))
  FROM paths p JOIN moves m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1 AND m.x = p.state
  GROUP BY p.conv_id, m.i, m.y
), chosen AS (
  SELECT p.conv_id, min(struct_pack(cost := p.best.cost + 3 * length(a.said), audit := p.best.audit || a.said)) AS best
  FROM paths p JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i
  JOIN inserts a ON a.x = p.state WHERE a.z IN (0, 3)
  GROUP BY p.conv_id
), letters AS (
  SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS k FROM chosen
), said AS (
  SELECT conv_id, k, audit[k] AS edit,
         count(*) FILTER (audit[k] <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
         count(*) FILTER (audit[k] <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS place
  FROM letters
), lines AS (
  SELECT s.conv_id, s.k, s.place, s.edit, f.role, f.text,
         bool_or(s.edit = 'K' AND f.initial = 's') OVER (PARTITION BY s.conv_id) AS system
  FROM said s LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i AND s.edit <> 'I'
  WHERE s.edit <> 'D'
), repaired AS (
  SELECT conv_id, string_agg(
           CASE WHEN edit = 'K' THEN role WHEN (place + CASE WHEN system THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS body
  FROM lines GROUP BY conv_id
)
SELECT DISTINCT v.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(h.best.cost, 0)::BIGINT AS cost,
       coalesce(h.best.audit, '') AS audit, sha256(coalesce(r.body, '')) AS repaired_sha256
FROM conversations v
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN chosen h ON h.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM v.conv_id
"""

OP13 = r"""
WITH split AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), totals AS (
  SELECT count(*) AS n_docs, sum(len(terms)) AS n_all FROM split WHERE len(terms) > 0
), tf AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM split) GROUP BY d, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals GROUP BY term
), items AS (
  SELECT row_number() OVER () AS i, item_id,
         list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM benchmark WHERE text IS NOT NULL
), asked AS (
  SELECT i, item_id, unnest(terms) AS term FROM items
), lengths AS (
  SELECT d, doc_id, 100 - 50 + (50 * len(terms) * n_docs)::BIGINT // n_all::BIGINT AS m FROM split, totals
), scores AS (
  SELECT a.i, a.item_id, l.d, l.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked a JOIN tf USING (term) JOIN weights USING (term) JOIN lengths l USING (d)
  GROUP BY a.i, a.item_id, l.d, l.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

SQL = {"op8_lm_scores": OP8, "op2_license_scan": OP2, "op5_chat_formatting": OP5, "chat_typed_parts": CHAT_PARTS, "op9_ngram_jaccard": OP9, "op10_mixing": OP10, "op11_conversation_repair": OP11, "op13_lexical_search": OP13}
