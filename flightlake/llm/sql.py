"""SQL of the queries that SQL can express, for the driver tables registered as views."""

from __future__ import annotations

_CRC = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of
)"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string that is not empty; needs `crc_table`."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    fold = "lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), {fold}), 4294967295)"


PREFIX_TRIE = f"""
WITH RECURSIVE {_CRC}, turns AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS at
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("conv_id::VARCHAR")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), rows AS (
  SELECT c.conv_id, t.t, t.at, 0 AS part FROM convs c JOIN turns t ON t.conv_id = c.base AND t.at <= c.h
  UNION ALL SELECT c.conv_id, t.t, t.at, 1 FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.at > c.h
), whole AS (
  SELECT c.conv_id, coalesce(list(r.t ORDER BY r.part, r.at) FILTER (WHERE r.t IS NOT NULL), []) AS seq
  FROM convs c LEFT JOIN rows r USING (conv_id) GROUP BY ALL
), paths AS (
  SELECT conv_id, unnest(range(len(seq) + 1)) AS depth, seq FROM whole
), nodes AS (
  SELECT list_slice(seq, 1, depth) AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '') AS ends
  FROM paths GROUP BY ALL
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = list_slice(n.path, 1, n.depth - 1)
), measured AS (
  SELECT *, (SELECT count(*) FROM nodes c WHERE c.depth = l.depth + 1 AND list_slice(c.path, 1, l.depth) = l.path) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].text) END AS own
  FROM linked l
), up AS (
  SELECT path, unnest(range(depth + 1)) AS above, n_children, own FROM measured
), sums AS (
  SELECT list_slice(path, 1, above) AS path, above AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own) AS saved
  FROM up GROUP BY ALL
)
SELECT m.conv_id::BIGINT AS conv_id, m.depth::BIGINT AS depth, m.parent_conv_id::BIGINT AS parent_conv_id,
  m.n_convs::BIGINT AS n_convs, m.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM measured m JOIN sums s ON s.depth = m.depth AND s.path = m.path"""

# The search runs forward over rows, one (cost, edits) for each of the states 0 (nothing yet), 1 (after s),
# 2 (after u) and 3 (after a); a row's edit comes first, then at most one insert where it pays.
_WORST = "{'c': 1000000000, 'e': ''}"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _add(state: str, cost: str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'e': {state}.e || '{edit}'}}"


def _row_edit(state: int) -> str:
    """Best way into a state by an edit of the row."""
    options = [_add(f"v[{state + 1}]", "2", "D")]
    before = {1: [0], 2: [0, 1, 3], 3: [2]}.get(state, [])
    for b in before:
        keep = _add(f"v[{b + 1}]", "more", "K")
        options.append(f"CASE WHEN NOT gone AND initial = '{'sua'[state - 1]}' THEN {keep} ELSE {_WORST} END")
        if state > 1:
            options.append(f"CASE WHEN NOT gone THEN {_add(f'v[{b + 1}]', 'more + 1', 'R')} ELSE {_WORST} END")
    return _least(*options)


def _inserted(w: str) -> str:
    two = _least(f"{w}[3]", *[_add(f"{w}[{b}]", "5", "I") for b in (1, 2, 4)])
    three = _least(f"{w}[4]", _add(f"{w}[3]", "5", "I"), *[_add(f"{w}[{b}]", "10", "II") for b in (1, 2)])
    return f"[{w}[1], {w}[2], {two}, {three}]"


TURN_REPAIR = f"""
WITH RECURSIVE {_CRC}, marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS pos FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid,
    substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), faults AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
  FROM seen
), walk AS (
  SELECT conv_id, 0::BIGINT AS pos, {_inserted("w")} AS v
  FROM (SELECT DISTINCT conv_id, [{{'c': 0, 'e': ''}}, {_WORST}, {_WORST}, {_WORST}] AS w FROM conversations)
  UNION ALL
  SELECT conv_id, pos, {_inserted("w")} FROM (
    SELECT conv_id, pos, [{", ".join(_row_edit(state) for state in range(4))}] AS w FROM (
      SELECT k.conv_id, f.pos, k.v, f.initial, f.fault IN ('blank', 'duplicate') AS gone,
             CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS more
      FROM walk k JOIN faults f ON f.conv_id IS NOT DISTINCT FROM k.conv_id AND f.pos = k.pos + 1)
  )
), best AS (
  SELECT conv_id, list_min([v[1], v[4]]) AS b FROM walk
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY ALL
), edits AS (
  SELECT conv_id, unnest(range(1, len(b.e) + 1)) AS i, b.e AS e FROM best
), numbered AS (
  SELECT *, substr(e, i, 1) AS edit, len(replace(substr(e, 1, i), 'I', '')) AS pos,
    len(replace(substr(e, 1, i), 'D', '')) AS place FROM edits
), lines AS (
  SELECT n.conv_id, n.place, n.edit, f.role, f.text,
    -- the first line of a system row shifts the turns that alternate
    min(CASE WHEN n.edit = 'K' AND f.initial = 's' THEN n.place END) OVER (PARTITION BY n.conv_id) AS sys
  FROM numbered n LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.pos = n.pos AND n.edit <> 'I'
  WHERE n.edit <> 'D'
), texts AS (
  SELECT conv_id, string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (place - coalesce(sys, 0)) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY place) AS t
  FROM lines GROUP BY ALL
)
SELECT b.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
  coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
  coalesce(c.illegal, 0)::BIGINT AS illegal, b.b.c::BIGINT AS cost, b.b.e AS audit, sha256(coalesce(t.t, '')) AS repaired_sha256
FROM best b LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM b.conv_id"""

EXACT_DEDUP = """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY t)"""

_WORD = r"[^\x20\x09-\x0D]+"

NGRAM_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' '))))) END AS s
  FROM words
), nodes AS (
  SELECT s, len(s) AS n, min(doc_id) AS node FROM sets WHERE len(s) > 0 GROUP BY s
), items AS (
  SELECT node, n, unnest(s) AS item FROM nodes
), ranked AS (
  SELECT node, n, item, row_number() OVER (PARTITION BY node ORDER BY f, item) AS place
  FROM items JOIN (SELECT item, count(*) AS f FROM items GROUP BY item) USING (item)
), heads AS (  -- a linked pair shares one of its rarest shingles
  SELECT node, n, item FROM ranked WHERE place <= n - ceil(0.8 * n) + 1
), near AS (
  SELECT DISTINCT a.node AS a, b.node AS b FROM heads a JOIN heads b ON a.item = b.item AND a.node < b.node
  AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), linked AS (
  SELECT a, b FROM (
    SELECT near.a, near.b, x.n AS na, y.n AS nb, len(list_intersect(x.s, y.s)) AS c
    FROM near JOIN nodes x ON x.node = near.a JOIN nodes y ON y.node = near.b)
  WHERE 100 * c >= 80 * (na + nb - c)
), edges AS (
  SELECT a, b FROM linked UNION SELECT b, a FROM linked
), reach AS (
  SELECT node, node AS root FROM nodes
  UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node WHERE r.root < e.b
), roots AS (
  SELECT node, min(root) AS root FROM reach GROUP BY node
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM sets d LEFT JOIN nodes n ON n.s = d.s LEFT JOIN roots r ON r.node = n.node"""

EMBEDDING_LINKS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), able AS (
  SELECT vec_id, label, v FROM vectors
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(v, lambda x: abs(x))) > 0
), linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), edges AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM vectors
  UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node WHERE r.root < e.b
), roots AS (
  SELECT node, min(root) AS root FROM reach GROUP BY node
)
SELECT v.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, r.root::BIGINT AS component_id, v.vec_id = r.root AS kept
FROM vectors v JOIN roots r ON r.node = v.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM edges GROUP BY a) l ON l.a = v.vec_id"""

SUBSTRING_DEDUP = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
), repeated AS (
  SELECT doc_id, i FROM windows JOIN (SELECT h, min(doc_id) AS first FROM windows GROUP BY h) USING (h) WHERE doc_id > first
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM repeated
), each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)"""
