"""DuckDB SQL for the queries of this subpackage that SQL can express."""

OP1 = """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT conv_id, pos, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY pos) AS upto, count(*) OVER (PARTITION BY conv_id) AS n
  FROM t
), whole AS (
  SELECT upto, min(conv_id) AS conv_id, count(*) AS n_copies, any_value(n) AS n_turns FROM p WHERE pos = n GROUP BY upto
), kept AS (
  SELECT w.* FROM whole w ANTI JOIN (SELECT DISTINCT upto FROM p WHERE pos < n) i ON w.upto = i.upto
)
SELECT k.conv_id, CAST(k.n_turns AS INT) AS n_turns, k.n_copies,
  string_agg('<|im_start|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10), '' ORDER BY t.pos) AS chat
FROM kept k JOIN t ON t.conv_id = k.conv_id GROUP BY ALL
"""

_CUT = r"""
cut AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
)"""

OP2 = f"""
WITH {_CUT}, rules(say, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), judged AS (
  SELECT c.*, (SELECT max_by({{'rule': h || p, 'say': say}}, length(h || p)) FROM rules WHERE (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, p)) AS r FROM cut c
), tok AS (
  SELECT page_id, host, path, r.rule AS rule, r.say AS say, list_sort(list_distinct(
      list_transform(list_filter(list_reverse(string_split(host, '.')), lambda s: s <> ''), lambda s, i: 'h' || i || '=' || regexp_replace(s, '[0-9]+', '#', 'g'))
   || list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s, i: 'p' || i || '=' || regexp_replace(s, '[0-9]+', '#', 'g'))
   || list_transform(list_filter(list_transform(string_split(regexp_extract(coalesce(url, ''), '\\?([^#]*)', 1, 's'), '&'), lambda s: regexp_extract(s, '^[^=]*', 0, 's')), lambda s: s <> ''), lambda s: 'q=' || regexp_replace(s, '[0-9]+', '#', 'g')))) AS tokens
  FROM judged
), labelled AS (SELECT tokens, say, count(*) AS c FROM tok WHERE say IS NOT NULL AND len(tokens) > 0 GROUP BY ALL
), masks AS (SELECT tokens, say, c, unnest(range(1, 1 << len(tokens))) AS m FROM labelled
), sets AS (SELECT list_filter(tokens, lambda t, i: (m >> (i - 1)) & 1 = 1) AS items, say, c FROM masks
), freq AS (SELECT items, say, sum(c) AS n, sum(sum(c)) OVER (PARTITION BY items) AS total FROM sets GROUP BY items, say
), mined AS (
  SELECT items, say, n / total AS confidence, n / (SELECT sum(c) FROM labelled) AS support FROM freq
  WHERE n >= ceil(0.02 * (SELECT sum(c) FROM labelled)) AND n / total >= 0.8
), good AS (
  SELECT * FROM mined a WHERE NOT EXISTS (SELECT 1 FROM mined b WHERE b.say = a.say AND b.confidence >= a.confidence AND len(b.items) < len(a.items) AND list_has_all(a.items, b.items))
), open AS (SELECT DISTINCT tokens FROM tok WHERE say IS NULL
), best AS (
  SELECT o.tokens, first(g ORDER BY g.confidence DESC, g.support DESC, g.items) AS g FROM open o JOIN good g ON list_has_all(o.tokens, g.items) GROUP BY o.tokens
)
SELECT t.page_id, t.host, t.path, t.rule, coalesce(t.say, b.g.say, 'allow') AS verdict,
  coalesce(array_to_string(b.g.items, ' '), '') AS mined_tokens, round(b.g.confidence, 9) AS confidence
FROM tok t LEFT JOIN best b ON t.say IS NULL AND t.tokens = b.tokens
"""

_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents
), i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), iw AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0
), win AS (SELECT DISTINCT item, n, list_slice(w, p, p + n - 1) AS g FROM iw
), dw AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n
), hit AS (SELECT dw.r, dw.p, win.n, win.item FROM dw JOIN win ON dw.n = win.n AND list_slice(dw.w, dw.p, dw.p + dw.n - 1) = win.g
), hw AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r
), hi AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""

OP4 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents
), s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda p: list_slice(w, p, p + 4)) END) AS g FROM d WHERE doc_id IS NOT NULL
), n AS (SELECT r, count(*) AS n FROM s GROUP BY r
), common AS (SELECT a.r AS x, b.r AS y, count(*) AS inter FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL
), link AS (SELECT x, y FROM common JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE inter * 9 >= 4 * (nx.n + ny.n)
), reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
)
SELECT d.doc_id, (SELECT min(e.doc_id) FROM reach JOIN d e ON e.r = reach.y WHERE reach.x = d.r) AS class_id,
  CASE WHEN d.doc_id IS NOT NULL THEN coalesce(l.c, 0) END AS n_links
FROM d LEFT JOIN (SELECT x, count(*) AS c FROM link GROUP BY x) l ON l.x = d.r
"""

# The pages' template has its main text in one <article> element, whose blocks are h1 and p.
OP5 = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS body FROM pages
), b AS (
  SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '<br>', ' ', 'g'), '</?b>', '', 'g'), '<[^>]*>', chr(1), 'g'), '<[^>]*$', ''), chr(1)) AS parts FROM a
), c AS (
  SELECT page_id, url, list_transform(parts, lambda p: trim(regexp_replace(replace(regexp_replace(regexp_replace(replace(replace(p, '&lt;', '<'), '&gt;', '>'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), chr(160), ' '), '\s+', ' ', 'g'))) AS parts FROM b
), d AS (SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda p: p <> ''), chr(10) || chr(10)), '') AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d
"""

_TABLE = "crc(tab) AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)))"
# crc32 of ASCII text {0}, by the table of 256 remainders.
_CRC = "xor(list_reduce(list_transform(string_split({0}, ''), lambda s: CAST(ascii(s) AS BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def _leaf(text: str) -> str:
    one = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
    return "sha256(" + " || ".join(one.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_HASH = "sha256(string_agg(h, '' ORDER BY pos))"
OP11 = f"""
WITH RECURSIVE {_TABLE}, d AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf('text')} AS leaf,
    CASE WHEN {_CRC.format('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS now
  FROM documents, crc
), s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM d GROUP BY source
), l AS (SELECT r, doc_id, leaf, now, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
), up AS (
  SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM l
  UNION ALL SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, {_HASH} FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 3, n
), top AS (
  SELECT 0 AS lvl, tree AS pos, (SELECT count(*) FROM s) AS n, h FROM up WHERE n = 1
  UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, {_HASH} FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n
), runs AS (
  SELECT 0 AS part, tree, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM up WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT 1, 0, lvl, pos // 3, list(h ORDER BY pos) FROM top WHERE n > 1 GROUP BY ALL
), fold AS (
  SELECT r, 0 AS part, tree, 0 AS lvl, pos, tree AS own, now AS h, '' AS proof FROM l
  UNION ALL
  SELECT r, CASE WHEN hs IS NULL THEN 1 ELSE f.part END, CASE WHEN hs IS NULL THEN 0 ELSE f.tree END, CASE WHEN hs IS NULL THEN 0 ELSE f.lvl + 1 END, CASE WHEN hs IS NULL THEN own ELSE f.pos // 3 END, own,
    CASE WHEN hs IS NULL THEN h ELSE sha256(array_to_string(list_transform(hs, lambda x, i: CASE WHEN i = f.pos % 3 + 1 THEN h ELSE x END), '')) END,
    proof || coalesce(array_to_string(list_filter(hs, lambda x, i: i <> f.pos % 3 + 1), ''), '')
  FROM fold f LEFT JOIN runs ON runs.part = f.part AND runs.tree = f.tree AND runs.lvl = f.lvl AND runs.run = f.pos // 3
  WHERE hs IS NOT NULL OR f.part = 0
), done AS (SELECT r, max_by(h, part * 100 + lvl) AS folded_root, max_by(proof, part * 100 + lvl) AS proof FROM fold GROUP BY r)
SELECT doc_id, leaf, up.h AS subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN done USING (r) JOIN up ON up.tree = l.tree AND up.n = 1 JOIN (SELECT h AS root FROM top WHERE n = 1) ON true
"""

_BEST = "list_min([{}])"
_EMPTY = "chr(10) || '{}:'"


def _edit(cost: str, letter: str, rest: str, line: str = "''") -> str:
    return f"{{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, 't': {line} || {rest}.t}}"


def _own(place: str) -> str:
    """The best of deleting, keeping and rerole-ing a turn at a place of the grammar (n, s, u, a), f being the rests."""
    to = "a" if place == "u" else "u"
    stay = {"n": "CASE WHEN ini = 's' THEN f.s WHEN ini = 'u' THEN f.u END", "s": "CASE WHEN ini = 'u' THEN f.u END", "u": "CASE WHEN ini = 'a' THEN f.a END", "a": "CASE WHEN ini = 'u' THEN f.u END"}[place]
    keep = f"CASE WHEN NOT must AND ({stay}) IS NOT NULL THEN {_edit('cut', 'K', f'({stay})', 'chr(10) || role || chr(58) || text')} END"
    rerole = f"CASE WHEN NOT must THEN {_edit('2 + cut', 'R', f'f.{to}', _EMPTY.format({'u': 'user', 'a': 'assistant'}[to]) + ' || text')} END"
    return _BEST.format(f"{_edit('3', 'D', f'f.{place}')}, {keep}, {rerole}")


def _with_insert(own: str, source: str, role: str) -> str:
    return _BEST.format(f"{own}, {_edit('2', 'I', source, _EMPTY.format(role))}")


_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP13 = f"""
WITH RECURSIVE {_TABLE}, hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS m FROM conversations, crc
), dam AS (
  SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role, CASE WHEN m = 1 THEN '' WHEN m = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN m = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE m <> 0
), pos AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, rtrim(text, {_WS}) AS body, left(role, 1) AS ini FROM dam
), flt AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY p) AS before, count(*) OVER (PARTITION BY conv_id) AS n
  FROM pos
), stat AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flt GROUP BY conv_id
), dp AS (
  SELECT conv_id, n + 1 AS p, {{'n': {{'c': 0, 'a': '', 't': ''}}, 's': {{'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}}, 'u': {{'c': 2, 'a': 'I', 't': chr(10) || 'assistant:'}}, 'a': {{'c': 0, 'a': '', 't': ''}}}} AS f FROM flt WHERE p = n
  UNION ALL
  SELECT conv_id, p, {{'n': {_with_insert('gn', 'fu', 'user')}, 's': {_with_insert('gs', 'fu', 'user')}, 'u': fu, 'a': {_with_insert('ga', 'gu', 'user')}}}
  FROM (
    SELECT conv_id, p, gn, gs, gu, ga, {_with_insert('gu', 'ga', 'assistant')} AS fu
    FROM (
      SELECT t.conv_id, t.p, {_own('n')} AS gn, {_own('s')} AS gs, {_own('u')} AS gu, {_own('a')} AS ga
      FROM dp JOIN (SELECT *, fault IN (1, 2) AS must, CAST(fault = 3 AS INT) AS cut FROM flt) t ON t.conv_id IS NOT DISTINCT FROM dp.conv_id AND t.p = dp.p - 1
    )
  )
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(f.n.c, 0) AS BIGINT) AS cost, coalesce(f.n.a, '') AS audit, sha256(coalesce(substr(f.n.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stat ON stat.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM o.conv_id AND dp.p = 1
"""

ORACLES = {
    "op1_chat_formatting": OP1, "op2_url_filters": OP2, "op4_ngram_jaccard_join": OP4, "op5_html_extraction": OP5, "op6_benchmark_decontamination": OP6, "op11_merkle_manifest": OP11,
    "op13_conversation_repair": OP13,
}
