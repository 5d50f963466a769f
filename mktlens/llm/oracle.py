"""DuckDB SQL for the document queries (verification only)."""

from __future__ import annotations

# Words of the white-space rule, of one text each.
_SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_STOP = (
    "'the','of','and','to','in','a','is','that','it','for','on','was','be','with','as','by','this','are','at','from','or','an',"
    "'der','die','das','und','von','den','mit','zu','ist','im','für','auf','nicht','ein','eine','sich','auch','als','des','dem',"
    "'de','la','le','les','et','en','un','une','du','que','qui','est','pour','dans','par','sur','au','il','elle',"
    "'el','los','las','y','del','se','con','por','su','para','no','al','lo'"
)

SQL: dict[str, str] = {}

SQL["op6_benchmark_decontamination"] = f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark
), win AS (
  SELECT item, least(10, len(w)) AS width, list_slice(w, i, i + least(10, len(w)) - 1) AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents
), cut AS (
  SELECT DISTINCT width FROM win
), dwin AS (
  SELECT r, width, i, list_slice(w, i, i + width - 1) AS gram
  FROM (SELECT r, width, w, unnest(range(1, len(w) - width + 2)) AS i FROM doc, cut)
), hit AS (
  SELECT d.r, d.width, d.i, win.item FROM dwin AS d JOIN win ON d.width = win.width AND d.gram = win.gram
), word AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + width)) AS p FROM hit) GROUP BY r
), item_of AS (
  SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(item_of.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(word.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN word ON doc.r = word.r LEFT JOIN item_of ON doc.r = item_of.r
"""

SQL["op7_quality_rules"] = rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_SPACE_WORDS} AS w FROM documents
), tri AS (
  SELECT r, i, list_slice(w, i, i + 2) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM doc)
), twice AS (
  SELECT r, unnest(range(i, i + 3)) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri) WHERE n >= 2
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM twice GROUP BY r
), line AS (
  SELECT r, l FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM doc) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), lines AS (
  SELECT r, count(*) AS n, count(DISTINCT l) AS d FROM line GROUP BY r
), m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.n - lines.d, 0) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
         len(regexp_extract_all(t, '[!?]')) AS n_marks, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop
  FROM doc LEFT JOIN rep ON doc.r = rep.r LEFT JOIN lines ON doc.r = lines.r
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2.5 * n_words AND 14 * n_words AND n_symbols <= 0.25 * n_words
         AND n_marks <= 0.5 * n_words AND n_upper <= 0.5 * word_chars AND n_stop >= 0.03 * n_words
         AND n_dup_lines <= 0.6 * n_lines AS kept
FROM b
"""

SQL["op8_substring_dedup"] = f"""
WITH doc AS (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id, {_SPACE_WORDS} AS w FROM documents
), win AS (
  SELECT r, i, array_to_string(list_slice(w, i, i + 19), ' ') AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 18)) AS i FROM doc WHERE len(w) >= 20)
), later AS (
  SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY gram ORDER BY r, i) AS n FROM win) WHERE n > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 20)) AS p FROM later
), word AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM doc
), kept AS (
  SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""


def _secret_sql() -> str:
    """Base and weak finds by pattern; the linking rule pair by pair, by the gap between two parts."""
    strong = {
        "assign": (r"""(?i:(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)""", 2, 6),
        "access": ("AKIA[A-Z0-9]+", 0, 20),
        "hex": ("[0-9a-f]+", 0, 24),
    }
    weak = {
        "ident": (
            r"""(?i:(?:access_key_id|client_id|account_id|user(?:name)?|login)["'']?\x20*[:=]\x20*["'']?)[A-Za-z0-9_.@+-]{4,}""",
            0,
            0,
        ),
        "key": ("[A-Za-z0-9+/_]{32,}={0,2}", 0, 32),
        "endpoint": (
            r"(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+",
            0,
            0,
        ),
    }
    parts = []
    for rank, (kind, (pattern, group, least)) in enumerate({**strong, **weak}.items()):
        mixed = (
            "AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')"
            if kind == "key"
            else ""
        )
        parts.append(
            f"SELECT r, {rank} AS rank, '{kind}' AS kind, e - length(m) AS a, e AS b FROM ("
            f"SELECT r, m, v, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i) AS e FROM ("
            f"SELECT r, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(v) AS v, unnest(list_slice(g, 1, len(m))) AS g FROM ("
            f"SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v, "
            f"string_split_regex(t, '{pattern}') AS g FROM doc))) WHERE length(v) >= {least} {mixed}"
        )
    return f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), part AS (
  {" UNION ALL ".join(parts)}
), base AS (
  SELECT * FROM part WHERE rank < 3
), loose AS (
  SELECT * FROM part AS p WHERE rank >= 3
  AND NOT EXISTS (SELECT 1 FROM base AS s WHERE s.r = p.r AND s.a <= p.a AND s.b >= p.b)
), role AS (
  SELECT *, CASE WHEN kind IN ('access', 'ident') THEN 'i' WHEN kind = 'endpoint' THEN 'e' ELSE 's' END AS part
  FROM (SELECT * FROM base UNION ALL SELECT * FROM loose)
), linked AS (
  SELECT DISTINCT x.r, x.rank, x.kind, x.a, x.b FROM role AS x JOIN role AS y
  ON x.r = y.r AND y.a - x.b <= 200 AND x.a - y.b <= 200 AND (x.part = 's') <> (y.part = 's') WHERE x.rank >= 3
), every AS (
  SELECT r, rank, kind, a, b FROM base UNION ALL SELECT * FROM linked
), found AS (
  SELECT r, count(*) FILTER (rank = 0) AS n0, count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans
  FROM every GROUP BY r
)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN found USING (r)
"""


SQL["op9_secret_scans"] = _secret_sql()

# crc32 byte by byte: a table of 256 steps of eight bits, then one look-up for
# each byte of '<doc_id>:<run>' in UTF-8 (letters up to U+00FF: one or two).
SQL["op12_spelling_variants"] = rf"""
WITH RECURSIVE step(i, k, c) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END FROM step WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8
), run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM documents
), each_run AS (
  SELECT id, w, count(*) AS m FROM run GROUP BY ALL
), hashed AS (
  SELECT w, m, xor(CAST(4294967295 AS BIGINT), list_reduce(
           list_transform(string_split(id || ':' || w, ''), lambda c: CAST(unicode(c) AS BIGINT)),
           lambda a, u: CASE WHEN u < 128 THEN xor(a >> 8, t[xor(a & 255, u) + 1])
             ELSE xor(xor(a >> 8, t[xor(a & 255, 195) + 1]) >> 8, t[xor(xor(a >> 8, t[xor(a & 255, 195) + 1]) & 255, u - 64) + 1]) END,
           CAST(4294967295 AS BIGINT))) AS h
  FROM each_run, crc
), word AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, m FROM hashed
), vocab AS (
  SELECT word, CAST(sum(m) AS BIGINT) AS n FROM word WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3
), place AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab
), blank AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM place
), near AS (
  SELECT a.word, b.word AS other, b.n FROM blank AS a JOIN blank AS b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM blank AS a JOIN vocab AS b ON b.word = a.l || a.r
  UNION
  SELECT b.word, a.word, a.n FROM blank AS a JOIN vocab AS b ON b.word = a.l || a.r
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word
), form AS (
  SELECT v.word, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN top >= 2 * v.n THEN (SELECT min(x.other) FROM near AS x WHERE x.word = v.word AND x.n = top) END AS form,
         CASE WHEN top >= 2 * v.n THEN top END AS form_n
  FROM vocab AS v LEFT JOIN best ON v.word = best.word
), chain(word, goal, depth) AS (
  SELECT word, word, 0 FROM form
  UNION ALL
  SELECT chain.word, form.form, depth + 1 FROM chain JOIN form ON chain.goal = form.word WHERE form.form IS NOT NULL
), root AS (
  SELECT word, arg_max(goal, depth) AS root FROM chain GROUP BY word
)
SELECT form.word, form, root, n, n_near, form_n FROM form JOIN root ON form.word = root.word
"""
