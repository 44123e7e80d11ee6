"""DuckDB twins of the registered queries that SQL can express."""

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WS_RE = r"[\x20\x09-\x0D]+"

OP1 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
keyed AS (SELECT *, {LOWER.format(f"trim(line, {WS})")} AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keep_id FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.i, k.line, r.key IS NOT NULL AND k.doc_id <> r.keep_id AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP8 = f"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '{WS_RE}', '', 'g') AS norm
  FROM documents),
k AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept,
       sha256(norm) AS text_sha256
FROM k
"""

WORDS = f"regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP6 = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
b AS (SELECT DISTINCT item_id::VARCHAR AS item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[i + 1:i + least(10, len(w))] AS win
  FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, w[i + 1:i + n] AS win
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, widths WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id),
counts AS (SELECT t, count(*) AS c FROM (SELECT unnest(w) AS t FROM d) GROUP BY t),
rarest AS (
  SELECT item_id, w, t, r, max(r) OVER (PARTITION BY item_id, w) AS n_terms
  FROM (SELECT item_id, w, t, row_number() OVER (PARTITION BY item_id, w ORDER BY coalesce(c, 0), t) AS r
        FROM (SELECT DISTINCT item_id, w, unnest(w) AS t FROM b) LEFT JOIN counts USING (t))
  WHERE r <= 4),
spots AS (
  SELECT doc_id, t, i
  FROM (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS i FROM d) SEMI JOIN rarest USING (t)),
near AS (
  SELECT a.item_id, a.w, s.doc_id, s.i
  FROM rarest a JOIN spots s ON a.t = s.t AND a.r = 1
  JOIN rarest o ON o.item_id IS NOT DISTINCT FROM a.item_id AND o.w = a.w
  JOIN spots p ON p.doc_id = s.doc_id AND p.t = o.t AND p.i BETWEEN s.i - 20 AND s.i + 20
  GROUP BY ALL HAVING count(DISTINCT o.t) = any_value(a.n_terms)),
near_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM near GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id) LEFT JOIN near_items USING (doc_id)
"""

OP9 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all({LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])
    END) AS g
  FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 90 * (x.n + y.n - i)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles,
       least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id
"""

_DRAW = "('0x' || substr(md5(concat_ws(':', 17, epoch, coalesce(doc_id::VARCHAR, 'null'))), 1, 13))::BIGINT"

OP5 = f"""
WITH RECURSIVE t AS (
  SELECT * FROM (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens
    FROM documents) WHERE n_tokens > 0),
s AS (
  SELECT source, sum(n_tokens)::BIGINT AS tokens,
         sum(n_tokens)::DOUBLE / (SELECT sum(n_tokens) FROM t)::DOUBLE AS share
  FROM t GROUP BY source),
goal AS (SELECT h + 0.5 * (ln(n) - h) AS target FROM (SELECT -sum(share * ln(share)) AS h, count(*) AS n FROM s)),
search(low, high) AS (
  SELECT -1::BIGINT, 1048576::BIGINT
  UNION ALL
  SELECT CASE WHEN fits THEN low ELSE mid END, CASE WHEN fits THEN mid ELSE high END
  FROM (
    SELECT r.low, r.high, r.mid,
           ln(sum(pow(share, mid / 1048576.0))) - mid / 1048576.0
             * sum(pow(share, mid / 1048576.0) * ln(share)) / sum(pow(share, mid / 1048576.0))
             <= (SELECT target FROM goal) + 1e-12
           AND max(pow(share, mid / 1048576.0 - 1)) / sum(pow(share, mid / 1048576.0)) <= 4 + 1e-12 AS fits
    FROM (SELECT low, high, (low + high) // 2 AS mid FROM search WHERE high - low > 1) r, s
    GROUP BY r.low, r.high, r.mid)),
a AS (SELECT min(high) / 1048576.0 AS a FROM search),
w AS (
  SELECT source, tokens, floor(pow(share, a) / sum(pow(share, a)) OVER () * (SELECT sum(n_tokens) FROM t) + 1e-6)::BIGINT AS budget
  FROM s, a),
e AS (
  SELECT doc_id, source, n_tokens, tokens, budget, unnest(range(budget // tokens + 1)) AS epoch
  FROM t JOIN w USING (source)),
d AS (SELECT *, {_DRAW} AS draw FROM e),
o AS (
  SELECT *, row_number() OVER (PARTITION BY source, epoch ORDER BY draw, doc_id) AS i,
         budget // tokens AS last_epoch FROM d),
walk AS (  -- the last epoch, document by document: one that fits is taken, another is passed over
  SELECT source, i, n_tokens <= budget - epoch * tokens AS taken, epoch * tokens AS start,
         epoch * tokens + CASE WHEN n_tokens <= budget - epoch * tokens THEN n_tokens ELSE 0 END AS full_to
  FROM o WHERE epoch = last_epoch AND i = 1
  UNION ALL
  SELECT o.source, o.i, o.n_tokens <= o.budget - w.full_to, w.full_to,
         w.full_to + CASE WHEN o.n_tokens <= o.budget - w.full_to THEN o.n_tokens ELSE 0 END
  FROM walk w JOIN o ON o.source IS NOT DISTINCT FROM w.source AND o.epoch = o.last_epoch AND o.i = w.i + 1),
c AS (
  SELECT o.*, o.epoch * o.tokens + sum(o.n_tokens) OVER (PARTITION BY source, epoch ORDER BY i) - o.n_tokens AS start, TRUE AS taken
  FROM o WHERE epoch < last_epoch
  UNION ALL
  SELECT o.*, w.start, w.taken FROM o JOIN walk w ON o.source IS NOT DISTINCT FROM w.source AND o.i = w.i AND o.epoch = o.last_epoch),
u AS (
  SELECT *, floor(start * ceil((SELECT sum(budget) FROM w) / 262144.0) / budget)::BIGINT AS block
  FROM c WHERE taken)
SELECT doc_id, source, epoch, block,
       row_number() OVER (PARTITION BY block ORDER BY draw, source, doc_id, epoch) AS place, n_tokens
FROM u
"""

OP12 = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+'), []) AS units,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
d AS (
  SELECT *, len(units) AS n, {", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))}
  FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
         array_to_string(units[high + 1:], '') AS suffix
  FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def _crc_entry(i: int) -> int:
    for _ in range(8):
        i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
    return i


_CRC = f"[{', '.join(str(_crc_entry(i)) for i in range(256))}]"
_BYTES = "list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)"

OP13 = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, {LOWER.format('run')} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}),
                                 lambda c, b: xor(({_CRC}::BIGINT[])[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) AS h
  FROM bytes),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT DISTINCT c.word AS longer, c.n AS longer_n, w.word AS shorter, w.n AS shorter_n FROM cuts c JOIN words w ON w.word = c.a || c.b),
near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM cuts x JOIN cuts y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT longer, longer_n, shorter, shorter_n FROM pairs
  UNION SELECT shorter, shorter_n, longer, longer_n FROM pairs),
best AS (
  SELECT word, count(*)::BIGINT AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
         CASE WHEN other_n >= 10 * w.n THEN other_n END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
way AS (
  SELECT word, form AS last, 1 AS step FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT way.word, f.form, step + 1 FROM way JOIN formed f ON f.word = way.last WHERE f.form IS NOT NULL),
lasts AS (SELECT word, arg_max(last, step) AS root FROM way GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n
FROM formed LEFT JOIN lasts USING (word)
"""

ORACLE_SQL = {"op5_mix_sources": OP5,
              "op1_line_dedup": OP1, "op6_decontaminate": OP6, "op8_exact_dedup": OP8,
              "op9_ngram_join": OP9, "op12_fill_middle": OP12, "op13_spelling_variants": OP13}
