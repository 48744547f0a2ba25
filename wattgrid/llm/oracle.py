"""DuckDB SQL of the operators that SQL can express."""

from .licenses import NOTICES, PHRASES

_WORDS = r"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANKS = r"[^\x20\x09-\x0D]+"

OP5 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format(text='text', pattern=_LETTERS)} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(text='text', pattern=_LETTERS)} AS ws FROM benchmark),
win AS (SELECT DISTINCT item, ws[s:s + 9] AS words FROM
        (SELECT item, ws, unnest(range(1, greatest(2, len(ws) - 8))) AS s FROM b WHERE len(ws) > 0)),
dw AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
hit AS (SELECT DISTINCT dw.r, dw.p, win.item, len(win.words) AS n
        FROM dw JOIN (SELECT *, words[1] AS word FROM win) win USING (word) JOIN d USING (r)
        WHERE d.ws[dw.p:dw.p + len(win.words) - 1] = win.words),
pos AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN it USING (r)
"""

OP3 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text='text', pattern=_BLANKS)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
                                     ELSE [ws[i:i + 4] FOR i IN range(1, len(ws) - 3)] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
"""

_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

OP11 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '{_UNIT}') AS units FROM d),
k AS (SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS c1,
             CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS c2,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                  WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:least(c1, c2)], '') AS a, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
             array_to_string(units[greatest(c1, c2) + 1:], '') AS z FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(a) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
              ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def _templates() -> str:
    """Values (t, label, phrase, length, m, need, words) of the license templates."""
    rows = ", ".join(f"({t}, '{x.label}', {x.phrase}, {len(x.words)}, {len(set(x.words))}, {x.need}, {x.words})"
                     for t, x in enumerate((*PHRASES, *NOTICES)))
    return f"tpl AS (SELECT * FROM (VALUES {rows}) v(t, label, phrase, length, m, need, words))"


OP12 = rf"""
WITH {_templates()},
d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format(text='text', pattern=_LETTERS)} AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM d),
base AS (SELECT w.r, tpl.label, w.pos FROM w JOIN tpl ON tpl.phrase AND tpl.words[1] = w.word JOIN d USING (r)
         WHERE d.ws[w.pos + 1:w.pos + tpl.length] = tpl.words),
tok AS (SELECT DISTINCT t, label, length, m, need, unnest(words) AS word FROM tpl WHERE NOT phrase),
blocks AS (SELECT w.r, tok.label, tok.m, tok.need, count(DISTINCT w.word) OVER (
             PARTITION BY w.r, tok.t ORDER BY w.pos RANGE BETWEEN tok.length - 1 PRECEDING AND CURRENT ROW) AS overlap
           FROM w JOIN tok USING (word)),
every AS (SELECT r, label, overlap / m::DOUBLE AS share FROM blocks WHERE overlap >= need
          UNION ALL SELECT r, label, 1.0::DOUBLE FROM base),
b AS (SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
e AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM every GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, b.lo AS first_word, b.hi AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(e.labels, '') AS labels, coalesce(e.score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN e USING (r)
"""

SQL = {"op3_near_duplicates": OP3, "op5_decontamination": OP5, "op11_fill_in_middle": OP11, "op12_license_scan": OP12}
