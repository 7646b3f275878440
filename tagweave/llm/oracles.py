"""DuckDB SQL of the queries that SQL can express: by the definition of the result, not the method."""

from __future__ import annotations

from tagweave.llm import decontaminate as D
from tagweave.llm import divergence_audit as A
from tagweave.llm import jaccard_join as J
from tagweave.llm import merkle as M
from tagweave.llm import minhash_dedup as H
from tagweave.llm import quality_rules as Q

_SPACE = r"\x20\x09-\x0D"
_WORD = rf"[^{_SPACE}]+"


def _chars(pattern: str) -> str:
    return f"length(text) - length(regexp_replace(text, '{pattern}', '', 'g'))"


_CLASSES = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "space": f"[{_SPACE}]",
            "sentence": "[.,;:!?''\"()-]", "other": r"[^\x00-\x7F]"}

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, COALESCE(text, '') AS text, lang FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{_WORD}') AS w FROM d),
tok AS (SELECT rid, unnest(w) AS w, generate_subscripts(w, 1) AS pos FROM w),
tri AS (SELECT rid, pos, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM tok
        WINDOW o AS (PARTITION BY rid ORDER BY pos)),
twice AS (SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, w, w1, w2) AS n FROM tri
          WHERE w2 IS NOT NULL) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT pos + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS l FROM d),
base AS (SELECT d.rid, doc_id, lang, len(w.w) AS n_words,
  COALESCE(list_sum(list_transform(w.w, lambda x: length(x))), 0) AS word_chars,
  {_chars('[#*$%&|<>]')} AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
  COALESCE(rep.n, 0) AS n_repeat_words, length(text) AS chars,
  {', '.join(f"{_chars(p)} AS c_{k}" for k, p in _CLASSES.items())}
  FROM d JOIN w USING (rid) JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
judged AS (SELECT *, n_words < {Q.MIN_N_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  chars - {' - '.join(f'c_{k}' for k in _CLASSES)} AS c_symbol FROM base),
cls AS (UNPIVOT (SELECT rid, lang, base_failed, {', '.join(f'c_{k}' for k in Q.CLASSES)} FROM judged)
        ON COLUMNS('c_.*') INTO NAME k VALUE n),
refw AS (SELECT j.lang, w, count(*) AS n FROM tok JOIN judged j USING (rid)
         WHERE NOT base_failed AND j.lang IS NOT NULL GROUP BY j.lang, w),
tot AS (SELECT lang, sum(n) AS total FROM refw GROUP BY lang HAVING sum(n) >= {Q.MIN_REFERENCE}),
top AS (SELECT lang, w, n / total AS q FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS r
        FROM refw) JOIN tot USING (lang) WHERE r <= {Q.COMMON}),
bins AS (SELECT lang, w, q FROM top UNION ALL SELECT lang, NULL, 1 - sum(q) FROM top GROUP BY lang),
refc AS (SELECT lang, k, n / sum(n) OVER (PARTITION BY lang) AS q FROM (SELECT lang, k, sum(n) AS n FROM cls
         WHERE NOT base_failed AND lang IS NOT NULL GROUP BY lang, k) JOIN tot USING (lang)),
cand AS (SELECT j.rid, t.lang AS ref FROM judged j JOIN tot t
         ON t.lang = j.lang OR j.lang IS NULL),
cd AS (SELECT rid, ref, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS cd
       FROM (SELECT c.rid, x.ref, cls.n / c.chars AS p, r.q FROM judged c JOIN cand x USING (rid) JOIN cls USING (rid)
             JOIN refc r ON r.lang = x.ref AND r.k = cls.k WHERE c.chars > 0) GROUP BY rid, ref),
docw AS (SELECT t.rid, x.ref, top.w AS w, count(*) AS n FROM tok t JOIN cand x USING (rid)
         LEFT JOIN top ON top.lang = x.ref AND top.w = t.w GROUP BY ALL),
wd AS (SELECT rid, ref, sqrt(greatest((sum(p * log2(2 * p / (p + q)) + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q))
         ELSE 0 END) + 1 - sum(q)) / 2, 0)) AS wd
       FROM (SELECT dw.rid, dw.ref, dw.n / j.n_words AS p, b.q FROM docw dw JOIN judged j USING (rid)
             JOIN bins b ON b.lang = dw.ref AND b.w IS NOT DISTINCT FROM dw.w) GROUP BY rid, ref),
best AS (SELECT rid, arg_min(COALESCE(cd, 0), (COALESCE(cd, 0) + COALESCE(wd, 0), ref)) AS cd,
         arg_min(COALESCE(wd, 0), (COALESCE(cd, 0) + COALESCE(wd, 0), ref)) AS wd
         FROM cand LEFT JOIN cd USING (rid, ref) LEFT JOIN wd USING (rid, ref) GROUP BY rid)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (chars >= {Q.MIN_CHARS} AND COALESCE(cd, 0) > {Q.MAX_CLASS_DISTANCE})
  AND NOT (n_words >= {Q.MIN_WORDS} AND COALESCE(wd, 0) > {Q.MAX_WORD_DISTANCE}) AS kept
FROM judged LEFT JOIN best USING (rid)
"""

_T = round(1000 * J.THRESHOLD)
JACCARD = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(COALESCE(text, ''), '{_WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT rid, unnest(list_transform(range(1, greatest(len(w) - {J.N - 2}, 2)),
       lambda i: array_to_string(w[i:i + {J.N - 1}], ' '))) AS s FROM d WHERE len(w) > 0),
size AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
common AS (SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.rid <> b.rid GROUP BY a.rid, b.rid),
links AS (SELECT a, b, k = x.n AND k = y.n AS same FROM common JOIN size x ON x.rid = a JOIN size y ON y.rid = b
          WHERE 1000 * k >= {_T} * (x.n + y.n - k)),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
class AS (SELECT a, min(doc_id) AS class_id FROM reach JOIN d ON d.rid = b GROUP BY a),
own AS (SELECT a, count(*) AS n_links, count(*) FILTER (WHERE same) AS copies, min(doc_id) FILTER (WHERE same) AS other
        FROM links JOIN d ON d.rid = b GROUP BY a)
SELECT doc_id, class_id, least(doc_id, COALESCE(other, doc_id)) AS copy_id,
  CAST(1 + COALESCE(copies, 0) AS BIGINT) AS n_copies, CAST(COALESCE(n_links, 0) AS BIGINT) AS n_links
FROM d JOIN class ON class.a = rid LEFT JOIN own ON own.a = rid
"""

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _plain(text: str) -> str:
    return rf"regexp_extract_all(translate(COALESCE({text}, ''), '{_AZ}', '{_AZ.lower()}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"


def _grams(words: str, n: str) -> str:
    return (f"list_distinct(list_transform(range(1, greatest(len({words}) - {n} + 1, CASE WHEN len({words}) > 0 THEN 1 ELSE 0 END) + 1), "
            f"lambda i: array_to_string({words}[i:i + {n} - 1], ' ')))")


def _share(part: str, n: str) -> str:
    return (f"CASE WHEN len({part}) = 0 THEN 1 ELSE len(list_filter({part}, lambda g: list_contains({_grams('pw', n)}, g))) "
            f"/ len({part}) END")


def _n(part: str) -> str:
    return f"CASE {' '.join(f'WHEN len({part}) < {below} THEN {n}' for below, n in D.SHORT_N)} ELSE {D.N} END"


LEAKS = rf"""
WITH i AS (SELECT row_number() OVER () AS iid, item_id, trim(COALESCE(text, ''), ' ' || chr(9) || chr(10) || chr(11)
  || chr(12) || chr(13)) AS t, {_plain('text')} AS w FROM benchmark),
qa AS (SELECT iid, item_id, {_plain("CASE WHEN contains(t, chr(10)) THEN regexp_extract(t, '(?s)^(.*)' || chr(10), 1) ELSE t END")} AS q,
  {_plain("CASE WHEN contains(t, chr(10)) THEN regexp_extract(t, '[^' || chr(10) || ']*$') ELSE '' END")} AS a FROM i),
parts AS (SELECT iid, item_id, greatest(least({_n('q')}, len(q)), 1) AS qn, greatest(least({_n('a')}, len(a)), 1) AS an, q, a FROM qa),
grams AS (SELECT iid, item_id, qn, an, {_grams('q', 'qn')} AS qg, {_grams('a', 'an')} AS ag FROM parts),
s AS (SELECT greatest({D.LEAST_STRIDE}, max(len(w))) AS stride, count(*) AS n, greatest(avg(len(w)), 1) AS mean FROM i),
tf AS (SELECT iid, term, count(*) AS tf FROM (SELECT iid, unnest(w) AS term FROM i) GROUP BY iid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT iid, term, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {D.K1 + 1}
  / (tf + {D.K1} * (1 - {D.B} + {D.B} * len(w) / mean)) AS x FROM tf JOIN df USING (term) JOIN i USING (iid), s),
own AS (SELECT iid, term, x / sum(x) OVER (PARTITION BY iid) AS x FROM weight),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_plain('text')} AS w FROM documents),
tok AS (SELECT rid, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS k, len(w) AS n FROM d),
place AS (SELECT rid, term, k // stride AS p, greatest(1, CAST(ceil(tok.n / stride) AS BIGINT) - 1) AS ps FROM tok, s),
passage AS (SELECT DISTINCT rid, least(p, ps - 1) AS p, term FROM place UNION SELECT rid, greatest(p - 1, 0), term FROM place),
found AS (SELECT rid, p, iid FROM passage JOIN own USING (term) GROUP BY rid, p, iid HAVING sum(x) >= {D.MIN_SCORE}),
text AS (SELECT f.rid, f.iid, doc_id, w[p * stride + 1:(p + 2) * stride] AS pw FROM found f JOIN d USING (rid), s)
SELECT DISTINCT doc_id, item_id FROM text JOIN grams USING (iid)
WHERE {_share('qg', 'qn')} >= {D.MIN_QUESTION} AND {_share('ag', 'an')} >= {D.MIN_ANSWER}
"""


def _p(count: str, total: str) -> str:
    return f"(1 + 1000000000::HUGEINT * ({count} + 1) // {total})"


AUDIT = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
  regexp_extract_all(translate(COALESCE(text, ''), '{_AZ}', '{_AZ.lower()}'), '[a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
tok AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM tok GROUP BY lang, term HAVING count(DISTINCT rid) >= {A.MIN_DOCS}),
n AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(lang_n) + count(*) AS lang_total FROM kept GROUP BY lang),
g AS (SELECT lang, source, v, lang_total, COALESCE(s, 0) + v AS total FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS s FROM n GROUP BY ALL) USING (lang, source) LEFT JOIN l USING (lang)),
p AS (SELECT g.lang, g.source, term, COALESCE(n, 0) AS n, {_p('COALESCE(n, 0)', 'total')} AS p, {_p('lang_n', 'lang_total')} AS q
  FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(z.v, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS v
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) z
  ON z.lang = a.lang AND z.source = a.source AND z.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR r <= {A.TOP}
"""


def merkle(group_levels: int = 8, top_levels: int = 3) -> str:
    """Levels written out: to ``FANOUT ** group_levels`` rows a language and ``FANOUT ** top_levels`` languages."""
    field = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in M.FIELDS) + ")"
    parts = [f"""
WITH crc AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_concat([n], range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(n))),
d AS (SELECT *, COALESCE(xor(4294967295, list_reduce(list_concat([4294967295],
  list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % {M.TAMPER_EVERY} = 0, false) AS hit FROM documents, crc),
leaf AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS k, {leaf('text')} AS leaf,
  CASE WHEN hit THEN {leaf(f"translate(text, '{_AZ}', '{_AZ.lower()}')")} ELSE {leaf('text')} END AS changed FROM d),
c0 AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
  changed AS f, '' AS proof FROM leaf),
t0 AS (SELECT k, p AS pos, leaf AS h, count(*) OVER (PARTITION BY k) AS n FROM c0)"""]

    def level(j: int) -> str:
        return f"""
t{j + 1} AS (SELECT k, pos, h, count(*) OVER (PARTITION BY k) AS n FROM (SELECT k, pos // {M.FANOUT} AS pos,
  CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY t.pos)) ELSE any_value(h) END AS h FROM t{j} t GROUP BY k, n, t.pos // {M.FANOUT})),
c{j + 1} AS (SELECT rid, c.k, c.p // {M.FANOUT} AS p, any_value(doc_id) AS doc_id, any_value(leaf) AS leaf,
  CASE WHEN n > 1 THEN sha256(string_agg(CASE WHEN t.pos = c.p THEN f ELSE h END, '' ORDER BY t.pos)) ELSE any_value(f) END AS f,
  any_value(proof) || COALESCE(string_agg(h, '' ORDER BY t.pos) FILTER (t.pos <> c.p), '') AS proof
  FROM c{j} c JOIN t{j} t ON t.k = c.k AND t.pos // {M.FANOUT} = c.p // {M.FANOUT} GROUP BY rid, c.k, c.p, n)"""

    parts += [level(j) for j in range(group_levels)]
    g, r = group_levels, group_levels + 1 + top_levels
    parts.append(f"""
t{g + 1} AS (SELECT 0 AS k, k AS pos, h, count(*) OVER () AS n FROM t{g}),
c{g + 1} AS (SELECT rid, 0 AS k, c.k AS p, doc_id, leaf, f, proof FROM c{g} c)""")
    parts += [level(j) for j in range(g + 1, r)]
    return ",".join(parts) + f"""
SELECT c.doc_id, c.leaf, s.h AS subroot, t{r}.h AS root, sha256(c.proof) AS proof_sha256, c.f AS folded_root, c.f = t{r}.h AS verified
FROM c{r} c, t{r}, c0, t{g} s WHERE c0.rid = c.rid AND s.k = c0.k
"""


# a pair at SHARE shares at least that part of the smaller set, so one of any (100 - SHARE) % + 1 shingles of each set is common:
# the rarest ones find the candidates
DEDUP = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(COALESCE(text, ''), '{_AZ}', '{_AZ.lower()}'), '{_WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT rid, unnest(list_transform(range(1, greatest(len(w) - {H.N - 2}, 2)),
       lambda i: array_to_string(w[i:i + {H.N - 1}], ' '))) AS s FROM d WHERE len(w) > 0),
size AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
num AS (SELECT s, row_number() OVER (ORDER BY count(*), s) AS k FROM sh GROUP BY s),
numbered AS (SELECT rid, k, n, row_number() OVER (PARTITION BY rid ORDER BY k) AS place FROM sh JOIN num USING (s) JOIN size USING (rid)),
rare AS (SELECT rid, k, n FROM numbered WHERE place <= n - (n * {H.SHARE} + 99) // 100 + 1),
near AS (SELECT DISTINCT a.rid AS a, b.rid AS b FROM rare a JOIN rare b ON a.k = b.k AND a.rid < b.rid
         AND 100 * least(a.n, b.n) >= {H.SHARE} * greatest(a.n, b.n)),
one AS (SELECT rid, list(k) AS ks, any_value(n) AS n FROM numbered GROUP BY rid),
pairs AS (SELECT a, b, x.n + y.n AS total, len(list_intersect(x.ks, y.ks)) AS k FROM near JOIN one x ON x.rid = a JOIN one y ON y.rid = b),
links AS (SELECT a, b FROM pairs WHERE 100 * k >= {H.SHARE} * (total - k) UNION ALL
          SELECT b, a FROM pairs WHERE 100 * k >= {H.SHARE} * (total - k)),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT any_value(d.doc_id) AS doc_id, COALESCE(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id,
  any_value(d.doc_id) IS NOT DISTINCT FROM min(o.doc_id) AS kept
FROM reach JOIN d ON d.rid = a JOIN d o ON o.rid = b LEFT JOIN size ON size.rid = a GROUP BY a
"""
