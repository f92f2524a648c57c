"""SQL for the results of those operators that SQL can express, for DuckDB."""

from __future__ import annotations

from framewright.llm import links

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, lower(coalesce(text, '')) AS t, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents),
c AS (SELECT doc_id, ws, CASE WHEN len(ws) = 0 THEN 'none ' || t ELSE 'words ' || array_to_string(ws, ' ') END AS k FROM w),
cls AS (SELECT k, min(doc_id) AS rep, count(*) AS n, any_value(ws) AS ws FROM c GROUP BY k),
sh AS (SELECT DISTINCT rep, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT rep, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM cls WHERE len(ws) > 0)),
z AS (SELECT rep, count(*) AS m FROM sh GROUP BY rep),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS common FROM sh a JOIN sh b ON a.s = b.s AND a.rep < b.rep GROUP BY a.rep, b.rep),
l AS (SELECT p.a, p.b FROM p JOIN z x ON x.rep = p.a JOIN z y ON y.rep = p.b WHERE 5 * common >= 4 * (x.m + y.m - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b AS a, a AS b FROM l),
r AS (SELECT rep AS node, rep AS root FROM cls UNION SELECT e.b AS node, r.root AS root FROM r JOIN e ON e.a = r.node),
top AS (SELECT node, min(root) AS class_id FROM r GROUP BY node),
links AS (SELECT e.a AS rep, sum(cls.n) AS n FROM e JOIN cls ON cls.rep = e.b GROUP BY e.a)
SELECT c.doc_id, top.class_id, cls.rep AS copy_id, CAST(cls.n - 1 + coalesce(links.n, 0) AS BIGINT) AS n_links
FROM c JOIN cls USING (k) JOIN top ON top.node = cls.rep LEFT JOIN links ON links.rep = cls.rep
"""


def link_sql(rules: list[tuple[str, str]] = links.RULES, steps: int = 220, damping: float = links.DAMPING) -> str:
    """The propagation as plain iteration, far beyond the step at which ranks settle to the operator's tolerance."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    fits = lambda r: "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')".format(*r.split("/", 1))
    case = lambda i: "CASE " + " ".join(f"WHEN {fits(r[0])} THEN '{r[i]}'" for r in ordered) + " END"
    parts = [r"""u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path, html FROM pages)""",
        f"j AS MATERIALIZED (SELECT page_id, host, path, {case(0)} AS rule, {case(1)} AS ruled FROM u)",
        r"""a AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM u WHERE host <> '')""",
        "hy AS (SELECT src, dst, CAST(count(*) AS DOUBLE) AS w FROM a WHERE src <> dst GROUP BY src, dst)",
        "known AS (SELECT host FROM u WHERE host <> '' UNION SELECT dst FROM a WHERE dst <> '')",
        f"up AS (SELECT host AS a, regexp_replace(host, '^[^.]*[.]', '') AS b FROM known WHERE NOT regexp_matches(host, '[:\\[\\]]|^[0-9.]+$') UNION SELECT b, regexp_replace(b, '^[^.]*[.]', '') FROM up WHERE contains(b, '.'))",
        f"st AS (SELECT a, b FROM up WHERE a <> b AND contains(b, '.') AND b NOT IN ({', '.join(repr(x) for x in links.SUFFIXES)}))",
        "ed AS MATERIALIZED (SELECT src, dst, sum(w) AS w FROM (SELECT * FROM hy UNION ALL SELECT a, b, 1 FROM st UNION ALL SELECT b, a, 1 FROM st) GROUP BY src, dst)",
        "fl AS MATERIALIZED (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS fore, w / sum(w) OVER (PARTITION BY dst) AS back FROM ed)",
        "ph AS (SELECT host, count(*) FILTER (ruled = 'allow') AS t, count(*) FILTER (ruled = 'block') AS d FROM j WHERE host <> '' GROUP BY host)",
        "nodes AS (SELECT src AS host FROM fl UNION SELECT dst FROM fl UNION SELECT host FROM ph)",
        "r0 AS MATERIALIZED (SELECT n.host, coalesce(p.t / nullif(sum(p.t) OVER (), 0), 0) AS t, coalesce(p.d / nullif(sum(p.d) OVER (), 0), 0) AS d FROM nodes n LEFT JOIN ph p USING (host))"]
    parts.append(f"""rk AS (SELECT 0 AS k, host, t, d FROM r0 UNION ALL SELECT p.k + 1, r0.host, {1 - damping} * r0.t + {damping} * coalesce(x.t, 0), {1 - damping} * r0.d + {damping} * coalesce(y.d, 0)
FROM r0 CROSS JOIN (SELECT DISTINCT k FROM rk WHERE k < {steps}) p LEFT JOIN (SELECT dst AS host, sum(rk.t * fore) AS t FROM fl JOIN rk ON rk.host = fl.src GROUP BY dst) x ON x.host = r0.host
LEFT JOIN (SELECT src AS host, sum(rk.d * back) AS d FROM fl JOIN rk ON rk.host = fl.dst GROUP BY src) y ON y.host = r0.host)""")
    parts.append(f"last AS (SELECT host, t, d FROM rk WHERE k = {steps})")
    return f"WITH RECURSIVE {', '.join(parts)} SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN coalesce(d, 0) > coalesce(t, 0) THEN 'block' ELSE 'allow' END) AS verdict FROM j LEFT JOIN last USING (host)"


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
tot AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
ks AS (SELECT unnest(range(1, 6)) AS k),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, ks WHERE len(ws) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
x AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
inner_phrases AS (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM x))),
longer AS (SELECT lang, phrase, max(a) AS b FROM inner_phrases GROUP BY lang, phrase),
kept AS (SELECT x.* FROM x LEFT JOIN longer USING (lang, phrase) WHERE b IS NULL OR 100 * b < 100 * a),
cut AS (SELECT lang, phrase, a, c, array_to_string(ws[1:c], ' ') AS lp, array_to_string(ws[c + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS c FROM kept)),
s AS (SELECT cut.lang, cut.phrase, cut.a, cut.c, fl.a AS l, fr.a AS r, tot.n, CAST((CAST(1000 AS HUGEINT) * cut.a * tot.n) // (CAST(fl.a AS HUGEINT) * fr.a) AS BIGINT) AS score
FROM cut JOIN f fl ON fl.lang = cut.lang AND fl.phrase = cut.lp JOIN f fr ON fr.lang = cut.lang AND fr.phrase = cut.rp JOIN tot ON tot.lang = cut.lang),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low) WHERE rank <= 2000
"""

#: Windows as joined words; the words of documents are sorted out by the first word of a window's length of text.
DECONTAMINATE = rf"""
WITH b AS (SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[i:i + 9], ' ') AS g FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS g FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)),
occ AS MATERIALIZED (SELECT doc_id, i, g.m, item_id FROM g JOIN win ON win.m = g.m AND win.g = g.g),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS at FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def merkle_sql() -> str:
    """Levels by a recursion over runs of two; the proof and the tampered root by one over the levels."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda n: f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang'))} || {n} || {field('text')})"
    crc = "4294967295 - list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_prepend(CAST(ascii(c) AS BIGINT), list_transform(range(8), lambda x: CAST(-1 AS BIGINT)))))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS part, {leaf(field('n_chars'))} AS leaf, {leaf(field(f'(n_chars + CASE WHEN ({crc}) % 7 = 0 THEN 1 ELSE 0 END)'))} AS forged FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY part) AS m FROM d),
t AS (SELECT part, 0 AS lev, pos, m, leaf AS node FROM p UNION ALL
SELECT part, lev + 1, pos // 2, (m + 1) // 2, sha256(min(CASE WHEN pos % 2 = 0 THEN node END) || coalesce(min(CASE WHEN pos % 2 = 1 THEN node END), '')) FROM t WHERE m > 1 GROUP BY part, lev, pos // 2, m),
subs AS MATERIALIZED (SELECT part, node, row_number() OVER (ORDER BY part) - 1 AS pos, count(*) OVER () AS m FROM t WHERE m = 1),
u AS (SELECT 0 AS lev, pos, m, node FROM subs UNION ALL
SELECT lev + 1, pos // 2, (m + 1) // 2, sha256(min(CASE WHEN pos % 2 = 0 THEN node END) || coalesce(min(CASE WHEN pos % 2 = 1 THEN node END), '')) FROM u WHERE m > 1 GROUP BY lev, pos // 2, m),
low AS MATERIALIZED (SELECT p.part, p.pos, t.lev AS lev, (p.pos >> t.lev) & 1 AS odd, s.node AS sib FROM p JOIN (SELECT DISTINCT part, lev FROM t WHERE m > 1) t ON t.part = p.part LEFT JOIN t s ON s.part = p.part AND s.lev = t.lev AND s.pos = xor(p.pos >> t.lev, 1)),
high AS MATERIALIZED (SELECT subs.part, 100 + u.lev AS lev, (subs.pos >> u.lev) & 1 AS odd, s.node AS sib FROM subs JOIN (SELECT DISTINCT lev FROM u WHERE m > 1) u ON true LEFT JOIN u s ON s.lev = u.lev AND s.pos = xor(subs.pos >> u.lev, 1)),
way AS MATERIALIZED (SELECT part, pos, list(CASE odd WHEN 1 THEN 'l' ELSE 'r' END || coalesce(sib, '') ORDER BY lev) AS path FROM (SELECT * FROM low UNION ALL SELECT p.part, p.pos, high.lev, odd, sib FROM p JOIN high ON high.part = p.part) GROUP BY part, pos),
r AS (SELECT p.doc_id, leaf, subs.node AS subroot, (SELECT node FROM u WHERE m = 1) AS root, sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x[2:]), '')) AS proof_sha256,
list_reduce(list_prepend(forged, coalesce(path, [])), lambda c, x: CASE WHEN x[1] = 'l' THEN sha256(x[2:] || c) ELSE sha256(c || x[2:]) END) AS folded_root FROM p JOIN subs USING (part) LEFT JOIN way ON way.part = p.part AND way.pos = p.pos)
SELECT *, folded_root = root AS verified FROM r
"""
