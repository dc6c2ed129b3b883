"""DuckDB twins of the operators' queries, where SQL can express them."""
from __future__ import annotations

from .op1_substring_dedup import LONG, SENTENCES, WORDS
from .op6_quality_rules import CURRENT, POLICIES, RULES, bit_mask
from .op8_url_filters import HOST_RULES, PATTERN_RULES
from .op9_line_dedup import MIN_SITES
from .op12_spelling_variants import DAMAGE, MIN_CHARS, MIN_COUNT, RATIO
from .op10_mixture import DOMAINS, MAX_EPOCHS, SEED, SHARE, WEIGHTS

# ---- op1: sentences and runs by joins, occurrences ranked ------------------------------------------------------
OP1 = rf"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '(?s).*?(?:[.!?]+\s+|\n\s*)|.+') AS ps FROM documents),
s AS (SELECT doc_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos FROM d),
t AS (SELECT doc_id, pos, piece, lower(regexp_replace(piece, '^\s+|\s+$', '', 'g')) AS norm FROM s),
w AS (SELECT *, sum(CASE WHEN norm = '' THEN 0 ELSE length(norm) - length(replace(norm, ' ', '')) + 1 END)
             OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM t),
z AS (SELECT doc_id, pos AS j, upto FROM w UNION ALL SELECT doc_id, 0, 0 FROM d),
ok AS (SELECT a.doc_id, a.j AS i, b.j AS j FROM z a JOIN z b ON a.doc_id = b.doc_id AND b.j > a.j
       AND (b.upto - a.upto >= {LONG} OR (b.j - a.j >= {SENTENCES} AND b.upto - a.upto >= {WORDS}))),
runs AS (SELECT doc_id, i, min(j) AS j FROM ok GROUP BY ALL UNION SELECT doc_id, max(i) AS i, j FROM ok GROUP BY doc_id, j),
lists AS (SELECT doc_id, list(norm ORDER BY pos) AS l FROM t GROUP BY doc_id),
keyed AS (SELECT r.doc_id, i, j, row_number() OVER (PARTITION BY array_to_string(l[i + 1:j], chr(1)) ORDER BY r.doc_id, i) AS n
          FROM runs r JOIN lists USING (doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i + 1, j)) AS pos FROM keyed WHERE n > 1),
kept AS (SELECT t.doc_id, coalesce(string_agg(piece, '' ORDER BY pos) FILTER (WHERE g.pos IS NULL), '') AS text, count(*) AS n_sentences,
                count(g.pos) AS n_removed FROM t LEFT JOIN gone g USING (doc_id, pos) GROUP BY t.doc_id)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(n_sentences, 0) AS n_sentences,
       coalesce(n_removed, 0) AS n_removed FROM d LEFT JOIN kept k USING (doc_id)"""

# ---- op5: windows by unnesting and an equi-join ----------------------------------------------------------------
_WORDS5 = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
OP5 = f"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS5} AS w FROM benchmark),
bl AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS k
        FROM (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM bl)),
d AS (SELECT doc_id, {_WORDS5} AS w FROM documents),
occ AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS k
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
              FROM d CROSS JOIN (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, p, occ.n, item FROM occ JOIN win ON occ.n = win.n AND occ.k = win.k),
spots AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)"""

# ---- op6: windows counted with a window function ---------------------------------------------------------------
_BITS = " + ".join(f"CASE WHEN {cond} THEN {1 << k} ELSE 0 END" for k, cond in enumerate(RULES.values()))
_HARD, _SOFT, _BASE = bit_mask(CURRENT.hard), bit_mask(CURRENT.soft), bit_mask(POLICIES["base", 1].hard)
OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
           FROM documents),
p AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS j FROM c WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_upper,
             CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct_words
      FROM d LEFT JOIN r USING (doc_id)),
f AS (SELECT *, CAST({_BITS} AS BIGINT) AS fails FROM m)
SELECT *, (fails & {_BASE}) <> 0 AS base_failed,
       (fails & {_BASE}) = 0 AND (fails & {_HARD}) = 0 AND bit_count(fails & {_SOFT}) <= {CURRENT.allowed} AS kept FROM f"""


# ---- op8: every rule against every URL -------------------------------------------------------------------------
def _op8() -> str:
    hosts = ", ".join(f"('{r.name}', '{r.verdict}', '{r.name.partition('/')[0]}', '/{r.name.partition('/')[2]}')" for r in HOST_RULES)
    pats = ", ".join(f"('{r.name}', '{r.verdict}', '{r.regex}')" for r in PATTERN_RULES)
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path,
             translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS rest FROM u),
hr(name, verdict, rhost, rpath) AS (VALUES {hosts}),
pr(name, verdict, regex) AS (VALUES {pats}),
byhost AS (SELECT page_id, arg_max(name, length(name)) AS name, arg_max(verdict, length(name)) AS verdict
           FROM h JOIN hr ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
bypat AS (SELECT page_id, first(name ORDER BY length(name) DESC, verdict = 'block' DESC, name) AS name,
                 first(verdict ORDER BY length(name) DESC, verdict = 'block' DESC, name) AS verdict
          FROM h JOIN pr ON regexp_matches(rest, regex) GROUP BY page_id)
SELECT page_id, host, path, a.name AS rule, coalesce(a.verdict, b.verdict, 'allow') AS verdict,
       CASE WHEN a.name IS NULL THEN b.name END AS pattern
FROM h LEFT JOIN byhost a USING (page_id) LEFT JOIN bypat b USING (page_id)"""


# ---- op9: exact distinct sites ---------------------------------------------------------------------------------
OP9 = f"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, source, unnest(ls) AS x, generate_subscripts(ls, 1) AS pos FROM d),
bad AS (SELECT trim(x, ' ') AS t FROM l WHERE trim(x, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
g AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY pos) FILTER (WHERE b.t IS NULL) AS text,
             count(*) FILTER (WHERE trim(x, ' ') <> '') AS n_lines, count(b.t) AS n_removed
      FROM l LEFT JOIN bad b ON trim(l.x, ' ') = b.t GROUP BY doc_id)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(g.text, '') END AS text, coalesce(n_lines, 0) AS n_lines,
       coalesce(n_removed, 0) AS n_removed FROM d LEFT JOIN g USING (doc_id)"""


# ---- op10: each sibling's saturation tested against the whole water level -------------------------------------
def _op10() -> str:
    levels = ["domain", "lang", "source"]
    dom = "CASE " + " ".join(f"WHEN source IN ({', '.join(repr(s) for s in v)}) THEN '{k}'" for k, v in DOMAINS.items()) + " ELSE 'other' END"
    ctes = [rf"""docs AS (SELECT {dom} AS domain, lang, source, doc_id,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents)""",
            """leaf AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens FROM docs GROUP BY ALL)""",
            f"""n0 AS (SELECT CAST(floor(CAST(sum(tokens) AS DOUBLE) * {SHARE}) AS HUGEINT) AS asked, sum(tokens) * {MAX_EPOCHS} AS cap FROM leaf)""",
            "b0 AS (SELECT least(asked, cap) AS b FROM n0)"]
    for k in range(3):
        node, parent = levels[:k + 1], levels[:k]
        w = "CASE " + " ".join("WHEN " + " AND ".join(f"{c} = '{v}'" for c, v in zip(node, names)) + f" THEN {x}"
                               for names, x in WEIGHTS.items() if len(names) == k + 1) + " ELSE 1 END"
        same = " AND ".join(f"x.{c} IS NOT DISTINCT FROM y.{c}" for c in parent) or "true"
        up = ", ".join(parent)
        part = f"PARTITION BY {up}" if up else ""
        ctes += [
            f"m{k} AS (SELECT {', '.join(node)}, CAST({w} AS HUGEINT) AS w, sum(tokens) * {MAX_EPOCHS} AS c FROM leaf GROUP BY {', '.join(node)})",
            (f"p{k} AS (SELECT x.*, y.b FROM m{k} x JOIN b{k} y ON {same})" if k else f"p{k} AS (SELECT x.*, y.b FROM m{k} x CROSS JOIN b{k} y)"),
            # full if the water level that just fills this child needs no more than the parent's budget
            f"f{k} AS (SELECT {', '.join('x.' + c for c in node)}, any_value(x.w) AS w, any_value(x.c) AS c, any_value(x.b) AS b, "
            f"sum(least(y.c * x.w, y.w * x.c)) <= any_value(x.b * x.w) AS full_ FROM p{k} x JOIN p{k} y ON {same} GROUP BY {', '.join('x.' + c for c in node)})",
            f"r{k} AS (SELECT *, b - coalesce(sum(c) FILTER (WHERE full_) OVER ({part}), 0) AS rest, "
            f"sum(w) FILTER (WHERE NOT full_) OVER ({part}) AS ow, "
            f"sum(w) FILTER (WHERE NOT full_) OVER ({part} ORDER BY CAST(c AS DOUBLE) / CAST(w AS DOUBLE), {node[-1]}) AS cw FROM f{k})",
            f"b{k + 1} AS (SELECT {', '.join(node)}, CASE WHEN full_ THEN c ELSE CAST(rest * cw // ow - rest * (cw - w) // ow AS HUGEINT) END AS b FROM r{k})"]
    ctes += ["""q AS (SELECT l.*, CASE WHEN tokens = 0 THEN 0 ELSE b // tokens END AS epochs, CASE WHEN tokens = 0 THEN 0 ELSE b % tokens END AS rest
  FROM leaf l JOIN b3 ON l.domain IS NOT DISTINCT FROM b3.domain AND l.lang IS NOT DISTINCT FROM b3.lang AND l.source IS NOT DISTINCT FROM b3.source)""",
             f"""o AS (SELECT d.*, epochs, rest, tokens, sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
  ORDER BY md5('{SEED}-' || CAST(epochs + 1 AS VARCHAR) || '-' || coalesce(CAST(doc_id AS VARCHAR), 'null')), doc_id) AS upto
  FROM docs d JOIN q ON d.domain IS NOT DISTINCT FROM q.domain AND d.lang IS NOT DISTINCT FROM q.lang AND d.source IS NOT DISTINCT FROM q.source)""",
             "t AS (SELECT *, CASE WHEN tokens = 0 THEN 1 ELSE epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END END AS n FROM o)"]
    return "WITH " + ",\n".join(ctes) + ("\nSELECT doc_id, domain, lang, source, n_tokens, CAST(e AS INTEGER) AS epoch FROM "
                                          "(SELECT *, unnest(generate_series(1, CAST(n AS BIGINT))) AS e FROM t WHERE n > 0)")



def crc_table() -> list[int]:
    """The 256 remainders of CRC-32, by its rule (reflected polynomial EDB88320)."""
    table = []
    for r in range(256):
        for _ in range(8):
            r = r >> 1 ^ (0xEDB88320 if r & 1 else 0)
        table.append(r)
    return table


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes; ``crc`` must be a CTE that holds ``crc_table`` as ``tab``."""
    digits = f"hex(encode({text}))"
    codes = f"list_transform(range(1, length({digits}), 2), lambda i: CAST('0x' || substr({digits}, i, 2) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
            f"lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), CAST(4294967295 AS BIGINT))")


_CRC = f"crc AS MATERIALIZED (SELECT CAST({crc_table()} AS BIGINT[]) AS tab)"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# ---- op11: shingle sets by an inverted index, components by repeated least labels ---------------------------------
OP11 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
             FROM (SELECT doc_id, w, least(2, len(w)) AS n FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
df AS (SELECT s, count(*) AS f FROM sh GROUP BY s),
pre AS (SELECT doc_id, s FROM (SELECT sh.doc_id, s, n, row_number() OVER (PARTITION BY sh.doc_id ORDER BY f, s) AS r
                               FROM sh JOIN df USING (s) JOIN n USING (doc_id)) WHERE r <= n - CAST(ceil(n * 80 / 100.0) AS BIGINT) + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM pre a JOIN pre b ON a.s = b.s AND a.doc_id < b.doc_id),
common AS (SELECT a, b, count(*) AS c FROM cand JOIN sh x ON x.doc_id = a JOIN sh y ON y.doc_id = b AND y.s = x.s GROUP BY a, b),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS node, a AS to_id FROM edge UNION SELECT r.node, e.b FROM reach r JOIN edge e ON e.a = r.to_id),
comp AS (SELECT node, min(to_id) AS least FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, d.doc_id) AS component_id, coalesce(least, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.node = d.doc_id"""

# ---- op12: near words by equal deletions --------------------------------------------------------------------------
OP12 = rf"""
WITH RECURSIVE {_CRC},
d AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
r AS (SELECT doc_id, run, count(*) AS c FROM d GROUP BY doc_id, run),
h AS (SELECT run, c, {crc32("coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run")} AS h FROM r, crc),
w AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM w GROUP BY word HAVING length(word) >= {MIN_CHARS} AND sum(c) >= {MIN_COUNT}),
gone AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
         FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS p FROM v)),
near AS (SELECT a.word, b.word AS x, b.n AS m FROM gone a JOIN gone b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT a.word, v.word, v.n FROM gone a JOIN v ON v.word = a.rest
         UNION SELECT v.word, a.word, a.n FROM gone a JOIN v ON v.word = a.rest),
best AS (SELECT word, x, m, row_number() OVER (PARTITION BY word ORDER BY m DESC, x) AS k, count(*) OVER (PARTITION BY word) AS c FROM near),
f AS (SELECT v.word, v.n, coalesce(c, 0) AS n_near, CASE WHEN m >= {RATIO} * v.n THEN x END AS form, CASE WHEN m >= {RATIO} * v.n THEN m END AS form_n
      FROM v LEFT JOIN best ON best.word = v.word AND k = 1),
walk AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.next)
SELECT f.*, walk.at AS root FROM f JOIN walk ON walk.word = f.word AND walk.next IS NULL"""

# ---- op13: the cheapest edits by dynamic programming over rows, all order states at once --------------------------
_VISIBLE = r"'[^\x20\x09-\x0D]'"
OP13 = rf"""
WITH RECURSIVE {_CRC},
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS h FROM conversations, crc),
dam AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
               CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(generate_series(1, CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM raw WHERE h <> 0),
ord AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM dam),
seen AS (SELECT *, substr(role, 1, 1) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS same,
                lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM ord),
rows AS (SELECT *, CASE WHEN NOT regexp_matches(text, {_VISIBLE}) THEN 'blank' WHEN same > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM seen),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
                  count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                  count(*) FILTER (WHERE k > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM rows GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
-- states: 0 nothing, 1 system, 2 user, 3 assistant; moves (state, initial, inserted initials, next state)
moves AS (SELECT * FROM (VALUES (0, 's', '', 1), (0, 'u', '', 2), (0, 'a', 'u', 3), (1, 'u', '', 2), (1, 'a', 'u', 3), (2, 'a', '', 3),
                                (2, 'u', 'a', 2), (3, 'u', '', 2), (3, 'a', 'u', 3)) t(state, i, ins, next)),
edits AS (SELECT conv_id, k, 'K' AS e, i, role || ':' || text AS line, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS price
          FROM rows WHERE fault IN ('', 'truncated')
          UNION ALL SELECT conv_id, k, 'R', r.i, r.role || ':' || text, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END
          FROM rows, (VALUES ('u', 'user'), ('a', 'assistant')) r(i, role) WHERE fault IN ('', 'truncated')),
steps AS (SELECT conv_id, k, state, next, price + 5 * length(ins) AS price, repeat('I', length(ins)) || e AS audit,
                 CASE ins WHEN 'u' THEN chr(10) || 'user:' WHEN 'a' THEN chr(10) || 'assistant:' ELSE '' END || chr(10) || line AS lines
          FROM edits JOIN moves USING (i)
          UNION ALL SELECT conv_id, k, s, s, 2, 'D', '' FROM rows, (VALUES (0), (1), (2), (3)) t(s)),
best AS (SELECT conv_id, CAST(0 AS BIGINT) AS k, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS lines FROM ids
         UNION ALL
         SELECT conv_id, k, state, cost, audit, lines FROM (
             SELECT b.conv_id, s.k, s.next AS state, b.cost + s.price AS cost, b.audit || s.audit AS audit, b.lines || s.lines AS lines,
                    row_number() OVER (PARTITION BY b.conv_id, s.next ORDER BY b.cost + s.price, b.audit || s.audit) AS r
             FROM best b JOIN steps s ON b.conv_id IS NOT DISTINCT FROM s.conv_id AND s.k = b.k + 1 AND s.state = b.state) WHERE r = 1),
ends AS (SELECT b.conv_id, cost + CASE state WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END AS cost,
                audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
                lines || CASE state WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:' WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END AS lines
         FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id WHERE b.k = coalesce(c.n, 0)),
fin AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS r FROM ends)
SELECT f.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, f.cost, f.audit, sha256(substr(lines, 2)) AS repaired_sha256
FROM fin f LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM f.conv_id WHERE f.r = 1"""

ORACLES = {"op1_substring_dedup": OP1, "op5_decontaminate": OP5, "op6_quality_rules": OP6, "op8_url_filters": _op8(),
           "op9_line_dedup": OP9, "op10_mixture": _op10(),
           "op11_lsh_forest": OP11, "op12_spelling_variants": OP12, "op13_conversation_repair": OP13}
