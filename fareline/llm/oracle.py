"""DuckDB SQL of the operators that SQL can express, written against the ``documents`` table.

Token automata become regular expressions over the words joined by single spaces, sketches become
window sums over bucket counts, and order sampling becomes one running sum per source.
"""

from __future__ import annotations

from fareline.llm import adaptive_quality as Q
from fareline.llm import license_templates as L
from fareline.llm import mixing as M

_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _phrase_places(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(words))
    return f"[i FOR i IN range(greatest(len(ws) - {len(words) - 1}, 0)) IF {same}]"


def _template_regex(markup: str) -> str:
    out = []
    for kind, value, most in L.tokens(markup):
        if kind in ("opt", "end"):
            out.append("(?:" if kind == "opt" else ")?")
        elif kind == "word":
            out.append(f" {value}")
        else:
            out.append(f"(?: (?:{value or '[^ ]+'})){{1,{most}}}")
    return "".join(out) + " "


def license_sql() -> str:
    places = ", ".join(f"{_phrase_places(p)} AS p{k}" for k, (_, p) in enumerate(L.PHRASES))
    every = " || ".join(f"p{k}" for k in range(len(L.PHRASES)))
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (label, _) in enumerate(L.PHRASES))
    extra = ", ".join(f"CASE WHEN regexp_matches(s, '{_template_regex(t)}') THEN '{label}' END" for label, t in L.TEMPLATES)
    listed = lambda x: f"array_to_string(list_sort(list_distinct(list_filter({x}, lambda y: y IS NOT NULL))), ',')"
    return f"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A_Z}', '{_A_Z.lower()}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws
    FROM documents),
p AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS s, {places} FROM w),
r AS (SELECT doc_id, len(ws) AS n, {every} AS places, [{base}] AS base, [{extra}] AS extra FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
       {listed("base")} AS base_labels, {listed("base || extra")} AS labels,
       CASE WHEN len(list_filter(extra, lambda y: y IS NOT NULL)) > 0 THEN 1.0::DOUBLE
            WHEN len(places) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM r"""


def quality_sql() -> str:
    space = r"[^\x20\x09-\x0D]"
    shares = {"symbol_share": ("n_symbols", "word_chars"), "mark_share": ("n_marks", "word_chars"), "upper_share": ("n_upper", "word_chars"),
              "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words")}
    share_sql = ", ".join(f"CASE WHEN {b} > 0 THEN CAST(floor({a} * 1000 / {b}) AS BIGINT) ELSE 0 END AS {n}" for n, (a, b) in shares.items())
    rows = " UNION ALL ".join(f"SELECT lang, source, '{n}' AS share, {n} AS v FROM c WHERE NOT base_failed" for n in shares)

    def fence(name: str, keys: str) -> str:
        part = f"PARTITION BY {keys}share" if keys else "PARTITION BY share"
        group = f"{keys}share"
        return f"""
{name} AS (
    SELECT {group}, max(total) AS total, min(lowest) FILTER (upto * 4 >= total * 1) AS low, min(lowest) FILTER (upto * 4 >= total * 3) AS high
    FROM (SELECT *, sum(n) OVER ({part} ORDER BY b) AS upto, sum(n) OVER ({part}) AS total,
                 (b - greatest(b // 32 - 1, 0) * 32) << CAST(greatest(b // 32 - 1, 0) AS INTEGER) AS lowest
          FROM (SELECT {group}, b, count(*) AS n FROM sketch GROUP BY {group}, b))
    GROUP BY {group})"""

    margins = " ".join(f"WHEN '{n}' THEN {m}" for n, m in Q.MARGINS.items())
    value = " ".join(f"WHEN '{n}' THEN c.{n}" for n in shares)
    return f"""
WITH w AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '{space}+') AS ws,
           [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{space}')] AS ls
    FROM documents),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
again AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM again) GROUP BY r),
n AS (
    SELECT w.r, doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
           coalesce(covered.n, 0) AS n_repeat_words
    FROM w LEFT JOIN covered ON covered.r = w.r),
c AS (SELECT *, {share_sql}, (n_words < {Q.LEAST_WORDS} OR 100 * n_repeat_words > {Q.MOST_REPEATED} * n_words) AS base_failed FROM n),
sketch AS (
    SELECT lang, source, share,
           (v >> CAST(greatest(length(bin(v)) - 6, 0) AS INTEGER)) + greatest(length(bin(v)) - 6, 0) * 32 AS b
    FROM ({rows})),{fence("own", "lang, source, ")},{fence("by_lang", "lang, ")},{fence("overall", "")},
fences AS (
    SELECT own.lang, own.source, own.share, CASE own.share {margins} END
           + CASE WHEN own.total >= {Q.LEAST} THEN own.high + (own.high - own.low) * {Q.SPREAD}
                  WHEN by_lang.total >= {Q.LEAST} THEN by_lang.high + (by_lang.high - by_lang.low) * {Q.SPREAD}
                  ELSE overall.high + (overall.high - overall.low) * {Q.SPREAD} END AS fence
    FROM own JOIN by_lang ON own.lang IS NOT DISTINCT FROM by_lang.lang AND own.share = by_lang.share
             JOIN overall ON own.share = overall.share),
beyond AS (
    SELECT DISTINCT c.r FROM c JOIN fences f ON c.lang IS NOT DISTINCT FROM f.lang AND c.source IS NOT DISTINCT FROM f.source
    WHERE CASE f.share {value} END > f.fence)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       (NOT base_failed AND beyond.r IS NULL) AS kept
FROM c LEFT JOIN beyond ON beyond.r = c.r"""


def mix_sql() -> str:
    weight = " ".join(f"WHEN {k} THEN {w}.0::DOUBLE" for k, w in enumerate(M.WEIGHTS))
    return f"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
           (CAST('0x' || substr(md5('{M.SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {float(1 << 52)}::DOUBLE AS u
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
           CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(M.WEIGHTS)} {weight} END AS w
    FROM d GROUP BY source),
o AS (
    SELECT *, source_size * {float(M.MOST_COPIES)}::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * {M.GROWTH}::DOUBLE AS goal FROM s),
l AS (
    SELECT *, (goal - coalesce(sum(cap) OVER before, 0.0::DOUBLE)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0.0::DOUBLE)) AS level
    FROM o WINDOW before AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT (SELECT level FROM l WHERE w * level < cap ORDER BY cap / w, source ASC NULLS LAST LIMIT 1) AS level),
t AS (SELECT source, source_size, n_docs, CASE WHEN f.level IS NULL THEN cap ELSE least(cap, f.level * w) END AS target FROM l, f),
k AS (
    SELECT d.*, source_size, target, n_docs, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS ratio
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
    SELECT *, floor(ratio) AS whole, target - floor(ratio) * source_size AS rest,
           greatest(1e-9::DOUBLE, least(1 - 1e-9::DOUBLE, ratio - floor(ratio))) AS fr
    FROM k),
ranked AS (
    SELECT *, u / (1 - u) / (fr / (1 - fr) * pow(source_size::DOUBLE / n_docs / greatest(size, 1), {M.TILT}::DOUBLE)) AS rank_by FROM q),
tied AS (SELECT source, rank_by, max(rest) AS rest, CAST(sum(size) AS DOUBLE) AS n FROM ranked GROUP BY source, rank_by),
run AS (
    SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY rank_by ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS have FROM tied),
cut AS (SELECT source, max(rank_by) AS last FROM run WHERE have < rest AND have + n - rest <= rest - have GROUP BY source)
SELECT r.doc_id, r.size, r.source_size, r.target,
       CAST((r.whole + CASE WHEN r.rank_by <= cut.last THEN 1 ELSE 0 END) * r.size AS BIGINT) AS taken
FROM ranked r LEFT JOIN cut ON r.source IS NOT DISTINCT FROM cut.source"""


def resample_sql(percent: int = 25, least: int = 20, seed: int = 7, buckets: int = 10_000) -> str:
    """Importance resampling. A CRC-32 is one running reduction over a feature's bytes, each followed by eight
    shift steps (-1)."""
    lower = f"translate(coalesce(text, ''), '{_A_Z}', '{_A_Z.lower()}')"
    words = f"regexp_extract_all({lower}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    both = "ws || [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]"
    byte = "('0x' || substr(hex(f), 2 * i + 1, 2))::BIGINT"
    step = "CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END"
    return f"""
WITH d AS (SELECT doc_id, {words} AS ws FROM documents),
docs AS (SELECT doc_id, len(ws) AS n_words, {both} AS fs FROM d),
bench AS (SELECT {both} AS fs FROM (SELECT {words} AS ws FROM benchmark)),
used AS (SELECT f, count(*) AS n FROM (SELECT unnest(fs) AS f FROM docs) GROUP BY f),
wanted AS (SELECT f, count(*) AS n FROM (SELECT unnest(fs) AS f FROM bench) GROUP BY f),
crc AS (
    SELECT f, xor(list_reduce([4294967295::BIGINT] || flatten([[{byte}, -1, -1, -1, -1, -1, -1, -1, -1] FOR i IN range(strlen(f))]),
                              lambda x, y: {step}), 4294967295) % {buckets} AS b
    FROM (SELECT f FROM used UNION SELECT f FROM wanted)),
s AS (SELECT b, sum(n)::DOUBLE AS s FROM used JOIN crc USING (f) GROUP BY b),
t AS (SELECT b, sum(n)::DOUBLE AS t FROM wanted JOIN crc USING (f) GROUP BY b),
gain AS (
    SELECT b, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + {buckets})
                              / ((s + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + {buckets})))) AS g
    FROM s LEFT JOIN t USING (b)),
each AS (SELECT f, g FROM crc JOIN gain USING (b)),
weighed AS (
    SELECT doc_id, sum(g) AS total FROM (SELECT doc_id, unnest(fs) AS f FROM docs) JOIN each USING (f) GROUP BY doc_id),
scored AS (
    SELECT doc_id, n_words, len(fs)::BIGINT AS n_features,
           CASE WHEN len(fs) > 0 THEN floor(total / len(fs))::BIGINT ELSE 0 END AS weight,
           ('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT AS h
    FROM docs LEFT JOIN weighed USING (doc_id)),
drawn AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {least} ORDER BY score DESC, doc_id) AS place FROM drawn)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {least} AND place <= {percent} * (SELECT count(*) FROM drawn WHERE n_words >= {least}) // 100 THEN place END AS rank
FROM ranked"""


def fim_sql(seed: int = 42, fim_percent: int = 50, spm_percent: int = 80) -> str:
    h = ", ".join(f"('0x' || substr(sha256('{seed}:' || doc_id), {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    return f"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS x, {h},
           regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS w
    FROM documents),
c AS (
    SELECT *, len(w)::BIGINT AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
           CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= {fim_percent} THEN 'plain'
                WHEN h4 % 100 < {spm_percent} THEN 'spm' ELSE 'psm' END AS form
    FROM t),
p AS (
    SELECT *, coalesce(array_to_string(w[1:a], ''), '') AS p, coalesce(array_to_string(w[a + 1:b], ''), '') AS m,
           coalesce(array_to_string(w[b + 1:], ''), '') AS s
    FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars, sha256(o) AS output_sha256, sha256(x) AS restored_sha256
FROM o"""


def repeats_sql(length: int = 200, block: int = 300) -> str:
    """Every string of ``length`` bytes, cut out of overlapping blocks of the texts in hex."""
    return f"""
WITH t AS (SELECT doc_id, hex(coalesce(text, '')) AS x, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
blocks AS (
    SELECT doc_id, n, place, substr(x, 2 * place + 1, 2 * ({block} + {length} - 1)) AS part
    FROM (SELECT *, unnest(range(0, n - {length} + 1, {block})) AS place FROM t WHERE n >= {length})),
strings AS (
    SELECT doc_id, place + i AS start, md5_number(substr(part, 2 * i + 1, {2 * length})) AS k
    FROM (SELECT *, unnest(range(0, least({block}, n - {length} + 1 - place))) AS i FROM blocks)),
twice AS (SELECT k FROM strings GROUP BY k HAVING count(*) > 1),
hits AS (SELECT doc_id, start, lag(start) OVER (PARTITION BY doc_id ORDER BY start) AS before FROM strings WHERE k IN (SELECT k FROM twice)),
numbered AS (
    SELECT doc_id, start, sum(CASE WHEN before IS NULL OR start > before + {length} THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY start ROWS UNBOUNDED PRECEDING) AS run
    FROM hits),
spans AS (SELECT doc_id, run, min(start) AS a, max(start) + {length} AS b FROM numbered GROUP BY doc_id, run),
gone AS (SELECT doc_id, sum(b - a)::BIGINT AS removed, count(*) AS many, list(a ORDER BY a) AS firsts, list(b ORDER BY a) AS ends FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(many, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN removed IS NULL THEN x ELSE array_to_string(
           [substr(x, 2 * CASE WHEN i = 1 THEN 0 ELSE ends[i - 1] END + 1,
                   2 * (CASE WHEN i > many THEN n ELSE firsts[i] END - CASE WHEN i = 1 THEN 0 ELSE ends[i - 1] END)) FOR i IN range(1, many + 2)], '') END)) AS kept_sha256
FROM t LEFT JOIN gone USING (doc_id)"""


ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": license_sql(),
    "op4_quality_rules": quality_sql(),
    "op7_source_mix": mix_sql(),
    "op11_importance_resampling": resample_sql(),
    "op12_fill_in_middle": fim_sql(),
    "op13_repeated_passages": repeats_sql(),
}
