"""The SQL that says what the operators' queries give, where SQL can say it over whole tables."""

from __future__ import annotations

import unicodedata

from corpusloom.llm.mixing import SEED
from corpusloom.llm.quality import BREAKS, BULLETS, CLOSE, COMMON, STOPS


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def normal(column: str) -> str:
    """Words' normal form: DuckDB composes (NFC) only, so the compatibility forms of these blocks are replaced first."""
    one, more = {}, {}
    for i in (*range(0xA0, 0x100), *range(0x2000, 0x2150), 0x3000, *range(0xFF01, 0xFF5F)):
        to = unicodedata.normalize("NFKC", chr(i))
        if to != unicodedata.normalize("NFC", chr(i)):
            (one if len(to) == 1 else more)[chr(i)] = to
    out = f"translate({column}, {_quoted(''.join(one))}, {_quoted(''.join(one.values()))})"
    for k, v in more.items():
        out = f"replace({out}, {_quoted(k)}, {_quoted(v)})"
    return f"lower(regexp_replace(nfc_normalize({out}), '\\p{{Cf}}', '', 'g'))"


def words(column: str) -> str:
    return f"regexp_extract_all({normal(column)}, '[\\p{{L}}\\p{{N}}]+')"


_PAIRS = f"""r AS (SELECT rec_id, ws FROM (SELECT DISTINCT rec_id, {words("instruction")} AS ws FROM json_rows WHERE rec_id IS NOT NULL AND instruction IS NOT NULL) WHERE len(ws) >= 20),
t AS (SELECT ws, min(rec_id) AS c FROM r GROUP BY ws),
sh AS (SELECT DISTINCT c, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s FROM (SELECT c, ws, unnest(range(1, len(ws) - 1)) AS i FROM t)),
n AS (SELECT c, count(*) AS n FROM sh GROUP BY c),
sim AS (SELECT a, b FROM (SELECT x.c AS a, y.c AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.c < y.c GROUP BY x.c, y.c) JOIN n p ON p.c = a JOIN n q ON q.c = b WHERE 3 * k >= p.n + q.n),
m AS (SELECT rec_id, c FROM r JOIN t USING (ws))"""
_LINKED = f"{_PAIRS}, both_ AS (SELECT a, b FROM sim UNION ALL SELECT b, a FROM sim)"


def _windows(column: str) -> str:
    return f"SELECT DISTINCT rec_id, array_to_string(ws[i:i + 15], ' ') AS x FROM (SELECT rec_id, ws, unnest(range(1, len(ws) - 14)) AS i FROM (SELECT rec_id, {words(column)} AS ws FROM json_rows))"


_SPACE = "\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}"


def _class(codes) -> str:
    return "".join(f"\\x{{{int(i):x}}}" for i in codes)


_MEASURES = f"""t AS (SELECT doc_id, {normal("text")} AS x FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, x, regexp_extract_all(x, '[\\p{{L}}\\p{{N}}]+') AS w, list_filter(string_split_regex(x, '[{_class(b for b in BREAKS if b)}]'), lambda l: regexp_matches(l, '[^{_SPACE}]')) AS l FROM t WHERE regexp_matches(x, '[^{_SPACE}]')),
v AS (SELECT *, list_filter(w, lambda y: length(y) >= 2 AND regexp_matches(y, '^\\p{{L}}')) AS real FROM u),
c AS (SELECT doc_id, CAST(len(w) AS INTEGER) AS words, CAST(coalesce(list_sum(list_transform(w, lambda y: length(y))), 0) AS BIGINT) / greatest(len(w), 1) AS mean_word_length,
length(regexp_replace(x, '[\\p{{L}}\\p{{N}}{_SPACE}]', '', 'g')) / greatest(len(w), 1) AS symbol_ratio,
len(list_filter(l, lambda y: regexp_matches(y, '[{_class(STOPS)}][{_SPACE}{_class(CLOSE)}]*$'))) / greatest(len(l), 1) AS punctuated_lines,
len(list_filter(l, lambda y: regexp_matches(y, '^[{_SPACE}]*([{_class(map(ord, BULLETS))}]|[0-9][.)0-9])'))) / greatest(len(l), 1) AS bullet_lines,
len(list_filter(real, lambda y: list_contains({list(dict.fromkeys(COMMON))}, y))) AS usual, len(real) AS real_n, len(list_filter(w, lambda y: regexp_matches(y, '\\p{{L}}'))) AS lettered FROM v)"""
_FAILS = "array_to_string(list_filter([CASE WHEN mean_word_length < 3 OR mean_word_length > 10 THEN 'mean_word_length' END, CASE WHEN symbol_ratio > 0.1 THEN 'symbol_ratio' END, CASE WHEN lettered < 0.8 * words THEN 'few_letters' END, CASE WHEN usual < 2 THEN 'few_common_words' END, CASE WHEN bullet_lines > 0.9 THEN 'bullet_lines' END, CASE WHEN punctuated_lines <= 0.12 THEN 'unpunctuated_lines' END], lambda z: z IS NOT NULL), ',')"

_DRAWN = f"""latest AS (SELECT task, row_id, resp_len FROM (SELECT *, row_number() OVER (PARTITION BY task, row_id ORDER BY indexed_at DESC NULLS LAST, resp_len DESC NULLS LAST) AS rn FROM task_indices WHERE task IS NOT NULL AND row_id IS NOT NULL) WHERE rn = 1),
r AS (SELECT task, row_id, resp_len, string_split(task, '__')[1] AS source FROM latest WHERE resp_len >= 0),
share AS (SELECT source, coalesce(max(target_share), 0) AS target_share FROM mix_targets WHERE source IS NOT NULL GROUP BY source),
rule AS (SELECT task, max_per_file, coalesce(repeat, 1) AS repeat FROM (SELECT t.task, p.max_per_file, p.repeat, row_number() OVER (PARTITION BY t.task ORDER BY p.ord) AS rn FROM (SELECT DISTINCT task FROM r) t LEFT JOIN (SELECT * FROM prefix_config WHERE prefix IS NOT NULL) p ON starts_with(t.task, p.prefix)) WHERE rn = 1),
d AS (SELECT source, task, row_id, resp_len, max_per_file AS cap, CAST(unnest(range(repeat)) AS INTEGER) AS pass FROM r JOIN share USING (source) JOIN rule USING (task)),
h AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|', '{SEED}', task, CAST(row_id AS VARCHAR), CAST(pass AS VARCHAR))), 1, 15) AS BIGINT) AS h FROM d),
k AS (SELECT * FROM h QUALIFY cap IS NULL OR row_number() OVER (PARTITION BY task, pass ORDER BY h, row_id) <= cap),
supply AS (SELECT source, sum(resp_len) AS s FROM k GROUP BY source),
w AS (SELECT least((SELECT CAST(sum(resp_len) AS DOUBLE) FROM r), min(CAST(s AS DOUBLE) / target_share)) AS whole FROM supply JOIN share USING (source) WHERE s > 0 AND target_share > 0),
run AS (SELECT k.*, CAST(sum(resp_len) OVER (PARTITION BY source ORDER BY pass, h, task, row_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS upto, target_share * whole AS budget FROM k JOIN share USING (source), w),
drawn AS (SELECT source, task, row_id, pass, resp_len FROM run WHERE upto <= budget OR (upto - resp_len <= budget AND upto - budget < budget - (upto - resp_len)))"""

SQL = {
    "p1_found": f"WITH {_PAIRS} SELECT least(x.rec_id, y.rec_id) AS rec_id_a, greatest(x.rec_id, y.rec_id) AS rec_id_b FROM sim JOIN m x ON x.c = a JOIN m y ON y.c = b UNION SELECT x.rec_id, y.rec_id FROM m x JOIN m y ON x.c = y.c AND x.rec_id < y.rec_id",
    "p1_classes": f"WITH {_LINKED}, k AS (SELECT a AS c, count(*) AS links FROM both_ GROUP BY a) SELECT j.rec_id, coalesce(m.c, j.rec_id) AS class_id, CAST(coalesce(links, 0) AS BIGINT) AS links FROM (SELECT DISTINCT rec_id FROM json_rows WHERE rec_id IS NOT NULL) j LEFT JOIN m USING (rec_id) LEFT JOIN k ON k.c = m.c",
    "p1_links": f"WITH {_PAIRS} SELECT a AS class_a, b AS class_b FROM sim",
    "p1_groups": f"WITH RECURSIVE {_LINKED}, reach(a, b) AS (SELECT a, b FROM both_ UNION SELECT reach.a, both_.b FROM reach JOIN both_ ON reach.b = both_.a), g AS (SELECT a AS c, min(b) AS low FROM reach GROUP BY a) "
    "SELECT j.rec_id, coalesce(least(m.c, g.low), j.rec_id) AS group_id FROM (SELECT DISTINCT rec_id FROM json_rows WHERE rec_id IS NOT NULL) j LEFT JOIN m USING (rec_id) LEFT JOIN g ON g.c = m.c",
    "p2_found": f"WITH q AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 15], ' ') AS x FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 14)) AS i FROM (SELECT item_id, {words('question')} AS ws FROM eval_items))), t AS ({_windows('instruction')} UNION ALL {_windows('response')}) SELECT DISTINCT rec_id, item_id FROM t JOIN q USING (x) WHERE rec_id IS NOT NULL AND item_id IS NOT NULL",
    "p6_texts": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p7_checks": "SELECT count(*) AS texts, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS needless_parts, CAST(0 AS BIGINT) AS wrong_starts FROM documents",
    "p8_measures": f"WITH {_MEASURES} SELECT doc_id, words, mean_word_length, symbol_ratio, punctuated_lines, bullet_lines, usual / greatest(real_n, 1) AS common_words, {_FAILS} AS fails FROM c",
    "p4_draws": f"WITH {_DRAWN} SELECT * FROM drawn",
    "p4_shares": f"WITH {_DRAWN}, b AS (SELECT source, CAST(sum(resp_len) AS BIGINT) AS tokens, CAST(count(*) AS BIGINT) AS draws, CAST(count(DISTINCT (task, row_id)) AS BIGINT) AS rows FROM drawn GROUP BY source), "
    "x AS (SELECT source, target_share, coalesce(tokens, 0) AS tokens, coalesce(draws, 0) AS draws, coalesce(rows, 0) AS rows FROM share LEFT JOIN b USING (source)) "
    "SELECT *, CASE WHEN sum(tokens) OVER () > 0 THEN CAST(tokens AS DOUBLE) / CAST(sum(tokens) OVER () AS DOUBLE) END AS actual_share, CASE WHEN (SELECT sum(resp_len) FROM r) > 0 THEN CAST(tokens AS DOUBLE) / CAST((SELECT sum(resp_len) FROM r) AS DOUBLE) END AS all_share FROM x",
}
