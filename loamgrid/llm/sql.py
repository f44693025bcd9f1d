"""DuckDB SQL for the operators that SQL can express, over whole tables and texts."""

from __future__ import annotations

from loamgrid.llm import license_scan as L
from loamgrid.llm import quality_rules as Q
from loamgrid.llm import url_filter as U

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(texts) -> str:
    return "[" + ", ".join(map(quoted, texts)) + "]"


def quality_rules_sql(rules: Q.LineRules = Q.LineRules()) -> str:
    final = " OR ".join(f"ends_with(rtrim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), {quoted(m)})" for m in Q.FINAL)
    symbols = "length(regexp_replace({0}, '[^#*$%&|<>]', '', 'g'))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS gram
  FROM d WHERE len(w) > 2
),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, i AS k FROM r UNION SELECT doc_id, i + 1 FROM r UNION SELECT doc_id, i + 2 FROM r) GROUP BY 1),
l AS (
  SELECT doc_id, line, w, len(w) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again FROM (
    SELECT doc_id, i, line, {WORDS.format("line")} AS w FROM (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
  ) WHERE len(w) > 0
),
v AS (
  SELECT doc_id, n, again, CASE
    WHEN {symbols.format("line")} > {rules.max_symbol_share}::DOUBLE * n THEN 'punctuation'
    WHEN len(list_filter(w, lambda x: list_contains({listed(Q.MARK_RUNS)}, right(x, 2)))) > {rules.max_mark_run_share}::DOUBLE * n THEN 'punctuation'
    WHEN n <= {rules.unfinished_words} AND NOT ({final}) THEN CASE WHEN n <= {rules.nav_words} THEN 'navigation' ELSE 'punctuation' END
    WHEN len(list_filter(w, lambda x: list_contains({listed(Q.SEPARATORS)}, x))) >= {rules.nav_separators} THEN 'navigation'
    WHEN n <= {Q.BOILERPLATE_WORDS} AND regexp_matches(line, {quoted('(?i)' + Q.BOILERPLATE)}) THEN 'boilerplate'
    WHEN n >= 10 AND list_max(map_values(list_histogram(w))) > {rules.max_word_share}::DOUBLE * n THEN 'boilerplate'
    WHEN again THEN 'boilerplate' END AS bad
  FROM l
),
s AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (again) AS dup, count(*) FILTER (bad = 'punctuation') AS p, count(*) FILTER (bad = 'navigation') AS nav,
  count(*) FILTER (bad = 'boilerplate') AS b, CAST(coalesce(sum(n) FILTER (bad IS NOT NULL), 0) AS BIGINT) AS lost FROM v GROUP BY 1
),
x AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  {symbols.format("text")} AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
  coalesce(p, 0) AS n_punctuation_lines, coalesce(nav, 0) AS n_navigation_lines, coalesce(b, 0) AS n_boilerplate_lines, coalesce(lost, 0) AS lost_words
  FROM d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN rep ON rep.doc_id = d.doc_id
),
y AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM x)
SELECT *, NOT base_failed AND lost_words <= {rules.max_lost_share}::DOUBLE * n_words AS kept FROM y
"""


LINE_DEDUP_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
),
w AS (
  SELECT doc_id, i, s, row_number() OVER o AS k, lead(s, 1) OVER o AS s1, lead(s, 2) OVER o AS s2 FROM (
    SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS s FROM l
  ) WHERE s <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
r AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY s, s1, s2 ORDER BY doc_id, k) AS n FROM w WHERE s2 IS NOT NULL) WHERE n > 1),
c AS (SELECT doc_id, k FROM r UNION SELECT doc_id, k + 1 FROM r UNION SELECT doc_id, k + 2 FROM r),
m AS (
  SELECT l.doc_id, l.i, l.line, CASE WHEN w.k IS NOT NULL THEN c.k IS NOT NULL END AS gone FROM l LEFT JOIN w ON w.doc_id = l.doc_id AND w.i = l.i
  LEFT JOIN c ON c.doc_id = w.doc_id AND c.k = w.k
),
f AS (SELECT *, coalesce(last_value(gone IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS drop_it FROM m),
t AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT drop_it), '') AS text, count(*) FILTER (gone) AS n FROM f GROUP BY 1)
SELECT doc_id, md5(text) AS text_md5, CAST(strlen(text) AS BIGINT) AS text_bytes, n AS n_removed_lines FROM t
"""


def license_scan_sql() -> str:
    known, rules = L.known_table(), L.expanded_rules()
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    normal = f"trim(regexp_replace(translate(s, '{upper}', '{lower}'), '[^a-z0-9]+', ' ', 'g'), ' ')"
    normal = f"regexp_replace({normal}, '{L.HOLDER}', '{L.HOLDER_FORM}')"
    keys, names = listed(known), listed(known.values())
    ids = (
        "list_filter(list_transform(string_split_regex(text, {0}), lambda s: " + names + f"[list_position({keys}, {normal})]), lambda x: x IS NOT NULL)"
    )
    escape = lambda p: quoted(p)

    def holds(name: str, rule: str) -> str:
        longer = [r for n, r in rules if r != rule and f" {rule} " in f" {r} " and L.CONTAINING.get(n, n) == L.CONTAINING.get(name, name)]
        return " AND ".join([f"contains(row, ' {rule} ')", *[f"NOT contains(row, ' {r} ')" for r in longer]])

    pick = lambda value: ", ".join(f"CASE WHEN {holds(n, r)} THEN {quoted(value(n, r))} END" for n, r in rules)
    joined = "array_to_string(list_sort(list_distinct(list_filter([{0}], lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
i AS (
  SELECT doc_id, CASE WHEN may THEN {ids.format(escape(L.END))} ELSE [] END AS a, CASE WHEN may THEN {ids.format(escape(L.LINE_END))} ELSE [] END AS b
  FROM (SELECT *, regexp_matches(text, {quoted(L.ANCHOR)}) AS may FROM d)
),
j AS (SELECT doc_id, CASE WHEN len(b) > len(a) THEN b ELSE a END AS ids FROM i),
k AS (SELECT doc_id, ids, ' ' || array_to_string(ids, ' ') || ' ' AS row FROM j)
SELECT doc_id, {joined.format(pick(lambda n, r: n))} AS licenses, array_to_string(ids, ' ') AS sentence_ids,
{joined.format(pick(lambda n, r: r.replace(' ', '+')))} AS rules, CAST(len(ids) AS BIGINT) AS n_known FROM k
"""


def url_filter_sql(rules: tuple[U.Rule, ...] = U.RULES, damping: float = 0.85, rounds: int = 200, most: float = 0.5) -> str:
    """Both walks by recursion; after 200 rounds less than 1e-14 of their mass still moves."""

    def fitting(value) -> str:
        cases = [
            f"WHEN (host = {quoted(r.host)} OR ends_with(host, {quoted('.' + r.host)})) AND starts_with(path, {quoted(r.path)}) THEN {quoted(value(r))}"
            for r in sorted(rules, key=lambda r: -len(r.name))
        ]
        return f"CASE {' '.join(cases)} END"

    wide = ", ".join(quoted(r.name) for r in rules if r.verdict == "block" and r.path == "/")
    lower = f"translate({{0}}, '{U.UPPER}', '{U.LOWER}')"
    return f"""
WITH RECURSIVE r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, {lower.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, html FROM r),
j AS (SELECT page_id, host, path, html, {fitting(lambda r: r.name)} AS rule, {fitting(lambda r: r.verdict)} AS ruled FROM h),
m AS (SELECT host, count(*) FILTER (ruled = 'allow') AS good, count(*) FILTER (rule IN ({wide})) AS bad FROM j GROUP BY 1),
z AS (SELECT greatest(sum(good), 1) AS good, greatest(sum(bad), 1) AS bad FROM m),
seeds AS MATERIALIZED (SELECT host, m.good::DOUBLE / z.good AS trust, m.bad::DOUBLE / z.bad AS distrust FROM m, z WHERE m.good > 0 OR m.bad > 0),
l AS (SELECT DISTINCT page_id, host AS src, {lower.format("unnest(regexp_extract_all(html, " + quoted(U.LINK) + ", 1))")} AS dst FROM h),
e AS (SELECT src, dst, count(*)::DOUBLE AS w FROM l WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY 1, 2),
steps AS MATERIALIZED (
  SELECT src AS a, dst AS b, w / sum(w) OVER (PARTITION BY src) AS t, 0.0::DOUBLE AS d FROM e UNION ALL
  SELECT dst, src, 0.0::DOUBLE, w / sum(w) OVER (PARTITION BY dst) FROM e
),
w AS (
  SELECT 0 AS k, host, trust, distrust FROM seeds WHERE EXISTS (SELECT 1 FROM steps)
  UNION ALL
  SELECT k, host, sum(t), sum(d) FROM (
    SELECT w.k + 1 AS k, x.b AS host, {damping}::DOUBLE * w.trust * x.t AS t, {damping}::DOUBLE * w.distrust * x.d AS d FROM steps x JOIN w ON w.host = x.a
    UNION ALL SELECT n.k + 1, s.host, {1 - damping}::DOUBLE * s.trust, {1 - damping}::DOUBLE * s.distrust FROM seeds s, (SELECT DISTINCT k FROM w) n
  ) WHERE k <= {rounds} GROUP BY 1, 2
),
f AS (SELECT host, trust, distrust FROM w WHERE k = {rounds} UNION ALL SELECT * FROM seeds WHERE NOT EXISTS (SELECT 1 FROM steps)),
g AS (SELECT CASE WHEN sum(trust) > 0 THEN sum(trust) ELSE 1 END AS t, CASE WHEN sum(distrust) > 0 THEN sum(distrust) ELSE 1 END AS d FROM f),
v AS (SELECT host, trust / g.t AS trust, distrust / g.d AS distrust FROM f, g)
SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN distrust > {most}::DOUBLE * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN v ON v.host = j.host
"""
