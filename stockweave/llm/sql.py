"""SQL twins for DuckDB of the corpus operators that SQL can state."""

from __future__ import annotations

from stockweave.llm.decontaminate import WINDOW
from stockweave.llm.importance import ImportanceParams, crc_table
from stockweave.llm.licenses import TEMPLATES
from stockweave.llm.secrets import BASE_KINDS, RULES
from stockweave.llm.sentences import STOPS, SentenceParams
from stockweave.llm.spelling import SpellingParams


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str) -> str:
    """Words: A-Z lower-cased, any ASCII but letters and digits parts them."""
    return f"regexp_extract_all({lower(text)}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


ROWS = "rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents)"


def crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text, byte by byte."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    step = f"xor(c >> 8, {crc_table().tolist()}[(xor(c, b) & 255) + 1])"
    ones = "4294967295::BIGINT"
    return f"xor(list_reduce(list_transform(range(strlen({text})), lambda i: {byte}), lambda c, b: {step}, {ones}), {ones})"


def license_sql(templates: dict[str, str] = TEMPLATES, threshold: float = 0.8) -> str:
    values = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in sorted(templates.items()))
    grams = "unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g"
    return f"""
WITH {ROWS},
split AS (SELECT r, text, string_split(text, chr(10)) AS lines FROM rows),
units AS (
  SELECT r, unnest(range(len(lines))) AS u, unnest(lines) AS t FROM split
  UNION ALL SELECT r, -1, text FROM split WHERE len(lines) > 1),
unit_words AS (SELECT r, u, {words('t')} AS w FROM units),
unit_grams AS (
  SELECT r, u, a, g, count(*) AS n FROM (SELECT r, u, len(w) - 1 AS a, {grams} FROM unit_words WHERE len(w) > 1)
  GROUP BY ALL),
template_words AS (SELECT name, {words('t')} AS w FROM (VALUES {values}) v(name, t)),
template_grams AS (
  SELECT name, b, g, count(*) AS n FROM (SELECT name, len(w) - 1 AS b, {grams} FROM template_words) GROUP BY ALL),
scored AS (
  SELECT r, u, name, 2 * sum(least(x.n, y.n))::DOUBLE / (any_value(a) + any_value(b)) AS dice
  FROM unit_grams x JOIN template_grams y USING (g) GROUP BY r, u, name),
hits AS (SELECT * FROM scored WHERE dice >= {threshold}),
best AS (
  SELECT r, count(DISTINCT u) AS n_units, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
    max(dice) AS best_dice FROM hits GROUP BY r),
named AS (
  SELECT b.r, min(h.name) AS best_license FROM best b JOIN hits h ON h.r = b.r AND h.dice = b.best_dice GROUP BY b.r)
SELECT doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(licenses, '') AS licenses, best_license, best_dice
FROM rows LEFT JOIN best USING (r) LEFT JOIN named USING (r)"""


def contamination_sql(window: int = WINDOW) -> str:
    return f"""
WITH {ROWS},
doc_words AS (SELECT r, doc_id, {words('text')} AS w FROM rows),
items AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {words("coalesce(text, '')")} AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item, m, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT item, w, least({window}, len(w)) AS m, unnest(range(1, len(w) - least({window}, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
windows AS (
  SELECT r, i, m, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM doc_words, (SELECT DISTINCT m FROM patterns) WHERE len(w) >= m)),
hits AS (SELECT r, i, m, item FROM windows JOIN patterns USING (m, g)),
covered AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""


def secret_sql() -> str:
    """Matches and the texts between them give the places."""
    kinds = []
    for order, rule in enumerate(RULES):
        flag = "(?i)" if rule.fold else ""
        pattern = quoted(flag + rule.pattern)
        head = quoted(flag + "^" + rule.head) if rule.head else None
        length = f"length(m) - length(regexp_extract(m, {head}))" if head else "length(m)"
        kinds.append(f"""
  SELECT r, {order} AS kind, '{rule.kind}' AS name, s, s + length(m) AS e FROM (
    SELECT r, m[i] AS m, list_sum(list_transform(p[1 : i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(text, {pattern}) AS m, regexp_split_to_array(text, {pattern}) AS p FROM rows)))
  WHERE {length} >= {rule.least}""")
    base = ", ".join(f"'{k}'" for k in BASE_KINDS)
    counts = ", ".join(f"count(*) FILTER (WHERE name = '{k}') AS n_{k}" for k in BASE_KINDS)
    text = "string_agg(name || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, kind)"
    return f"""
WITH {ROWS},
spans AS ({' UNION ALL '.join(kinds)}),
sums AS (SELECT r, {counts}, {text} FILTER (WHERE name IN ({base})) AS base, {text} AS spans FROM spans GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in BASE_KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows LEFT JOIN sums USING (r)"""


def sentence_sql(params: SentenceParams = SentenceParams()) -> str:
    blank = "\\t\\n\\r\\x0b\\x0c "
    ends = f"(?:[.!?]+[ \\t\\r\\n]+|[{STOPS}]+[ \\t\\r\\n]*|\\n[ \\t\\r\\n]*|$)"
    key = f"array_to_string(list_filter(string_split_regex({lower('p')}, '[{blank}]+'), lambda x: x <> ''), ' ')"
    return f"""
WITH {ROWS},
whole AS (
  SELECT r, doc_id, i, p, regexp_extract_all(p, '[{blank}]*[^{blank}]+[{blank}]*') AS t
  FROM (SELECT r, doc_id, unnest(range(1, len(ps) + 1)) AS i, unnest(ps) AS p FROM (
    SELECT r, doc_id, list_filter(regexp_extract_all(text, '(?s).*?{ends}'), lambda x: x <> '') AS ps FROM rows))),
tokens AS (
  SELECT r, doc_id, i, unnest(range(1, len(t) + 1)) AS j, unnest(t) AS t FROM whole WHERE len(t) > {params.longest}),
hashes AS (SELECT w, {crc32('w')} % {params.cut_modulus} = 0 AS cut FROM (SELECT DISTINCT {lower(f"regexp_extract(t, '[^{blank}]+')")} AS w FROM tokens)),
segments AS (
  SELECT r, doc_id, i, j, t, coalesce(sum(cut::INTEGER) OVER (PARTITION BY r, i ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM tokens JOIN hashes ON w = {lower(f"regexp_extract(t, '[^{blank}]+')")}),
chunks AS (
  SELECT *, (row_number() OVER (PARTITION BY r, i, seg ORDER BY j) - 1) // {params.longest} AS c FROM segments),
parts AS (
  SELECT r, doc_id, i, 0 AS j, p FROM whole WHERE len(t) <= {params.longest}
  UNION ALL SELECT r, doc_id, i, min(j), string_agg(t, '' ORDER BY j) FROM chunks GROUP BY r, doc_id, i, seg, c),
joined AS (
  SELECT r, doc_id, row_number() OVER (PARTITION BY r ORDER BY i, j) AS i, p, {key} AS k FROM parts),
sized AS (
  SELECT *, CASE WHEN k = '' THEN 0 ELSE len(string_split(k, ' ')) END AS n FROM joined),
summed AS (SELECT *, sum(n) OVER (PARTITION BY r ORDER BY i) AS upto FROM sized),
docs AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS m, sum(n) AS n, list(k ORDER BY i) AS ks FROM sized GROUP BY r),
reached AS (SELECT r, upto, min(i) AS i FROM summed GROUP BY r, upto),
ends AS (
  SELECT s.r, s.i, greatest(e.i, s.i + {params.run - 1}) AS last
  FROM (SELECT r, i, upto - n + {params.least_words} AS wanted FROM summed) s
  ASOF JOIN reached e ON s.r = e.r AND s.wanted <= e.upto),
runs AS (
  SELECT r, doc_id, i, last, array_to_string(ks[i : last], chr(10)) AS run FROM ends JOIN docs USING (r)
  WHERE last <= m AND m >= {params.run} AND n >= {params.least_words}
  UNION ALL SELECT r, doc_id, 1, m, array_to_string(ks, chr(10)) FROM docs
  WHERE n > 0 AND (m < {params.run} OR n < {params.least_words})),
later AS (
  SELECT r, i, last FROM (
    SELECT r, i, last, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS LAST, r, i) AS place FROM runs)
  WHERE place > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, last + 1)) AS i FROM later),
kept AS (
  SELECT j.r, count(*) AS n_sentences, count(g.i) AS n_removed, coalesce(string_agg(p, '' ORDER BY j.i) FILTER (WHERE g.i IS NULL), '') AS t
  FROM joined j LEFT JOIN gone g ON g.r = j.r AND g.i = j.i GROUP BY j.r),
spans AS (SELECT r, count(*) AS n_spans FROM later GROUP BY r)
SELECT doc_id, coalesce(n_sentences, 0)::BIGINT AS n_sentences, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(coalesce(t, '')) AS kept_sha256
FROM rows LEFT JOIN kept USING (r) LEFT JOIN spans USING (r)"""


def importance_sql(params: ImportanceParams = ImportanceParams()) -> str:
    sizes = range(1, params.longest + 1)

    def runs(rows: str) -> str:
        return " UNION ALL ".join(
            f"SELECT r, array_to_string(w[i : i + {k - 1}], ' ') AS g FROM "
            f"(SELECT r, w, unnest(range(1, len(w) - {k - 2})) AS i FROM {rows} WHERE len(w) >= {k})"
            for k in sizes
        )

    h = f"('0x' || sha256('{params.seed}:' || coalesce(doc_id::VARCHAR, ''))[1 : 8])::BIGINT"
    return f"""
WITH {ROWS},
doc_words AS (SELECT r, doc_id, {words('text')} AS w FROM rows),
item_words AS (SELECT 0 AS r, {words("coalesce(text, '')")} AS w FROM benchmark),
doc_runs AS (SELECT r, g, count(*) AS n FROM ({runs('doc_words')}) GROUP BY ALL),
item_runs AS (SELECT g, count(*) AS n FROM ({runs('item_words')}) GROUP BY ALL),
hashed AS (
  SELECT g, {crc32('g')} % {params.buckets} AS b FROM (SELECT g FROM doc_runs UNION SELECT g FROM item_runs)),
s AS (SELECT b, sum(n)::BIGINT AS s FROM doc_runs JOIN hashed USING (g) GROUP BY b),
t AS (SELECT b, sum(n)::BIGINT AS t FROM item_runs JOIN hashed USING (g) GROUP BY b),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS t_all),
gains AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {params.buckets})
    / ((s + 1)::DOUBLE * (t_all + {params.buckets}))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (b), sums),
weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM doc_runs JOIN hashed USING (g) JOIN gains USING (b) GROUP BY r),
scored AS (
  SELECT doc_id, len(w) >= {params.least_words} AS eligible, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln(({h} + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (r)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST) AS p,
    count(*) OVER (PARTITION BY eligible) AS of FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN eligible AND p <= {params.percent} * of // 100 THEN p END AS rank FROM placed"""


def spelling_sql(params: SpellingParams = SpellingParams()) -> str:
    """Near words by deletion: of equal lengths equal without one place, else one is the other without one."""
    without = "run[1 : h % length(run)] || run[h % length(run) + 2 :]"
    return f"""
WITH RECURSIVE {ROWS},
runs AS (
  SELECT d, run, count(*) AS k FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all({lower('text')}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM rows) GROUP BY ALL),
hashed AS (SELECT run, k, {crc32("(d || ':' || run)")} AS h FROM runs),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (SELECT k, CASE WHEN h % 31 = 0 THEN {without} ELSE run END AS word FROM hashed)
  WHERE length(word) >= {params.least_letters} GROUP BY word HAVING sum(k) >= {params.least_count}),
cut AS (
  SELECT word, length(word) AS l, i, word[1 : i - 1] || word[i + 1 :] AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT p.word, count(*) AS n_near, arg_min(w.word, (-w.n, w.word)) AS near, max(w.n) AS near_n
  FROM pairs p JOIN words w ON w.word = p.near GROUP BY p.word),
formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= {params.ratio} * n THEN near END AS form,
    CASE WHEN near_n >= {params.ratio} * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form AS onward FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.onward)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word) WHERE onward IS NULL"""
