"""DuckDB SQL for the queries that SQL can express."""

# The extra rules are those of quality_rules.EXTRA_RULES.
OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> '') AS words FROM d
), words AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), per_line AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^ \t-\r]') GROUP BY r
), windows AS (
  SELECT r, i, word AS a, lead(word) OVER s AS b, lead(word, 2) OVER s AS c FROM words WINDOW s AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows WHERE c IS NOT NULL
), covered AS (
  SELECT r, count(DISTINCT i + s) AS n_repeat_words FROM again, (SELECT unnest([0, 1, 2]) AS s) WHERE n > 1 GROUP BY r
), per_word AS (
  SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
    sum(length(regexp_replace(word, '[^#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    count(*) FILTER (regexp_matches(word, '\p{Lu}[^\p{L}]*\p{Lu}') AND NOT regexp_matches(word, '\p{Ll}')) AS n_shouted,
    count(*) FILTER (regexp_matches(word, '\p{L}')) AS n_lettered
  FROM words GROUP BY r
), counts AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_symbols, 0) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_shouted, 0) AS n_shouted, coalesce(n_lettered, 0) AS n_lettered
  FROM d LEFT JOIN per_word USING (r) LEFT JOIN per_line USING (r) LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 20 * n_words OR 100 * n_shouted > 30 * n_words OR 100 * n_lettered < 60 * n_words
    OR word_chars > 25 * n_words OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)) AS kept
FROM judged
"""

# Counts are widened so that all arithmetic is exact.
OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3
), sizes AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), counted AS (
  SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM d
), totals AS (
  SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM groups LEFT JOIN counted USING (lang, source) GROUP BY ALL
), p AS (
  SELECT lang, source, term, coalesce(c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c, 0) + 1) // (n + v) AS p
  FROM totals JOIN sizes USING (lang) JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)
), q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(c) + 1)::HUGEINT // (sum(sum(c)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q
  FROM p GROUP BY lang, term
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN summed AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (FROM pairs UNION ALL FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

STATEMENTS = {"op6_quality_cascade": OP6, "op11_divergence_audit": OP11}


def _license_sql() -> str:
    """The scan with word pairs joined as strings and every diagonal, span, edit distance and overlap in plain SQL."""
    from tradewind.llm.license_scan import BASE, NEAR, NOTICES, TELLING, budget, code

    values = []
    for i, (label, phrase) in enumerate((*BASE, *NOTICES)):
        words, base = phrase.split(), i < len(BASE)
        edits = 0 if base else budget(len(words))
        plain = sum(not (x.isdecimal() and y.isdecimal()) for x, y in zip(words, words[1:], strict=False))
        least = len(words) - 1 if base else max(1, plain - 2 * edits)
        values.append(f"({i}, '{label}', {str(base).lower()}, {words}, '{code(words)}', {[w for w in words if w in TELLING]}::VARCHAR[], {edits}, {least})")
    tried = " UNION ALL ".join(
        f"SELECT r, template, diagonal, {n} AS near, sum(votes) OVER s AS votes, min(low) OVER s AS start, max(high) OVER s + 1 AS stop FROM diagonals "
        f"WINDOW s AS (PARTITION BY r, template ORDER BY diagonal RANGE BETWEEN {n} PRECEDING AND {n} FOLLOWING)"
        for n in NEAR
    )
    return rf"""
WITH t(template, label, base, words, code, telling, edits, least) AS (
  VALUES {", ".join(values)}
), tw AS (
  SELECT template, unnest(words) AS x, generate_subscripts(words, 1) - 1 AS j FROM t
), tg AS (
  SELECT template, j, CASE WHEN regexp_full_match(x, '[0-9]+') THEN '#' ELSE x END AS a FROM tw
), known AS (
  SELECT * FROM (SELECT template, j, a, lead(a) OVER (PARTITION BY template ORDER BY j) AS b FROM tg) WHERE b IS NOT NULL AND (a <> '#' OR b <> '#')
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), p AS (
  SELECT r, i, CASE WHEN regexp_full_match(x, '[0-9]+') THEN '#' ELSE x END AS a FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d)
), pairs AS (
  SELECT r, i, a, lead(a) OVER (PARTITION BY r ORDER BY i) AS b FROM p
), diagonals AS (
  SELECT r, template, i - j AS diagonal, count(*) AS votes, min(i) AS low, max(i) AS high FROM pairs JOIN known USING (a, b) GROUP BY ALL
), tried AS (
  {tried}
), enough AS (
  SELECT DISTINCT r, template, diagonal, votes, start, stop FROM tried JOIN t USING (template) WHERE votes >= least AND (near = 0 OR NOT base)
), further AS (
  SELECT r, template, diagonal, start, stop FROM enough
  UNION ALL SELECT r, template, diagonal, start, stop + 1 FROM enough JOIN t USING (template) WHERE code LIKE '%##'
), spans AS (
  SELECT r, label, base, words, code, edits, telling, start, stop, w[start + 1:stop + 1] AS inside FROM further JOIN t USING (template) JOIN d USING (r)
), coded AS (
  SELECT *, len(words) AS n,
    array_to_string(list_transform(inside, lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') THEN '#' WHEN list_position(words, x) > 0 THEN chr((64 + list_position(words, x))::INT) ELSE '~' END), '') AS own,
    list_filter(inside, lambda x: list_contains({TELLING}, x)) = telling AS alike
  FROM spans
), judged AS (
  SELECT *, levenshtein(own, code) AS off FROM coded WHERE alike
), held AS (
  SELECT *, (n - off)::DOUBLE / n AS share FROM judged WHERE off <= edits AND off < n
), found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    coalesce(list_sort(list_distinct(list(label) FILTER (base))), []) AS bases,
    list_sort(list_distinct(list({{'rank': off - n, 'off': off, 'start': start, 'stop': stop + 1, 'label': label}}) FILTER (NOT base))) AS every, max(share) AS score
  FROM held GROUP BY r
), best AS (
  SELECT *, CASE WHEN len(every) > 0 THEN list_reduce(list_transform(every, lambda s: [s]), lambda kept, s:
      CASE WHEN len(list_filter(kept, lambda k: k.start < s[1].stop AND s[1].start < k.stop)) = 0 THEN list_concat(kept, s) ELSE kept END) END AS chosen
  FROM found
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(bases, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(bases, coalesce(list_transform(chosen, lambda s: s.label), [])))), ','), '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN best USING (r)
"""


STATEMENTS["op8_license_scan"] = _license_sql()
