"""SQL twins of the queries that SQL can express."""

from .personal import AFTER, BEFORE, DOUBT, KINDS
from .quality import STOP_WORDS

_SPACES = r"[\x20\x09-\x0D]+"

# Measures of op4 as common table expressions, ending with `judged`.
QUALITY = rf"""
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text,
    list_filter(regexp_split_to_array(text, '{_SPACES}'), lambda w: w <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda l: NOT regexp_full_match(l, '[\x20\x09-\x0D]*')) AS ls
  FROM texts),
windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM split WHERE len(ws) >= 8),
counted AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 7]) AS n FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM counted WHERE n > 1) GROUP BY doc_id),
measures AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(ws, lambda w: lower(w) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS BIGINT)
      AS n_stop_words
  FROM split LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
      OR word_chars / n_words < 2 OR word_chars / n_words > 20 OR n_symbols / n_words > 0.1
      OR n_stop_words / n_words < 0.02 OR coalesce(n_dup_lines / nullif(n_lines, 0) > 0.6, FALSE)) AS kept
  FROM measures)
"""

# Of op12: what confirms a match v of each kind, and what it then is, if not itself.
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = """list_sum(list_transform(range(1, len(d) + 1), lambda i:
  CASE WHEN i % 2 = 1 THEN CAST(reverse(d)[i] AS INTEGER)
       ELSE CAST(reverse(d)[i] AS INTEGER) * 2 - 9 * CAST(CAST(reverse(d)[i] AS INTEGER) > 4 AS INTEGER) END)) % 10 = 0"""


def _iban(value: str) -> str:
    turned = f"substr(replace({value}, ' ', ''), 5) || left(replace({value}, ' ', ''), 4)"
    numbers = f"list_transform(string_split({turned}, ''), lambda c: ascii(c) - CASE WHEN c <= '9' THEN 48 ELSE 55 END)"
    return f"""(len(replace({value}, ' ', '')) BETWEEN 15 AND 34 AND
      list_reduce(list_prepend(0, {numbers}), lambda t, x: (t * CASE WHEN x < 10 THEN 10 ELSE 100 END + x) % 97) = 1)"""


_SHORTER = r"regexp_replace(v, '\x20[A-Z0-9]{1,4}$', '')"
_CONFIRMED = {
    "email": "v",
    "ip": "CASE WHEN len(list_filter(string_split(v, '.'), lambda x: CAST(x AS HUGEINT) > 255)) = 0 THEN v END",
    "card": f"CASE WHEN len(d) BETWEEN 12 AND 19 AND {_LUHN} THEN v END",
    "phone": "CASE WHEN len(d) BETWEEN 9 AND 15 THEN v END",
    "iban": f"CASE WHEN {_iban('v')} THEN v WHEN {_iban(_SHORTER)} THEN {_SHORTER} END",
    "ssn": "CASE WHEN NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$') AND near THEN v END",
    "birth": """CASE WHEN least(CAST(regexp_split_to_array(v, '[./-]')[1] AS INTEGER), CAST(regexp_split_to_array(v, '[./-]')[2] AS INTEGER)) BETWEEN 1 AND 12
      AND greatest(CAST(regexp_split_to_array(v, '[./-]')[1] AS INTEGER), CAST(regexp_split_to_array(v, '[./-]')[2] AS INTEGER)) <= 31
      AND near AND NOT doubt THEN v END""",
}


def _matches(kind, order: int) -> str:
    pattern = kind.pattern.replace("(?:", "(").replace("(", "(?:")
    beside = lambda words: (
        f"regexp_matches(right(p[i], {BEFORE}), '(?i)(?:^|[^A-Za-z])(?:{words})(?:[^A-Za-z]|$)')"
        f" OR regexp_matches(left(p[i + 1], {AFTER}), '(?i)(?:^|[^A-Za-z])(?:{words})(?:[^A-Za-z]|$)')"
    )
    return f"""
SELECT doc_id, {order} AS place, '{kind.name}' AS kind, start, start + length(c) AS stop FROM (
  SELECT doc_id, start, {_CONFIRMED[kind.name]} AS c FROM (
    SELECT doc_id, m[i] AS v, regexp_replace(m[i], '[^0-9]', '', 'g') AS d, {beside(kind.words)} AS near, {beside(DOUBT)} AS doubt,
      list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (
      SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS p
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))))
WHERE c IS NOT NULL"""


PERSONAL = f"""
WITH spans AS ({" UNION ALL ".join(_matches(kind, order) for order, kind in enumerate(KINDS))}),
joined AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{kind.name}') AS n_{kind.name}" for kind in KINDS[:4])},
    string_agg(concat_ws(':', kind, CAST(start AS BIGINT), CAST(stop AS BIGINT)), ',' ORDER BY start, place) FILTER (place < 4) AS base,
    string_agg(concat_ws(':', kind, CAST(start AS BIGINT), CAST(stop AS BIGINT)), ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{kind.name}, 0) AS n_{kind.name}" for kind in KINDS[:4])},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, unnest(list_concat(ws,
    list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i + 1], ' ')),
    list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')))) AS phrase FROM pieces),
counts AS (SELECT lang, phrase, count(*) AS f, string_split(phrase, ' ') AS ws FROM grams GROUP BY lang, phrase),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE len(ws) = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE len(ws) > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, len(ws))) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r,
    CAST(CAST(1000000 AS HUGEINT) * c.f * c.f // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase
    FROM candidates WHERE len(ws) = 3) GROUP BY lang, phrase),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM worst LEFT JOIN longer USING (lang, phrase) WHERE coalesce(100 * f < 50 * a, TRUE))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

ORACLES = {
    "op2_exact_dedup": rf"""
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = min(doc_id) OVER same AS kept, text_sha256
        FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g')) AS text_sha256
              FROM documents)
        WINDOW same AS (PARTITION BY text_sha256)""",
    "op3_warc": """
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
        FROM (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last
              FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                        sha1(coalesce(html, '')) AS payload_digest FROM pages))""",
    "op4_quality_rules": f"WITH {QUALITY} SELECT * FROM judged",
    "op12_personal_data": PERSONAL,
    "op13_phrase_mining": PHRASES,
}
