"""The SQL of the operators that SQL can express, in DuckDB's dialect.

SQL has neither the merges of a tokenizer, a learned lexicon, the random draws of a
fingerprint or of label propagation, nor a reader of broken markup, and all periods of all
texts are too many for it; those operators are held against brute force, an exact round
trip or held-out labels in ``tests/llm``.
"""

from retail_lake.llm.infill import Rules as Forms
from retail_lake.llm.minhash import SIMILAR, WORDS
from retail_lake.llm.quality import BOILERPLATE, SYMBOLS, WINDOW, Rules
from retail_lake.llm.suffix_dedup import WINDOW as BYTES

RULES = Rules()
FORMS = Forms()
WORD = r"[^\x20\x09-\x0D]+"

REPEATS = f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  w AS (SELECT doc_id, p, substr(h, 2 * p + 1, {2 * BYTES}) AS bytes
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {BYTES - 1})) AS p FROM d)),
  earliest AS (SELECT bytes, min(doc_id) AS least FROM w GROUP BY bytes),
  hit AS (SELECT doc_id, p FROM w JOIN earliest USING (bytes) WHERE doc_id > least),
  marked AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {BYTES}
    THEN 0 ELSE 1 END AS fresh FROM hit),
  counted AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
  runs AS (SELECT doc_id, min(p) AS s, max(p) + {BYTES} AS e FROM counted GROUP BY doc_id, run),
  pieces AS (SELECT doc_id, s, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS since FROM runs
    UNION ALL SELECT d.doc_id, length(h) // 2, coalesce(max(e), 0)
      FROM d LEFT JOIN runs ON runs.doc_id = d.doc_id GROUP BY d.doc_id, length(h)),
  kept AS (SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (s - since)), '' ORDER BY s, since) AS h
    FROM pieces JOIN d USING (doc_id) GROUP BY doc_id),
  cut AS (SELECT doc_id, sum(e - s) AS n, count(*) AS spans FROM runs GROUP BY doc_id)
  SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed,
    coalesce(cut.spans, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
  FROM d JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN cut ON cut.doc_id = d.doc_id"""

NEAR = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
    FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN []
      WHEN len(words) < {WORDS} THEN [array_to_string(words, ' ')]
      ELSE list_distinct(list_transform(range(1, len(words) - {WORDS - 2}),
        lambda i: array_to_string(words[i:i + {WORDS - 1}], ' '))) END AS shingles FROM w),
  e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
  p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM e x JOIN e y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
  l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
    WHERE 100 * k >= {SIMILAR} * (len(x.shingles) + len(y.shingles) - k)),
  links AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  reach AS (SELECT doc_id, doc_id AS other FROM s
    UNION SELECT links.a, reach.other FROM reach JOIN links ON links.b = reach.doc_id)
  SELECT s.doc_id, len(shingles) AS n_shingles, min(other) AS component_id,
    s.doc_id = min(other) AS kept
  FROM s JOIN reach ON reach.doc_id = s.doc_id GROUP BY s.doc_id, shingles"""


def _count(text: str, characters: str) -> str:
    return f"(length({text}) - length(translate({text}, '{characters}', '')))"


QUALITY = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
  w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
  windows AS (SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
  often AS (SELECT doc_id, i FROM (SELECT doc_id, i,
    count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
  covered AS (SELECT doc_id, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM often)
    GROUP BY doc_id),
  line AS (SELECT doc_id, line, regexp_extract_all(line, '{WORD}') AS words
    FROM (SELECT doc_id, unnest(lines) AS line FROM w)),
  measured AS (SELECT doc_id, line, words, len(words) AS n, len(list_distinct(words)) AS differ,
    len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS echoed FROM line),
  judged AS (SELECT doc_id, n,
    ({_count("line", "|»›·")} > {RULES.most_separators}::DOUBLE * n AND n > 1)
    OR {_count("line", SYMBOLS)} > {RULES.most_symbols}::DOUBLE * length(line)
    OR ({_count("line", "!")} > {RULES.most_shouts}::DOUBLE * n AND n > 1)
    OR (n >= {RULES.judged_for_repeats} AND (differ < {RULES.least_distinct}::DOUBLE * n
      OR echoed > {RULES.most_echoed}::DOUBLE * n))
    OR (n <= {RULES.short_line} AND regexp_matches(lower(line), '{"|".join(BOILERPLATE)}'))
    OR (n > 1 AND n <= {RULES.short_line} AND NOT regexp_matches(line, '[\\p{{P}}\\p{{S}}\\p{{N}}]'))
    AS failed FROM measured),
  lost AS (SELECT doc_id, count_if(failed) AS lines, sum(CASE WHEN failed THEN n ELSE 0 END) AS words
    FROM judged GROUP BY doc_id),
  counts AS (SELECT w.doc_id, len(w.words) AS n_words,
    length(array_to_string(w.words, '')) AS word_chars, {_count("t", SYMBOLS)} AS n_symbols,
    len(w.lines) - len(list_distinct(w.lines)) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, len(w.lines) AS n_lines,
    CAST(coalesce(lost.lines, 0) AS BIGINT) AS n_failed_lines,
    CAST(coalesce(lost.words, 0) AS BIGINT) AS n_lost_words
    FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id LEFT JOIN lost ON lost.doc_id = w.doc_id),
  based AS (SELECT *, n_words < {RULES.least_words}
    OR 100 * n_repeat_words > {RULES.most_repeated_percent} * n_words AS base_failed FROM counts)
  SELECT *, NOT base_failed AND NOT n_lost_words > {RULES.most_lost}::DOUBLE * n_words AS kept
  FROM based"""

def _group(number: int) -> str:
    return f"CAST('0x' || substr(h, {8 * number + 1}, 8) AS BIGINT)"


INFILL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    sha256('{FORMS.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
  g AS (SELECT doc_id, t, length(t) AS n, {", ".join(f"{_group(i)} AS h{i + 1}" for i in range(4))} FROM d),
  f AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR {" OR ".join(f"contains(t, '{m}')" for m in FORMS.sentinels)}
      OR h3 % 100 >= {100 - FORMS.plain_percent} THEN 'plain'
      WHEN h4 % 100 < {FORMS.spm_percent} THEN 'spm' ELSE 'psm' END AS form FROM g),
  parts AS (SELECT *, '{FORMS.prefix}' || substr(t, 1, a) AS prefix, '{FORMS.middle}' || substr(t, a + 1, b - a) AS middle,
    '{FORMS.suffix}' || substr(t, b + 1) AS suffix FROM f)
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN prefix || suffix || middle
      ELSE suffix || prefix || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts"""

# 40 hex digits are eight groups of five, each of four digits to the base of 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = " || ".join(
    f"substr('{BASE32}', ((v >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0)
)
WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
  o AS (SELECT html, max(page_id) AS owner FROM p GROUP BY html),
  b AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, owner, array_to_string(list_transform(
      list_transform(range(0, 8), lambda i: CAST('0x' || substr(sha1(html), 5 * i + 1, 5) AS INTEGER)),
      lambda v: {_DIGITS}), '') AS payload_digest,
    owner IS NULL OR page_id IS NOT DISTINCT FROM owner AS own FROM p JOIN o USING (html))
  SELECT page_id, payload_bytes, payload_digest, CASE WHEN own THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN NOT own THEN owner END AS refers_to FROM b"""

ORACLES: dict[str, str] = {
    "op4_suffixes": REPEATS,
    "op6_minhash": NEAR,
    "op10_quality": QUALITY,
    "op11_infill": INFILL,
    "op12_warc": WARC,
}
