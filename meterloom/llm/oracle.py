"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import chat, licenses, reputation, rules, secrets, target_draw, vectorcodes

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
DOCS = "docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents)"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LIMITS = rules.Limits()
# Every character that parts words is written twice, so that neighbouring phrases need not share one.
_OUTSIDE = r"^0-9a-z_\x{80}-\x{10FFFF}"
_PHRASES = f"(?:^|[{_OUTSIDE}])({'|'.join(x.replace(' ', '  ') for x in rules.BOILERPLATE)})(?:[{_OUTSIDE}]|$)"

QUALITY_RULES = rf"""
WITH {DOCS},
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
lines AS (
  SELECT r, i, line, w, len(w) AS n FROM (
    SELECT r, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM (
      SELECT r, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs))
  WHERE len(w) > 0),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
    length(line) - length(replace(line, '|', '')) AS bars,
    (length(line) - length(replace(line, '!!', ''))) / 2 AS shouts,
    len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
    len(regexp_extract_all(line, '[{rules.UNSPACED}]')) // {_LIMITS.unspaced_word} AS unspaced,
    greatest(n // {_LIMITS.word_span}, 1) AS k,
    list_sum(list_transform(regexp_extract_all(regexp_replace({LOWER.format("line")}, '([{_OUTSIDE}])', '\1\1', 'g'),
      {_quoted(_PHRASES)}, 1), lambda x: len(string_split(x, '  ')))) AS phrases
  FROM lines),
by_line AS (
  SELECT r, count(*) FILTER (again) AS n_dup_lines, sum(n) FILTER (
      again OR bars >= 2 AND bars * 3 >= n OR shouts * 2 >= n OR symbols >= n
      OR n >= {_LIMITS.word_run} AND 2 * list_sum(list_transform(range(k), lambda j:
        CASE WHEN list_unique(w[(j * n // k + 1)::INT:((j + 1) * n // k)::INT]) * 4 < (j + 1) * n // k - j * n // k
             THEN (j + 1) * n // k - j * n // k ELSE 0 END)) >= n
      OR n + unspaced < {_LIMITS.short_line} AND n < {_LIMITS.short_line}
        AND NOT regexp_matches(w[n], {_quoted("[" + "".join(c.replace("]", chr(92) + "]") for c in rules.CLOSING) + "]$")})
      OR phrases > 0 AND 100 * phrases >= {_LIMITS.phrase_percent} * n) AS lost
  FROM judged GROUP BY r),
windows AS (
  SELECT r, s, count(*) OVER (PARTITION BY r, g) AS often FROM (
    SELECT r, s, w[s:s + 7] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS s FROM words))),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + 8)) AS p FROM windows WHERE often > 1) GROUP BY r),
counted AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost, 0) AS n_lost_words
  FROM docs JOIN words USING (r) LEFT JOIN by_line USING (r) LEFT JOIN covered USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_lost_words <= 50 * n_words AS kept,
  n_lost_words::BIGINT AS n_lost_words
FROM counted
"""

_TEMPLATES = ", ".join(
    f"({number}, '{label}', {phrase}, {pairs}, {place}, '{a}', '{b}')"
    for number, label, phrase, pairs, place, a, b in licenses.templates()
)

LICENSES = rf"""
WITH {DOCS},
templates(template, label, phrase, pairs, place, t1, t2) AS (VALUES {_TEMPLATES}),
words AS (SELECT r, doc_id, regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs),
grams AS (SELECT r, i - 1 AS pos, w[i] AS w1, w[i + 1] AS w2 FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM words)),
hits AS (SELECT r, template, label, phrase, pairs, place, pos - place AS diagonal FROM grams JOIN templates ON w1 = t1 AND w2 = t2),
votes AS (
  SELECT r, template, label, phrase, pairs, diagonal, count(DISTINCT place) AS n FROM hits GROUP BY ALL
  HAVING count(DISTINCT place) >= greatest(1, pairs * {licenses.DIAGONAL_SHARE})),
apart AS (
  SELECT *, coalesce((diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {licenses.NEAR})::INT, 0) AS gap
  FROM votes WHERE NOT phrase),
numbered AS (SELECT *, sum(gap) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM apart),
merged AS (
  SELECT r, label, FALSE AS phrase, min(diagonal) AS first_word, count(DISTINCT place) / pairs AS share
  FROM numbered JOIN hits USING (r, template, label, phrase, pairs, diagonal)
  GROUP BY r, template, label, pairs, span),
spans AS (
  SELECT r, label, phrase, diagonal AS first_word, 1.0::DOUBLE AS share FROM votes WHERE phrase AND n = pairs
  UNION ALL SELECT r, label, phrase, first_word, share FROM merged WHERE share >= {licenses.SPAN_SHARE}),
found AS (
  SELECT r, count(*) FILTER (phrase) AS n_base, min(first_word) FILTER (phrase) AS first_word,
    max(first_word) FILTER (phrase) AS last_word,
    coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM spans GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM words LEFT JOIN found USING (r)
"""


def _limit(column: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({column}, '{p}') THEN {b or 'NULL'}" for p, b in secrets.LIMITS[:-1])
    return f"CASE {cases} ELSE {secrets.LIMITS[-1][1]} END"


_PATTERNS = (secrets.ASSIGN, "AKIA[A-Z0-9]+", "[0-9a-f]+", secrets.CANDIDATE)
_FOUND = " UNION ALL ".join(
    f"""SELECT r, {kind} AS kind, unnest(regexp_extract_all(text, {_quoted(p)})) AS m,
        unnest(string_split_regex(text, {_quoted(p)})[1:len(regexp_extract_all(text, {_quoted(p)}))]) AS gap,
        generate_subscripts(regexp_extract_all(text, {_quoted(p)}), 1) AS i FROM docs"""
    for kind, p in enumerate(_PATTERNS)
)
_THINGS = " OR ".join(
    f"regexp_matches(m, {_quoted(holds)})" + (f" AND NOT regexp_matches(m, {_quoted(without)})" if without else "")
    for holds, without in secrets.NAMES_THINGS
)
_NAME = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(secrets.KINDS))
_SPAN = f"CASE kind {_NAME} END || ':' || s || ':' || e"
_ORDERED = f"string_agg({_SPAN}, ',' ORDER BY s, kind, e)"

SECRETS = rf"""
WITH {DOCS},
found AS ({_FOUND}),
located AS (
  SELECT r, kind, m, e - length(m) AS s, e FROM (
    SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM found)),
plain AS (
  SELECT r, kind, s, e FROM located
  WHERE kind = 0 AND length(regexp_extract(m, {_quoted(secrets.ASSIGN)}, 2)) >= {secrets.MIN_VALUE}
     OR kind = 1 AND length(m) >= 20 OR kind = 2 AND length(m) >= 24),
windows AS (
  SELECT r, s, e, m, least_bits, k, list_aggregate(string_split(substr(m, k + 1, {secrets.WINDOW}), ''), 'entropy') AS bits
  FROM (SELECT r, s, e, m, {_limit("m")} AS least_bits, unnest(range(0, length(m) - {secrets.WINDOW - 1})) AS k FROM located
        WHERE kind = 3 AND NOT ({_THINGS}))),
odd AS (
  SELECT r, 3 AS kind, s + min(k) AS a, s + max(k) + {secrets.WINDOW} AS z FROM windows
  WHERE bits >= least_bits AND NOT regexp_matches(substr(m, k + 1, {secrets.WINDOW}), {_quoted(secrets.PLACEHOLDER)}) GROUP BY r, s),
spans AS (SELECT r, kind, s::BIGINT AS s, e::BIGINT AS e FROM plain UNION ALL SELECT r, kind, a::BIGINT, z::BIGINT FROM odd),
joined AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    {_ORDERED} FILTER (kind < 3) AS base, {_ORDERED} AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""

_POLICY = reputation.Policy()
_FITS = " UNION ALL ".join(
    f"SELECT r, '{verdict}' AS verdict, '{rule}' AS rule FROM places WHERE (host = '{rule.split('/')[0]}' "
    f"OR ends_with(host, '.{rule.split('/')[0]}')) AND starts_with(path, '{rule[rule.index('/'):]}')"
    for verdict, rule in reputation.RULES
)


def _level(name: str, key: str, source: str) -> str:
    """Sums and prior weight of a level, from the level below."""
    return f"""
{name} AS (
  SELECT {key}, pages, bad, least(greatest(coalesce(CASE WHEN share > 0 THEN 1 / share - 1 END, {_POLICY.most_pages}),
      {_POLICY.least_pages}), {_POLICY.most_pages}) AS worth
  FROM (
    SELECT {key}, pages, bad, CASE WHEN pages - squares / pages - (k - 1) > 0 AND bad > 0 AND bad < pages THEN
        (spread - bad * bad / pages - (k - 1) * (bad / pages) * (1 - bad / pages))
        / ((pages - squares / pages - (k - 1)) * (bad / pages) * (1 - bad / pages)) ELSE 0 END AS share
    FROM (
      SELECT {key}, count(*) AS k, sum(pages)::DOUBLE AS pages, sum(bad)::DOUBLE AS bad, sum(pages * pages)::DOUBLE AS squares,
        sum(bad * bad / pages)::DOUBLE AS spread
      FROM {source} WHERE pages > 0 GROUP BY {key})))"""


URL_REPUTATION = rf"""
WITH places AS (
  SELECT row_number() OVER () AS r, page_id,
    {LOWER.format("coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
told AS (SELECT doc_id, max((quality = 0)::INT) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain, string_split(host, '.')[-1] AS suffix,
    1 AS every, count(bad) AS pages, coalesce(sum(bad), 0) AS bad
  FROM places LEFT JOIN told ON page_id = doc_id GROUP BY host),
domains AS (SELECT domain, suffix, every, sum(pages) AS pages, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, every, sum(pages) AS pages, sum(bad) AS bad FROM domains GROUP BY ALL),
{_level("all_w", "every", "suffixes")},
{_level("suffix_w", "suffix", "domains")},
{_level("domain_w", "domain", "hosts")},
of_suffix AS (
  SELECT s.suffix, (coalesce(a.bad / a.pages, 0) * coalesce(a.worth, {_POLICY.most_pages}) + s.bad)
      / (coalesce(a.worth, {_POLICY.most_pages}) + s.pages) AS mean, coalesce(w.worth, {_POLICY.most_pages}) AS worth
  FROM suffixes s LEFT JOIN all_w a USING (every) LEFT JOIN suffix_w w USING (suffix)),
of_domain AS (
  SELECT d.domain, (o.mean * o.worth + d.bad) / (o.worth + d.pages) AS mean, coalesce(w.worth, {_POLICY.most_pages}) AS worth
  FROM domains d JOIN of_suffix o USING (suffix) LEFT JOIN domain_w w USING (domain)),
scores AS (
  SELECT host, (o.mean * o.worth + h.bad) / (o.worth + h.pages) AS bad_rate, o.worth + h.pages AS weight
  FROM hosts h JOIN of_domain o USING (domain)),
bounds AS (
  SELECT host, bad_rate, greatest(bad_rate - {_POLICY.deviations} * sqrt(bad_rate * (1 - bad_rate) / (weight + 1)), 0) AS low_bound
  FROM scores),
fits AS ({_FITS}),
best AS (SELECT r, arg_max(verdict, length(rule)) AS verdict, arg_max(rule, length(rule)) AS rule FROM fits GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN low_bound >= {_POLICY.limit} THEN 'block' ELSE 'allow' END) AS verdict,
  round(bad_rate, 9) AS bad_rate, round(low_bound, 9) AS low_bound
FROM places LEFT JOIN bounds USING (host) LEFT JOIN best USING (r)
"""

_DRAW = target_draw.Draw()


def _crc_step(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


_CRC_STEPS = [_crc_step(b) for b in range(256)]


def _bytes(blob: str) -> str:
    """The bytes of a blob as numbers."""
    return f"list_transform(range(octet_length({blob})), lambda i: ('0x' || substr(hex({blob}), (2 * i + 1)::INT, 2))::INT)"


TARGET_DRAW = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, TRUE AS own, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, FALSE, text FROM benchmark),
words AS (
  SELECT r, doc_id, own, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
  SELECT r, own, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS run
  FROM words, (SELECT unnest(range(1, {_DRAW.run + 1})) AS k)),
known AS (SELECT DISTINCT run FROM runs),
hashed AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT, {_bytes("encode(run)")}::BIGINT[]),
    lambda c, b: xor(c >> 8, {_CRC_STEPS}[((xor(c, b) & 255) + 1)::INT])), 4294967295) % {_DRAW.buckets} AS bucket FROM known),
placed AS (SELECT r, own, bucket FROM runs JOIN hashed USING (run)),
every AS (SELECT unnest(range({_DRAW.buckets})) AS bucket),
counts AS (
  SELECT bucket, count(own) FILTER (own) AS s, count(own) FILTER (NOT own) AS t FROM every LEFT JOIN placed USING (bucket) GROUP BY bucket),
sums AS (SELECT sum(s)::BIGINT AS ss, sum(t)::BIGINT AS tt FROM counts),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (ss + {_DRAW.buckets})) / ((s + 1)::DOUBLE * (tt + {_DRAW.buckets}))))::BIGINT AS gain
  FROM counts, sums),
weights AS (SELECT r, count(*) AS n_features, sum(gain) AS weight FROM placed JOIN gains USING (bucket) WHERE own GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{_DRAW.seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296))))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE own),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS n FROM scored
  WHERE n_words >= {_DRAW.least_words})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {_DRAW.percent} * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""

_CODING = vectorcodes.Coding()
_DISTANCE = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))::BIGINT"


def _round(number: int) -> str:
    """Nearest entries under the codebooks of the round before, and the codebooks after it."""
    k = _CODING.entries
    assign = f"""
near{number} AS (
  SELECT r, p, min({_DISTANCE} * {k} + e) AS best FROM parts JOIN books{number - 1} USING (p) GROUP BY r, p)"""
    if number > _CODING.rounds:
        return assign
    return f"""{assign},
means{number} AS (
  SELECT p, e, list(m ORDER BY i) AS z FROM (
    SELECT p, best % {k} AS e, i, floor(sum(v)::DOUBLE / count(*))::BIGINT AS m
    FROM (SELECT p, best, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM near{number} JOIN parts USING (r, p)) GROUP BY p, e, i)
  GROUP BY p, e),
books{number} AS MATERIALIZED (SELECT p, e, coalesce(z, y) AS y FROM books{number - 1} LEFT JOIN means{number} USING (p, e))"""


VECTOR_CODES = f"""
WITH whole AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label,
    list_transform(embedding, lambda v: floor(v::DOUBLE * {_CODING.units})::BIGINT) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, x[p * len(x) // {_CODING.parts} + 1:(p + 1) * len(x) // {_CODING.parts}] AS x
  FROM whole, (SELECT unnest(range({_CODING.parts})) AS p)),
books0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS y FROM parts WHERE r <= {_CODING.entries}),
{",".join(_round(i) for i in range(1, _CODING.rounds + 2))},
codes AS (
  SELECT r, string_agg(lower(format('{{:02x}}', best % {_CODING.entries})), '' ORDER BY p) AS code,
    sum(best // {_CODING.entries})::BIGINT AS error
  FROM near{_CODING.rounds + 1} GROUP BY r),
sha AS (
  SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books{_CODING.rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM whole JOIN codes USING (r), sha
"""

_TEMPLATE = chat.Template()
_OPENING = " ".join(f"WHEN role = '{role}' THEN {len(opening)}" for role, opening in _TEMPLATE.openings)


def _escaped(text: str) -> str:
    return rf"length(regexp_replace({text}, '(\\*)({"|".join(_TEMPLATE.controls)})', '\1\1\\\2', 'g'))"


CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{_TEMPLATE.learned}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{_TEMPLATE.learned}'), '')) AS loss_sha256,
  sum({len(_TEMPLATE.closing)} + {_escaped("text")}
    + CASE {_OPENING} ELSE {len(_TEMPLATE.other) + len(_TEMPLATE.body)} + {_escaped("role")} END)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

SQL = {
    "op3_url_reputation": URL_REPUTATION,
    "op5_licenses": LICENSES,
    "op6_secrets": SECRETS,
    "op8_quality_rules": QUALITY_RULES,
    "op11_target_draw": TARGET_DRAW,
    "op12_vector_codes": VECTOR_CODES,
    "op13_chat": CHAT,
}
