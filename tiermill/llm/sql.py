"""SQL that the numbered queries must agree with."""

from __future__ import annotations

from tiermill.llm.quality import RULES, STOP_WORDS


def _rule(rule) -> str:
    parts = []
    if rule.low is not None:
        parts.append(f"{rule.numerator} * 1000 >= {rule.denominator} * {rule.low}")
    if rule.high is not None:
        parts.append(f"{rule.numerator} * 1000 <= {rule.denominator} * {rule.high}")
    return f"({rule.denominator} < {rule.at_least} OR ({' AND '.join(parts)}))"


_STOP = ", ".join(f"'{w}', '{w.capitalize()}'" for w in dict.fromkeys(STOP_WORDS.split()))

QUALITY_RULES = f"""
WITH body AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
listed AS (
  SELECT r, doc_id, body,
         list_filter(regexp_split_to_array(body, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(body, chr(10)), lambda l: regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g') <> '') AS lines
  FROM body
),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w FROM listed, unnest(generate_series(1, len(words) - 7)) AS g(i)
),
repeated AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next
             FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, CAST(sum(least(8, coalesce(next - i, 8))) AS BIGINT) AS n FROM repeated GROUP BY r),
counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_filter(lines, lambda l: regexp_matches(ltrim(l), '^[-*•]'))) AS BIGINT) AS n_bullet_lines,
         CAST(len(list_filter(lines, lambda l: suffix(rtrim(l), '...'))) AS BIGINT) AS n_ellipsis_lines,
         CAST(len(list_filter(words, lambda w: w IN ({_STOP}))) AS BIGINT) AS n_stop_words,
         coalesce(n, 0) AS n_repeat_words
  FROM listed LEFT JOIN covered USING (r)
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(map(_rule, RULES))} AS kept
FROM judged
"""


WARC_REVISITS = """
WITH visits AS (
  SELECT page_id, v, url, coalesce(html, '') AS body, substr(md5(coalesce(html, '')), 1, 16) AS tag,
         CASE WHEN v = 2 THEN page_id % 3 END AS kind
  FROM pages, unnest([0, 1, 2, 3]) AS u(v)
),
bare AS (SELECT *, regexp_replace(regexp_replace(trim(url), '^(?i)https?://', ''), '#.*$', '') AS b,
                v = 0 OR coalesce(kind = 2, false) AS is_full FROM visits),
parted AS (SELECT *, regexp_extract(b, '^[^/?]*') AS host FROM bare),
trimmed AS (
  SELECT *, regexp_replace(regexp_replace(lower(host), ':(80|443)$', ''), '^(www|m)\\.', '') AS h,
         regexp_replace(substr(b, length(host) + 1), '([?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '\\1', 'g') AS rest
  FROM parted
),
records AS (
  SELECT page_id * 4 + v AS record_id, page_id + v * 1000 AS fetched_at, is_full,
         h || regexp_replace(regexp_replace(regexp_replace(regexp_replace(rest, '&+', '&', 'g'), '\\?&', '?', 'g'),
                             '[?&]+$', ''), '/+$', '') AS key,
         CASE WHEN v = 1 THEN 'W/"' || tag || '"' WHEN kind = 0 THEN '"stale"' WHEN kind = 1 THEN NULL
              WHEN kind = 2 THEN '"' || reverse(tag) || '"' ELSE '"' || tag || '"' END AS etag,
         CASE WHEN is_full OR kind = 1 THEN 'day ' || (page_id % 1000) END AS modified,
         'visit ' || v AS date, CASE WHEN v <> 2 THEN 'max-age=' || (v * 60) END AS cache,
         CASE WHEN is_full THEN 'text/html' ELSE 'text/plain' END AS ctype,
         CASE WHEN is_full THEN CAST(length(body) AS VARCHAR) END AS clength,
         CASE WHEN is_full THEN md5(body || v) END AS digest
  FROM trimmed
),
placed AS (
  SELECT *, last_value(CASE WHEN is_full THEN record_id END IGNORE NULLS) OVER
    (PARTITION BY key ORDER BY fetched_at, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rid
  FROM records
),
joined AS (
  SELECT p.*, r.record_id AS response_id, r.fetched_at AS response_at, r.etag AS r_etag, r.modified AS r_modified,
         r.cache AS r_cache, r.ctype AS r_ctype, r.clength AS r_clength, r.digest AS r_digest,
         CASE WHEN r.record_id IS NULL THEN 'no_response'
              WHEN p.etag IS NOT NULL AND r.etag IS NOT NULL THEN
                CASE WHEN ltrim(p.etag, 'W/') = ltrim(r.etag, 'W/') THEN 'match' ELSE 'mismatch' END
              WHEN p.modified IS NOT NULL AND r.modified IS NOT NULL THEN
                CASE WHEN p.modified = r.modified THEN 'match' ELSE 'mismatch' END
              ELSE 'unchecked' END AS resolution
  FROM placed p LEFT JOIN records r ON p.rid = r.record_id WHERE NOT p.is_full
)
SELECT record_id, key AS canonical_url, fetched_at, response_id, response_at, resolution,
       CASE WHEN resolution IN ('match', 'unchecked') THEN r_digest END AS digest,
       CASE WHEN resolution IN ('match', 'unchecked') THEN
         concat_ws(chr(10), 'cache-control: ' || coalesce(cache, r_cache), 'content-length: ' || r_clength,
                   'content-type: ' || r_ctype, 'date: ' || date, 'etag: ' || coalesce(etag, r_etag),
                   'last-modified: ' || r_modified) END AS headers
FROM joined
"""

POISSON_MIX = """
WITH sizes AS (SELECT source, sum(length(coalesce(text, ''))) AS chars FROM documents GROUP BY source),
weighed AS (SELECT *, sqrt(CAST(chars AS DOUBLE)) AS weight FROM sizes),
rates AS (SELECT source, CASE WHEN chars > 0 THEN weight / (SELECT sum(weight) FROM weighed)
                 * (SELECT sum(chars) FROM weighed) / chars ELSE 1.0 END AS rate FROM weighed),
parted AS (SELECT *, greatest(1, CAST(ceil(rate / 16) AS BIGINT)) AS parts FROM rates),
terms AS (SELECT source, k, sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)))
                 OVER (PARTITION BY source ORDER BY k) AS cdf
          FROM parted, unnest(generate_series(0, 96)) AS g(k)),
drawn AS (
  SELECT d.doc_id, d.text, d.source, j, (CAST('0x' || substr(md5('20240|' || coalesce(CAST(d.doc_id AS VARCHAR), 'text ' || md5(coalesce(d.text, '')))
         || '|' || j), 1, 13) AS BIGINT) + 0.5) / CAST(16 AS DOUBLE) ** 13 AS u
  FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source, unnest(generate_series(1, p.parts)) AS s(j)
),
counted AS (
  SELECT d.doc_id, any_value(d.text) AS text, d.source, count(*) FILTER (t.cdf <= d.u) AS n_copies
  FROM drawn d JOIN terms t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.doc_id, d.source
)
SELECT doc_id, text, source, copy, n_copies,
       md5('20240s|' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, ''))) || '|' || copy) AS shuffle_key
FROM counted, unnest(generate_series(1, n_copies)) AS c(copy)
"""

SUBSTRINGS = """
WITH listed AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 34], ' ') AS w FROM listed, unnest(generate_series(1, len(words) - 34)) AS g(i)
),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1),
gone AS (SELECT r, list(DISTINCT i + k) AS places FROM repeated, unnest(generate_series(0, 34)) AS g(k) GROUP BY r),
kept AS (
  SELECT doc_id, words, coalesce(len(places), 0) AS n_removed,
         CASE WHEN places IS NULL THEN words
              ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END AS rest
  FROM listed LEFT JOIN gone USING (r)
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(rest, ' ')) AS kept_sha256
FROM kept
"""

LONG_MATCHES = """
WITH bodies AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS w FROM bodies, unnest(generate_series(0, length(h) // 2 - 200)) AS g(i)
),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1),
opened AS (SELECT r, i, CASE WHEN i > lag(i) OVER o + 200 THEN 1 ELSE 0 END AS opens FROM repeated
           WINDOW o AS (PARTITION BY r ORDER BY i)),
numbered AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM opened),
spans AS (SELECT r, min(i) AS a, max(i) + 200 AS z FROM numbered GROUP BY r, s),
gaps AS (SELECT r, a, z, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM spans),
cut AS (
  SELECT g.r, count(*) AS n, sum(z - a) AS removed, max(z) AS tail,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM gaps g JOIN bodies b ON g.r = b.r GROUP BY g.r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM bodies LEFT JOIN cut USING (r)
"""

NEAR_DUPLICATES = """
WITH RECURSIVE listed AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM listed, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS g(i) WHERE len(words) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s)
           WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 75 * (x.n + y.n - c)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""


def _field(name: str, text: str | None = None) -> str:
    value = text or f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join([*map(_field, ('doc_id', 'source', 'lang', 'n_chars')), _field('text', text)])})"


#: crc32 of the decimal id, bit by bit: every byte is followed by seven steps without one.
_CRC = """xor(list_reduce([4294967295::BIGINT] || flatten([[ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0] for c in string_split(CAST(doc_id AS VARCHAR), '')]),
              lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEVEL = "[sha256(array_to_string(d[i * 16 + 1:i * 16 + 16], '')) for i in range((len(d) + 15) // 16)]"


def _step(levels: str, join: str) -> str:
    """One level up: siblings to the proof, the folded digest in the place of the own one."""
    run = "l.d[place // 16 * 16 + 1:place // 16 * 16 + 16]"
    before, after = f"array_to_string({run}[1:place % 16], '')", f"array_to_string({run}[place % 16 + 2:16], '')"
    return f"""SELECT c.* EXCLUDE (level, place, folded, proof), c.level + 1 AS level, place // 16 AS place,
                 sha256({before} || folded || {after}) AS folded, proof || {before} || {after} AS proof
               FROM c JOIN {levels} l ON {join} AND l.level = c.level AND len(l.d) > 1"""


MERKLE = f"""
WITH RECURSIVE
leaves AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {_leaf('text')} END AS seen
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves
),
levels AS (
  SELECT tree, 0 AS level, list(leaf ORDER BY place) AS d FROM placed GROUP BY tree
  UNION ALL SELECT tree, level + 1, {_LEVEL} FROM levels WHERE len(d) > 1
),
subroots AS (SELECT tree, d[1] AS subroot FROM levels WHERE len(d) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY tree) AS d FROM subroots
  UNION ALL SELECT level + 1, {_LEVEL} FROM tops WHERE len(d) > 1
),
low AS (
  SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, tree, leaf, 0 AS level, place, seen AS folded, '' AS proof FROM placed) AS c
  UNION ALL {_step('levels', 'l.tree = c.tree').replace('FROM c ', 'FROM low AS c ')}
),
high AS (
  SELECT * FROM (
    SELECT low.* EXCLUDE (level, place, folded, proof), 0 AS level, low.tree AS place, folded, proof
    FROM low JOIN levels l ON l.tree = low.tree AND l.level = low.level AND len(l.d) = 1) AS c
  UNION ALL {_step('tops', 'true').replace('FROM c ', 'FROM high AS c ')}
)
SELECT doc_id, leaf, subroot, t.d[1] AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.d[1] AS verified
FROM high JOIN tops t ON t.level = high.level AND len(t.d) = 1 JOIN subroots USING (tree)
"""


FILL_IN_MIDDLE = """
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units FROM documents
),
drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS c2,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
),
parts AS (
  SELECT *, array_to_string(units[1:least(c1, c2)], '') AS pre, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
         array_to_string(units[greatest(c1, c2) + 1:], '') AS suf FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""
