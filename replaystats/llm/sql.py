"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

# Fixed values of the contracts: blanks and capitals.
BLANKS = "(chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT *, trim({LOWERED.format("line")}, {BLANKS}) AS k FROM line),
bad AS (
  SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
),
marked AS (SELECT keyed.*, bad.k IS NOT NULL AND doc_id <> owner AS gone FROM keyed LEFT JOIN bad USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Fixed values of the method: menu separators and phrases of page furniture.
SEPARATORS = "|>»›•·"
PHRASES = (
    "all rights reserved",
    "accept all cookies",
    "we use cookies",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "click here",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "enable javascript",
    "lorem ipsum",
    "back to top",
    "share this article",
    "skip to content",
)
WORDS = r"list_filter(string_split_regex({}, '[ \t-\r]+'), lambda w: w <> '')"
SOLID = f"length(translate({{}}, {BLANKS}, ''))"
PHRASE = " OR ".join(f"contains(lower(line), '{p}')" for p in PHRASES)

QUALITY = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, t, {WORDS.format("t")} AS w FROM docs),
windows AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) AS g,
         unnest(range(1, len(w) - 1)) AS i
  FROM words WHERE len(w) >= 3
),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs),
worded AS (SELECT *, {SOLID.format("line")} AS solid FROM line WHERE {SOLID.format("line")} > 0),
judged AS (
  SELECT *,
    length(regexp_replace(line, '[^\\p{{L}}]+', '', 'g')) * 2 < solid
    OR (length(line) - length(translate(line, '{SEPARATORS}', '')) >= 2
        AND len({WORDS.format("line")}) < 5 * (length(line) - length(translate(line, '{SEPARATORS}', ''))))
    OR (({PHRASE}) AND len({WORDS.format("line")}) < 30) AS bad
  FROM worded
),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dups, count(*) FILTER (bad) AS bad,
         count(*) FILTER (NOT bad) AS good, coalesce(sum(solid) FILTER (bad), 0) AS lost
  FROM judged GROUP BY doc_id
),
joined AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words, {SOLID.format("t")}::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         coalesce(bad, 0)::BIGINT AS n_bad_lines, coalesce(lost, 0)::BIGINT AS lost_chars, coalesce(good, 0) AS good
  FROM words LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)
)
SELECT * EXCLUDE (good), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND good > 0
       AND lost_chars <= 0.3 * word_chars AS kept
FROM joined
"""

# Fixed values of the method: patterns, account number lengths by country, words nearby.
IBANS = "|".join(
    f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}"
    for n, codes in (
        (15, "NO"),
        (16, "BE"),
        (18, "DK FI FK FO GL NL SD"),
        (19, "MK SI"),
        (20, "AT BA EE KZ LT LU MN XK"),
        (21, "CH HR LI LV"),
        (22, "BG BH CR DE GB GE IE ME RS VA"),
        (23, "AE GI IL IQ OM SO TL"),
        (24, "AD CZ ES MD PK RO SA SE SK TN VG"),
        (25, "LY PT ST"),
        (26, "IS TR"),
        (27, "BI DJ FR GR IT MC MR SM"),
        (28, "AL AZ BY CY DO GT HU LB NI PL SV"),
        (29, "BR EG PS QA UA"),
        (30, "JO KW MU YE"),
        (31, "MT SC"),
        (32, "LC"),
        (33, "RU"),
    )
)
CALLS = "'phone', 'tel', 'telephone', 'call', 'mobile', 'fax', 'cell', 'whatsapp', 'telefon', 'téléphone', 'teléfono'"
AGAINST = "'version', 'release', 'build', 'isbn', 'order', 'invoice', 'serial', 'sku', 'ticket', 'section'"
FOUND = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(x, '.'), lambda p: try_cast(p AS HUGEINT) IS NULL OR p::HUGEINT > 255)) = 0"),
    (
        "card",
        r"[0-9](?:[ -]?[0-9])+",
        """length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(d)), lambda j:
             CASE WHEN j % 2 = 0 THEN substr(d, (length(d) - j)::BIGINT, 1)::INT
                  ELSE (2 * substr(d, (length(d) - j)::BIGINT, 1)::INT) // 10 + (2 * substr(d, (length(d) - j)::BIGINT, 1)::INT) % 10
             END)) % 10 = 0""",
    ),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", "length(d) BETWEEN 9 AND 15"),
    (
        "iban",
        IBANS,
        """NOT (CASE WHEN before = '' THEN i > 1 ELSE regexp_matches(before, '[A-Za-z0-9]$') END)
           AND NOT (CASE WHEN after = '' THEN i < n ELSE regexp_matches(after, '^[A-Za-z0-9]') END)
           AND list_reduce(list_transform(string_split(substr(replace(x, ' ', ''), 5) || substr(replace(x, ' ', ''), 1, 4), ''),
             lambda c: ascii(c) - CASE WHEN ascii(c) < 65 THEN 48 ELSE 55 END),
             lambda r, v: (r * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97, 0) = 1""",
    ),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "NOT regexp_matches(x, '^(000|666|9)|-00-|-0000$') AND alone AND near && ['ssn', 'social', 'security'] AND NOT against"),
    ("tel", r"\(?[0-9]{3,5}\)?[ ./-][0-9]{3,4}[ .-][0-9]{3,4}", f"alone AND near && [{CALLS}] AND NOT against"),
)
MATCHED = " UNION ALL ".join(
    f"SELECT rid, {rank} AS rank, '{kind}' AS kind, regexp_extract_all(t, '{pattern}') AS xs, string_split_regex(t, '{pattern}') AS ps FROM docs"
    for rank, (kind, pattern, _) in enumerate(FOUND)
)
VALID = " ".join(f"WHEN '{kind}' THEN {test}" for kind, _, test in FOUND)
PII = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
matched AS ({MATCHED}),
single AS (
  SELECT rid, rank, kind, unnest(xs) AS x, unnest(ps[1:len(xs)]) AS before, unnest(ps[2:]) AS after,
         generate_subscripts(xs, 1) AS i, len(xs) AS n
  FROM matched WHERE len(xs) > 0
),
placed AS (
  SELECT *, sum(length(before) + length(x)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop,
         regexp_replace(x, '[^0-9]+', '', 'g') AS d,
         string_split_regex(lower(right(before, 40) || ' ' || left(after, 20)), '[^\\p{{L}}]+') AS near,
         near && [{AGAINST}] AS against,
         NOT (CASE WHEN before = '' THEN i > 1 ELSE regexp_matches(before, '[0-9+-]$') END)
           AND NOT (CASE WHEN after = '' THEN i < n ELSE regexp_matches(after, '^[0-9+-]') END) AS alone
  FROM single
),
good AS (
  SELECT rid, rank, kind, (stop - length(x))::BIGINT AS start, stop::BIGINT AS stop
  FROM placed WHERE CASE kind {VALID} END
),
free AS (
  SELECT * FROM good WHERE rank < 5 OR NOT EXISTS (
    SELECT 1 FROM good AS s WHERE s.rid = good.rid AND s.rank < 5 AND s.start < good.stop AND s.stop > good.start)
),
listed AS (
  SELECT rid, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
         string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank) AS spans
  FROM free GROUP BY rid
)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card,
       coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (rid)
"""

# Fixed values of the contract: what is no term, scale and smoothing of the shares.
NO_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SHARE = "1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * v)"
DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{NO_TERM}') AS terms
  FROM documents
),
word AS (SELECT rid, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
held AS (SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY ALL),
bag AS (SELECT DISTINCT lang, source FROM docs),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
bag_total AS (SELECT lang, source, sum(n) AS total FROM held GROUP BY lang, source),
lang_total AS (SELECT lang, sum(n) AS total FROM held GROUP BY lang),
grid AS (
  SELECT bag.lang, bag.source, kept.term, coalesce(held.n, 0) AS n,
         {SHARE.format(n="coalesce(held.n, 0)", total="coalesce(bag_total.total, 0)")} AS p
  FROM bag JOIN kept ON kept.lang = bag.lang JOIN size ON size.lang = bag.lang
  LEFT JOIN bag_total ON bag_total.lang = bag.lang AND bag_total.source = bag.source
  LEFT JOIN held ON held.lang = bag.lang AND held.source = bag.source AND held.term = kept.term
),
whole AS (
  SELECT held.lang, held.term, {SHARE.format(n="sum(held.n)", total="any_value(lang_total.total)").replace("* v", "* any_value(v)")} AS q
  FROM held JOIN size USING (lang) JOIN lang_total USING (lang) GROUP BY held.lang, held.term
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM bag AS a JOIN bag AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM grid AS x JOIN grid AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) AS f ON f.lang = a.lang AND f.source = a.source AND f.other = b.source
),
terms AS (
  SELECT grid.lang, source, grid.term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM grid JOIN whole ON whole.lang = grid.lang AND whole.term = grid.term WHERE n > 0 AND p > q
),
every AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM terms
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM every
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# Sets linked by a self-join, and what each reaches. For small tables: it lists all links.
JACCARD = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS.format(LOWERED.format("coalesce(text, '')"))} AS w FROM documents
),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) END AS s FROM docs
),
held AS (SELECT rid, len(s) AS n, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT a.rid AS a, b.rid AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS same
  FROM held AS a JOIN held AS b ON a.shingle = b.shingle AND a.rid <> b.rid GROUP BY 1, 2
),
links AS (SELECT a, b FROM shared WHERE 100 * same >= 85 * (n + m - same)),
reach AS (SELECT rid AS a, rid AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a AS rid, min(doc_id) AS component_id FROM reach JOIN sets ON reach.b = sets.rid GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN low USING (rid)
"""

# Fixed value: the digits of base 32. Five hexadecimal digits are four of them.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PART = "list_reduce(list_transform(range(5), lambda k: instr('0123456789abcdef', substr(hex, 5 * g + k + 1, 1)) - 1), lambda a, d: a * 16 + d)"
ARCHIVE = f"""
WITH payload AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
),
digits AS (
  SELECT *, list_transform(range(8), lambda g: {PART}) AS parts FROM payload
)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', ((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM digits
"""

SQL = {"op5_warc": ARCHIVE, "op4_jaccard_join": JACCARD, "op6_line_dedup": LINES, "op10_quality": QUALITY, "op11_pii": PII, "op12_divergence": DIVERGENCE}
