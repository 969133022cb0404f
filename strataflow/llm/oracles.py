"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from itertools import permutations

from strataflow.llm import collocations, exact_dedup, filter_audit, mixing, secrets, sharding, url_filter


def _mix_sql(half: str, key: int) -> str:
    """The round function of the permutation on a value below 2**32."""
    a = f"CAST((CAST({half} AS HUGEINT) * {0x9E3779B1} + {key}) % 4294967296 AS BIGINT)"
    b = f"xor({a}, {a} >> 15)"
    c = f"CAST((CAST({b} AS HUGEINT) * {0x85EBCA77}) % 4294967296 AS BIGINT)"
    return f"xor({c}, {c} >> 13)"


def _shard_sql() -> str:
    rounds = "".join(
        f", r{r} AS (SELECT * REPLACE ((b_right + {_mix_sql('a_left', key)}) % b AS b_right) FROM r{r - 1})"
        if r % 2
        else f", r{r} AS (SELECT * REPLACE ((a_left + {_mix_sql('b_right', key)}) % a AS a_left) FROM r{r - 1})"
        for r, key in enumerate(sharding.round_keys(sharding.SEED))
    ).replace("FROM r-1", "FROM split")
    last = sharding.ROUNDS - 1
    return f"""WITH RECURSIVE bytes AS (
  SELECT rowid AS row, doc_id, text, regexp_extract_all(hex(encode(text)), '..') AS hexes
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
steps(i, value) AS (
  SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), list_transform(range(8), lambda x: CAST(0 AS BIGINT))),
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FROM range(256) t(i)),
lookup AS (SELECT list(value ORDER BY i) AS crc FROM steps),
sized AS (
  SELECT row, doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(hexes, lambda h: CAST('0x' || h AS BIGINT))),
      lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])), 4294967295) AS text_crc32
  FROM bytes, lookup),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1 AS n FROM sized),
total AS (SELECT count(*) AS total, greatest(2, CAST(ceil(sqrt(count(*))) AS BIGINT)) AS a FROM documents),
sides AS (SELECT total, a, greatest(2, (total + a - 1) // a) AS b FROM total),
walk(n, x, done) AS (
  SELECT n, n, false FROM numbered
  UNION ALL
  SELECT n, y, y < total FROM (
    WITH split AS (SELECT w.n, s.total, s.a, s.b, w.x % s.a AS a_left, w.x // s.a AS b_right FROM walk w, sides s WHERE NOT w.done)
    {rounds}
    SELECT n, total, b_right * a + a_left AS y FROM r{last})),
places AS (SELECT n, x AS place FROM walk WHERE done)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place % 16 AS INTEGER) AS shard,
  CAST(place // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN places USING (n)"""


def _mixing_sql() -> str:
    rows, total = mixing.BLOCK_ROWS, mixing.WEIGHT_SUM
    return f"""WITH RECURSIVE found AS (
  SELECT coalesce('s' || source, 'n') AS key, count(*) AS n FROM documents GROUP BY 1),
weighed AS (
  SELECT key, n, row_number() OVER (ORDER BY key) AS i, pow(n, {mixing.TEMPER}) AS w, (n + {rows - 1}) // {rows} AS blocks FROM found),
parts AS (
  SELECT key, i, blocks, CAST(greatest(1, round(w / (SELECT fsum(w) FROM weighed) * {total})) AS HUGEINT) AS a FROM weighed),
lists AS (SELECT list(a ORDER BY i) AS a, len(list(a)) AS m, sum(a) AS total FROM parts),
run AS (SELECT max((blocks * total + a - 1) // a) AS slots FROM parts, (SELECT total FROM lists)),
plan(t, source, k, done) AS (
  SELECT CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), list_transform(a, lambda x: CAST(0 AS BIGINT)) FROM lists
  UNION ALL
  SELECT t + 1, pick, done[pick], list_transform(done, lambda d, j: CASE WHEN j = pick THEN d + 1 ELSE d END)
  FROM (
    SELECT t, done, list_min(list_filter(list_transform(range(1, m + 1), lambda j: CASE
        WHEN (done[j] * total) // a[j] <= t + 1
        THEN [CAST(((done[j] + 1) * total + a[j] - 1) // a[j] AS BIGINT), j] END), lambda x: x IS NOT NULL))[2] AS pick
    FROM plan, lists, run WHERE t < slots - 1)),
schedule AS (SELECT t, source AS i, k FROM plan WHERE t >= 0),
placed AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
    row_number() OVER (PARTITION BY coalesce('s' || source, 'n') ORDER BY doc_id NULLS FIRST) - 1 AS index FROM documents)
SELECT doc_id, source, CAST(k // blocks AS BIGINT) AS epoch, CAST(t AS BIGINT) AS slot, CAST(index % {rows} AS INTEGER) AS place
FROM placed JOIN parts USING (key) JOIN schedule s ON s.i = parts.i AND s.k % parts.blocks = index // {rows}"""


def _url_sql() -> str:
    upper, lower = url_filter.UPPER, url_filter.LOWER
    best = "".join(
        f" WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p},{v}'"
        for h, p, v in sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))
    )
    return f"""WITH read AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{upper}', '{lower}') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '^.*?://[^?#]*\\?([^#]*)', 1, 's'), '&'),
      lambda p: p <> '' AND NOT regexp_full_match(p, '{url_filter.TRACKING}'))), '&') AS query
  FROM pages),
named AS (
  SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(host, '^www\\.|:(?:80|443)$', '', 'g')
    || regexp_replace(path, '/+$', '') || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical,
    CASE {best} END AS best
  FROM read),
known AS (SELECT canonical FROM named WHERE regexp_matches(host, '(^|\\.)({"|".join(url_filter.LISTED_SITES)})\\.')),
list AS (SELECT canonical FROM known WHERE left(md5(canonical), 1) < '8' UNION SELECT canonical || '/gone' FROM known),
judged AS (SELECT n.*, l.canonical IS NOT NULL AS listed FROM named n LEFT JOIN list l ON n.canonical = l.canonical)
SELECT page_id, host, path, split_part(best, ',', 1) AS rule,
  coalesce(split_part(best, ',', 2), CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM judged"""


def _secrets_sql() -> str:
    pattern = secrets.ASSIGN.replace("'", "''")
    kinds = (
        (0, "assign", pattern, 2, f"length(value) >= {secrets.ASSIGN_LEAST}"),
        (1, "access", secrets.ACCESS, 0, "true"),
        (2, "hex", secrets.HEX, 0, "true"),
        (3, "short", pattern, 2, f"length(value) BETWEEN {secrets.SHORT_LEAST} AND {secrets.ASSIGN_LEAST - 1}"),
        (4, "mixed", secrets.MIXED, 0, "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')"),
    )
    scans = " UNION ALL ".join(
        f"""SELECT row, doc_id, source, {rank} AS rank, '{kind}' AS kind, start, start + length(whole) AS stop, value FROM (
  SELECT row, doc_id, source, whole, value,
    sum(length(gap)) OVER g + coalesce(sum(length(whole)) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM (SELECT row, doc_id, source, unnest(string_split_regex(text, '{p}')) AS gap,
      unnest(regexp_extract_all(text, '{p}', 0)) AS whole, unnest(regexp_extract_all(text, '{p}', {group})) AS value,
      generate_subscripts(string_split_regex(text, '{p}'), 1) AS i
    FROM numbered WHERE regexp_matches(text, '{p}'))
  WINDOW g AS (PARTITION BY row ORDER BY i)) WHERE whole IS NOT NULL AND {keep}"""
        for rank, kind, p, group, keep in kinds
    )
    return f"""WITH numbered AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents),
spans AS ({scans}),
owners AS (
  SELECT value, count(*) AS owners, sum(n) AS repositories FROM (
    SELECT value, source, count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'none')) AS n FROM spans GROUP BY value, source) GROUP BY value),
told AS (SELECT s.*, owners <= {secrets.LIVE_OWNERS} AND repositories <= {secrets.LIVE_REPOSITORIES} AS live, kind || ':' || start || ':' || stop AS entry
  FROM spans s JOIN owners USING (value)),
per_row AS (
  SELECT row, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    coalesce(string_agg(entry, ',' ORDER BY start, rank) FILTER (WHERE rank < 3), '') AS base,
    coalesce(string_agg(entry, ',' ORDER BY start, rank) FILTER (WHERE rank < 3 OR live), '') AS spans,
    count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_shared
  FROM told GROUP BY row)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  CAST(coalesce(n_live, 0) AS BIGINT) AS n_live, CAST(coalesce(n_shared, 0) AS BIGINT) AS n_shared
FROM numbered LEFT JOIN per_row USING (row)"""


def _phrases_sql() -> str:
    upper, lower, least = exact_dedup.UPPER, exact_dedup.LOWER, collocations.LEAST
    return rf"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
    unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, doc_id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, doc_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM split, range(1, {collocations.LONGEST + 1}) t(m)),
counted AS (
  SELECT lang, m, phrase, count(*) AS f, min(doc_id) AS first_doc FROM grams GROUP BY ALL HAVING count(*) >= {least}),
cuts AS (
  SELECT *, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM counted WHERE m > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.first_doc, c.k, l.f AS l, r.f AS r,
    CAST((CAST({collocations.SCALE} AS HUGEINT) * c.a) // (l.f + r.f) AS BIGINT) AS score
  FROM cuts c JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covers AS (
  SELECT lang, phrase, max(f) AS cover FROM (
    SELECT lang, f, unnest(list_transform(range(1, m - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
    FROM (SELECT lang, f, m, string_split(phrase, ' ') AS w, unnest(range(2, m)) AS s FROM counted WHERE m > 2)) GROUP BY ALL),
ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM weakest w LEFT JOIN covers c ON c.lang = w.lang AND c.phrase = w.phrase
  WHERE cover IS NULL OR CAST(100 AS HUGEINT) * cover < CAST({collocations.COVERED_PERCENT} AS HUGEINT) * a)
SELECT lang, rank, phrase, a, l, r, n, score, first_doc FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.TOP}"""


def _audit_sql() -> str:
    names = filter_audit.FILTERS
    orders = ", ".join(f"('{''.join(p)}')" for p in permutations(names))
    bits = " + ".join(f"CAST({f.lower()} AS INTEGER) * {1 << i}" for i, f in enumerate(names))
    step = "least(" + ", ".join(f"CASE WHEN mask & {1 << i} > 0 THEN strpos(filter_order, '{f}') ELSE 6 END" for i, f in enumerate(names)) + ")"
    return rf"""WITH marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
texts AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
failing AS (
  SELECT part, doc_id, len(w) < {filter_audit.LEAST_WORDS} AS a, 100 * len(list_distinct(w)) < {filter_audit.DISTINCT_PERCENT} * len(w) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {filter_audit.UPPER_PERCENT} * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS e
  FROM texts),
masks AS (
  SELECT part, {bits} AS mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY ALL),
orders(filter_order) AS (VALUES {orders}),
steps AS (SELECT *, {step} AS gone FROM masks, orders),
cells AS (
  SELECT part, filter_order, i AS step, 1 << (ascii(filter_order[i]) - 65) AS bit
  FROM (SELECT DISTINCT part FROM masks), orders, range(1, 6) t(i)),
told AS (
  SELECT c.part, c.filter_order, CAST(c.step AS INTEGER) AS step, any_value(bit) AS bit,
    sum(n) FILTER (WHERE gone > c.step) AS kept, sum(n) FILTER (WHERE gone = c.step) AS removed,
    sum(n) FILTER (WHERE gone < c.step AND mask & bit > 0) AS redundant, sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(good) FILTER (WHERE gone = c.step) AS good_lost, sum(toxic) FILTER (WHERE gone = c.step) AS toxic_lost
  FROM cells c JOIN steps s ON s.part = c.part AND s.filter_order = c.filter_order GROUP BY ALL)
SELECT part, filter_order, step, {", ".join(f"CAST(coalesce({m}, 0) AS BIGINT) AS {m}" for m in filter_audit.MEASURES[:-1])},
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told"""


def _dedup_sql() -> str:
    return f"""WITH read AS (
  SELECT doc_id, translate(coalesce(text, ''), '{exact_dedup.UPPER}', '{exact_dedup.LOWER}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM read"""


SHARD_SQL, MIX_SQL, URL_SQL, SECRETS_SQL = _shard_sql(), _mixing_sql(), _url_sql(), _secrets_sql()
PHRASES_SQL, AUDIT_SQL, DEDUP_SQL = _phrases_sql(), _audit_sql(), _dedup_sql()
