"""The same results as DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from .quality_limits import RULES

OP1 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""


def _spans(kind: str, at: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
SELECT doc_id, s.start_at, {at} AS kind_at, '{kind}:' || s.start_at || ':' || s.end_at AS spelled
FROM (
  SELECT doc_id, unnest(list_transform(range(1, len(w) + 1), lambda i: {{
      'start_at': list_sum(list_transform(p[1:i], lambda x: length(x)))::BIGINT
                  + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0)::BIGINT,
      'end_at': list_sum(list_transform(p[1:i], lambda x: length(x)))::BIGINT
                + list_sum(list_transform(w[1:i], lambda x: length(x)))::BIGINT,
      'counted': length(g[i])}})) AS s
  FROM (
    SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS w, regexp_extract_all(t, '{p}', {group}) AS g,
           string_split_regex(t, '{p}') AS p
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
  )
)
WHERE s.counted >= {least}"""


#: Letters in either case are spelled out, so that no letter outside ASCII folds into one of them.
def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = (
    "(" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)

OP4 = f"""
WITH f AS (
{_spans("assign", 0, ASSIGN, 2, 8)}
UNION ALL
{_spans("access", 1, "AKIA[A-Z0-9]{12,}", 0, 16)}
UNION ALL
{_spans("hex", 2, "[0-9a-f]{32,}", 0, 32)}
),
s AS (
  SELECT doc_id, count(*) FILTER (kind_at = 0) AS n_assign, count(*) FILTER (kind_at = 1) AS n_access,
         count(*) FILTER (kind_at = 2) AS n_hex,
         string_agg(spelled, ',' ORDER BY start_at, kind_at) AS spans
  FROM f GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM documents d LEFT JOIN s USING (doc_id)
"""


def _race(key: str, prefix: str, children: dict[str, float]) -> str:
    if len(children) == 1:
        return f"'{next(iter(children))}'"
    draws = ", ".join(
        f"{{'draw': -ln((('0x' || substr(md5('{prefix}/{n}|' || {key}), 1, 13))::BIGINT::DOUBLE + 0.5)"
        f" / {float(16**13)!r}::DOUBLE) / {w!r}::DOUBLE, 'name': '{n}'}}"
        for n, w in sorted(children.items())
    )
    return f"list_sort([{draws}])[1].name"


def _descend(regions: dict[str, dict[str, dict[str, float]]], key: str = "k") -> str:
    """A tree as nested mapping region -> rack -> shard -> weight."""
    weight = lambda racks: sum(sum(s.values()) for s in racks.values())
    region = _race(key, "", {r: weight(racks) for r, racks in regions.items()})
    cases = []
    for r, racks in regions.items():
        rack = _race(key, r, {n: sum(s.values()) for n, s in racks.items()})
        inner = " ".join(f"WHEN '{n}' THEN {_race(key, f'{r}/{n}', s)}" for n, s in racks.items())
        cases.append(f"WHEN '{r}' THEN CASE {rack} {inner} END")
    return f"CASE {region} {' '.join(cases)} END::INTEGER"


EIGHT = {
    "region0": {"rack0": {"0": 1.0, "1": 1.0}, "rack1": {"2": 1.0, "3": 1.0}},
    "region1": {"rack0": {"4": 1.0, "5": 1.0}, "rack1": {"6": 1.0, "7": 1.0}},
}
NINE = EIGHT | {"region-of-8": {"rack0": {"8": 1.0}}}

OP9 = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
           list_prepend(b::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
),
d AS (
  SELECT doc_id, doc_id::VARCHAR AS k, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h
  FROM documents
),
s AS (
  SELECT doc_id, strlen(t) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(t)),
                 lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32,
         {_descend(EIGHT)} AS shard, {_descend(NINE)} AS grown_shard
  FROM d, crc
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
       grown_shard
FROM s
"""


#: White space of any script; a line of nothing else is blank.
_INK = r"[^\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

OP7 = f"""
WITH l AS (
  SELECT doc_id, t, unnest(string_split(t, chr(10))) AS line,
         generate_subscripts(string_split(t, chr(10)), 1) - 1 AS line_at
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
),
w AS (
  SELECT doc_id, md5(t) AS h, line_at, list_filter(string_split(line, ' '), lambda x: x <> '') AS tokens
  FROM l WHERE regexp_matches(line, '{_INK}')
),
n AS MATERIALIZED (
  SELECT *, len(tokens) AS size,
         list_transform(tokens[1:3], lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS lead
  FROM w WHERE len(tokens) > 0
),
levels(least, tokens_from, percent) AS (VALUES (10, 1, 60), (5, 8, 80), (3, 20, 90), (2, 50, 90)),
cells AS MATERIALIZED (
  SELECT * FROM (
    SELECT size, lead, doc_id, h, line_at, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS place
    FROM n
  ) WHERE NOT regexp_matches(token, '[0-9]')
),
constants AS (
  SELECT size, lead, place, token, count(DISTINCT h) AS texts FROM cells
  GROUP BY size, lead, place, token HAVING texts >= 2
),
held AS (
  SELECT size, lead, doc_id, h, line_at, least, any_value(percent) AS percent, count(*) AS n,
         string_agg(place || ' ' || token, ' ' ORDER BY place) AS pattern
  FROM cells JOIN constants USING (size, lead, place, token)
       JOIN levels ON texts >= least AND size >= tokens_from
  GROUP BY size, lead, doc_id, h, line_at, least
),
lined AS (
  SELECT size, lead, doc_id, h, line_at, least, 'constants' AS kind, pattern
  FROM held WHERE n * 100 >= size * percent
  UNION ALL
  SELECT size, lead, doc_id, h, line_at, (SELECT min(least) FROM levels WHERE size >= tokens_from),
         'whole', array_to_string(tokens, ' ')
  FROM n WHERE len(list_filter(tokens, lambda x: regexp_matches(x, '[0-9]'))) > 0
),
common AS (
  SELECT size, lead, least, kind, pattern, min((doc_id, line_at)) AS first FROM lined
  GROUP BY size, lead, least, kind, pattern HAVING count(DISTINCT h) >= least
),
dropped AS (
  SELECT DISTINCT doc_id, line_at FROM lined JOIN common USING (size, lead, least, kind, pattern)
  WHERE (doc_id, line_at) <> first
)
SELECT l.doc_id, count(*) AS n_lines, count(dropped.line_at) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY l.line_at) FILTER (dropped.line_at IS NULL), '') AS text
FROM l LEFT JOIN dropped ON l.doc_id = dropped.doc_id AND l.line_at = dropped.line_at
GROUP BY l.doc_id
"""


FINITE = """embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

OP11 = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND {FINITE}
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def _codebook_round(r: int) -> str:
    """Assignment ``a{r}`` to the entries ``c{r}``, and the entries after it."""
    return f"""
a{r} AS MATERIALIZED (
  SELECT row_id, part, any_value(p.v) AS v, min((d, entry)) AS best
  FROM (
    SELECT row_id, p.part, p.v, entry,
           list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM p JOIN c{r} c USING (part)
  ) p GROUP BY row_id, part
),
m{r} AS (
  SELECT part, entry, list((t - ((t % n) + n) % n) // n ORDER BY place) AS v
  FROM (
    SELECT part, entry, place, sum(x)::BIGINT AS t, count(*) AS n
    FROM (SELECT part, best[2] AS entry, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{r})
    GROUP BY part, entry, place
  ) GROUP BY part, entry
),
c{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (part, entry)
)"""


OP12 = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row_id, vec_id, label,
         list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE {FINITE}
),
p AS MATERIALIZED (
  SELECT row_id, part, q[part * (len(q) // 8) + 1: (part + 1) * (len(q) // 8)] AS v
  FROM (SELECT row_id, q, unnest(range(8)) AS part FROM e)
),
c0 AS MATERIALIZED (SELECT part, row_id - 1 AS entry, v FROM p WHERE row_id <= 16),
{",".join(_codebook_round(r) for r in range(7))},
books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM c6
),
coded AS (
  SELECT row_id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code,
         sum(best[1])::BIGINT AS error
  FROM a6 GROUP BY row_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       codebooks_sha256
FROM coded JOIN e USING (row_id), books
"""

_CUTOFFS = " UNION ALL ".join(
    f"SELECT '{r.name}' AS rule, unnest({list(r.cutoffs)})::DOUBLE AS cutoff, "
    f"unnest(range({len(r.cutoffs)})) AS step" for r in RULES
)
_SIGNALS = " UNION ALL ".join(
    f"SELECT row_id, lang, h, base_failed, '{r.name}' AS rule, "
    f"coalesce({' / nullif('.join(r.signal.split(' / '))}, 0), 0) AS signal FROM counted"
    for r in RULES
)
RISK, ERROR = f"(0.02 / {len(RULES)})", "(1 - 0.95)"

OP13 = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT *, md5(t) AS h, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d
),
shingles AS (
  SELECT row_id, unnest(range(1, len(words) - 3)) AS place,
         unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS s
  FROM w WHERE len(words) >= 5
),
again AS (SELECT row_id, s FROM shingles GROUP BY row_id, s HAVING count(*) > 1),
covered AS (
  SELECT row_id, count(DISTINCT word) AS n
  FROM (SELECT row_id, unnest(range(place, place + 5)) AS word FROM shingles SEMI JOIN again USING (row_id, s))
  GROUP BY row_id
),
counts AS (
  SELECT row_id, doc_id, lang, h, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (row_id)
),
counted AS MATERIALIZED (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
),
signals AS MATERIALIZED ({_SIGNALS}),
marks AS (
  SELECT row_id, bool_and(quality = 1) AS good
  FROM counted JOIN labels USING (doc_id) WHERE quality IN (0, 1) GROUP BY row_id
),
texts AS (
  SELECT lang, h, rule, any_value(signal) AS signal, bool_and(good) AS good
  FROM signals JOIN marks USING (row_id) WHERE NOT base_failed GROUP BY lang, h, rule
),
sizes AS (
  SELECT lang, count(*) FILTER (good) AS n FROM texts WHERE rule = '{RULES[0].name}' GROUP BY lang
),
upto AS (
  SELECT lang, n, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK})
                             + (n - i) * ln(1 - {RISK}))) OVER (PARTITION BY lang ORDER BY i) AS risk
  FROM (SELECT lang, n, unnest(range(0, ceil(n * {RISK})::BIGINT + 1)) AS i FROM sizes WHERE n > 0)
),
allowed AS (
  SELECT lang, max(i) AS allowed FROM upto
  WHERE risk <= {ERROR} / ((SELECT count(*) FROM sizes) * {len(RULES)}) GROUP BY lang
),
tried AS (
  SELECT texts.lang, rule, step, cutoff, count(*) FILTER (good AND signal > cutoff) AS lost,
         count(*) FILTER (NOT good AND signal > cutoff) AS gained
  FROM texts JOIN ({_CUTOFFS}) USING (rule) GROUP BY ALL
),
chosen AS (
  SELECT tried.lang, rule, cutoff FROM tried
  JOIN allowed ON tried.lang IS NOT DISTINCT FROM allowed.lang
  WHERE lost <= allowed AND gained > 0
  QUALIFY row_number() OVER (PARTITION BY tried.lang, rule ORDER BY gained DESC, step) = 1
),
failed AS (
  SELECT row_id, list(signals.rule) AS rules
  FROM signals JOIN chosen ON signals.rule = chosen.rule AND signals.lang IS NOT DISTINCT FROM chosen.lang
  WHERE signal > cutoff GROUP BY row_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rules IS NULL AS kept,
       coalesce(array_to_string(list_filter({[r.name for r in RULES]}, lambda r: list_contains(rules, r)), ','), '')
         AS failed_rules
FROM counted LEFT JOIN failed USING (row_id)
"""


def statements() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1,
        "op4_secret_scan": OP4,
        "op7_line_templates": OP7,
        "op9_hash_tree_shards": OP9,
        "op11_vertical_hard_negatives": OP11,
        "op12_walsh_vector_codes": OP12,
        "op13_certified_quality": OP13,
    }
