"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from parcelwise.llm.collocations import BEST as BEST_PHRASES
from parcelwise.llm.collocations import COVERED, MIN_COUNT
from parcelwise.llm.quality import GAMMA, MIN_GROUP, RATIOS, REACH, ZERO
from parcelwise.llm.sharding import BUCKETS, PRIME, ROUNDS, round_keys
from parcelwise.llm.termsearch import BEST as BEST_DOCUMENTS

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _network(total_rounds: int, seed: int) -> str:
    """A chain of subqueries: one round of the permutation each, over the pair (l, r)."""
    steps = []
    for i, (k1, k2) in enumerate(round_keys(seed, total_rounds)):
        other, own, size = ("r", "l", "a") if i % 2 == 0 else ("l", "r", "b")
        once = f"(({other} + {k1}) % {PRIME})"
        twice = f"(({once} * {once} + {k2}) % {PRIME})"
        mixed = f"({own} + {twice} * {twice} % {PRIME}) % {size}"
        pair = f"{mixed} AS l, r" if own == "l" else f"l, {mixed} AS r"
        source = "start" if i == 0 else f"round{i - 1}"
        steps.append(f"round{i} AS (SELECT n, step, a, b, total, {pair} FROM {source})")
    return ", ".join(steps)


# Row numbers by (bucket of the digest, columns), then as many walks of the network as numbers lie beyond the last row.
_OP1 = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
sized AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table),
digests AS (
  SELECT *, CAST('0x' || substr(md5(coalesce('=' || doc_id, '-') || '|=' || size || '|=' || text_crc32), 1, 7) AS BIGINT)
    % {BUCKETS} AS bucket FROM sized),
numbers AS (
  SELECT doc_id, size, text_crc32, count(*) OVER () AS total,
    row_number() OVER (ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS n FROM digests),
sides AS (SELECT *, CAST(greatest(ceil(sqrt(total)), 1) AS BIGINT) AS a FROM numbers),
grid AS (SELECT *, greatest((total + a - 1) // a, 1) AS b FROM sides),
walk AS (
  SELECT n, 0 AS step, a, b, total, n AS place FROM grid
  UNION ALL
  SELECT n, step, a, b, total, l * b + r AS place FROM (
    WITH start AS (SELECT n, step + 1 AS step, a, b, total, place // b AS l, place % b AS r FROM walk
      WHERE step = 0 OR place >= total), {_network(ROUNDS, 20)}
    SELECT * FROM round{ROUNDS - 1}) moved),
places AS (SELECT n, place FROM walk WHERE step > 0 AND place < total)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place % 8 AS INTEGER) AS shard, place // 8 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM grid JOIN places USING (n)
"""

_OP6 = f"""
WITH doc_words AS (
  SELECT row_number() OVER () AS d, doc_id, text,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
places AS (
  SELECT d, size, pos, array_to_string(w[pos : pos + size - 1], ' ') AS phrase
  FROM (SELECT d, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM doc_words, (SELECT DISTINCT size FROM windows)
    WHERE len(w) >= size)),
found AS (SELECT d, item_id, pos, places.size AS size FROM places JOIN windows USING (phrase, size)),
places_hit AS (SELECT DISTINCT d, p FROM (SELECT d, unnest(range(pos, pos + size)) AS p FROM found)),
hits AS (SELECT d, count(*) AS n_hit FROM places_hit GROUP BY d),
-- Every word with what stands before it, whose lengths add up to the word's end.
chunks AS (
  SELECT d, unnest(c) AS chunk, unnest(range(1, len(c) + 1)) AS p
  FROM (SELECT d, regexp_extract_all(text, '{BETWEEN}*{TERM}') AS c FROM doc_words WHERE d IN (SELECT d FROM hits))),
ends AS (
  SELECT d, p, CAST(sum(length(chunk)) OVER (PARTITION BY d ORDER BY p) AS BIGINT) AS stop, length(regexp_extract(chunk, '{TERM}')) AS size
  FROM chunks),
islands AS (
  SELECT d, p, p - row_number() OVER (PARTITION BY d ORDER BY p) AS island FROM places_hit),
span_rows AS (SELECT d, min(stop - size) AS a, max(stop) AS b FROM islands JOIN ends USING (d, p) GROUP BY d, island),
spans AS (SELECT d, count(*) AS n_spans, string_agg(a || ':' || b, ',' ORDER BY a) AS listed FROM span_rows GROUP BY d),
items AS (
  SELECT d, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT d, coalesce(CAST(item_id AS VARCHAR), 'null') AS item FROM found) GROUP BY d)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), FALSE) AS contaminated,
  coalesce(n_spans, 0) AS n_spans, sha256(coalesce(listed, '')) AS spans_sha256
FROM doc_words LEFT JOIN hits USING (d) LEFT JOIN items USING (d) LEFT JOIN spans USING (d)
"""


def _bound(name: str, least: float, two_sided: bool) -> str:
    spread = f"{REACH} * greatest(q3 - q1, {least})"
    out = f"max(CASE WHEN ratio = '{name}' THEN q3 + {spread} END) AS high_{name}"
    return out + (f", max(CASE WHEN ratio = '{name}' THEN q1 - {spread} END) AS low_{name}" if two_sided else "")


def _quartiles(name: str, keys: str) -> str:
    """Quartiles of the merged sketches at one level."""
    lead = f"{keys}, " if keys else ""
    return f"""
{name}_sketch AS (SELECT {lead}ratio, bucket, sum(n) AS n FROM sketch GROUP BY {lead}ratio, bucket),
{name}_placed AS (
  SELECT *, sum(n) OVER (PARTITION BY {lead}ratio ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {lead}ratio) AS total,
    CASE WHEN bucket = {ZERO} THEN 0.0 ELSE pow({GAMMA}, bucket + 0.5) END AS middle FROM {name}_sketch),
{name} AS (
  SELECT {lead}ratio, max(total) AS size, min(CASE WHEN upto * 4 >= total THEN middle END) AS q1,
    min(CASE WHEN upto * 4 >= total * 3 THEN middle END) AS q3 FROM {name}_placed GROUP BY {lead}ratio)"""


_OP2 = rf"""
WITH base AS (
  SELECT row_number() OVER () AS d, doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ 	-
]')) AS lines
  FROM documents),
grams AS (
  SELECT d, i, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT d, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
covered AS (
  SELECT d, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT d, unnest([i, i + 1, i + 2]) AS p FROM (SELECT d, i, count(*) OVER (PARTITION BY d, g) AS k FROM grams) WHERE k > 1)
  GROUP BY d),
measured AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines FROM base LEFT JOIN covered USING (d)),
rows_ AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    word_chars / greatest(n_words, 1) AS word_length, n_symbols / greatest(n_words, 1) AS symbols_per_word,
    n_dup_lines / greatest(n_lines, 1) AS dup_lines, n_repeat_words / greatest(n_words, 1) AS repeat_words FROM measured),
sketch AS (
  SELECT lang, source, ratio, CASE WHEN value <= 0 THEN {ZERO} ELSE CAST(floor(ln(value) / ln({GAMMA})) AS INTEGER) END AS bucket,
    count(*) AS n
  FROM (UNPIVOT (SELECT lang, source, word_length, symbols_per_word, dup_lines, repeat_words FROM rows_ WHERE NOT base_failed)
        ON word_length, symbols_per_word, dup_lines, repeat_words INTO NAME ratio VALUE value)
  GROUP BY ALL),
{_quartiles("own", "lang, source")},
{_quartiles("by_lang", "lang")},
{_quartiles("overall", "")},
chosen AS (
  SELECT o.lang, o.source, o.ratio,
    CASE WHEN o.size >= {MIN_GROUP} THEN o.q1 WHEN l.size >= {MIN_GROUP} THEN l.q1 ELSE a.q1 END AS q1,
    CASE WHEN o.size >= {MIN_GROUP} THEN o.q3 WHEN l.size >= {MIN_GROUP} THEN l.q3 ELSE a.q3 END AS q3
  FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.ratio = l.ratio JOIN overall a ON a.ratio = o.ratio),
bounds AS (SELECT lang, source, {", ".join(_bound(n, *x) for n, x in RATIOS.items())} FROM chosen GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce(NOT base_failed AND word_length BETWEEN low_word_length AND high_word_length
    AND symbols_per_word <= high_symbols_per_word AND dup_lines <= high_dup_lines AND repeat_words <= high_repeat_words, FALSE) AS kept
FROM rows_ r LEFT JOIN bounds b ON r.lang IS NOT DISTINCT FROM b.lang AND r.source IS NOT DISTINCT FROM b.source
"""

_OP4 = """
WITH said AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS body FROM conversations),
present AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
segments AS (
  SELECT s.*, perspective,
    CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role,
    '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
      ELSE 'user name=' || speaker END || chr(10) AS header, '<|im_end|>' || chr(10) AS tail
  FROM said s JOIN present p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, row_number() OVER w - 1 AS position, length(header || body || tail) AS chars,
    CAST(sum(length(header || body || tail)) OVER w AS BIGINT) AS "end"
  FROM segments WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, body ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, position, turn, speaker, role, header || body || tail AS segment, "end" - chars AS start, "end",
  CASE WHEN role = 'assistant' THEN "end" - chars + length(header) END AS train_start,
  CASE WHEN role = 'assistant' THEN "end" - 1 END AS train_end
FROM placed
"""

# Every score of every document with a term of the item, then the first ones.
_OP11 = rf"""
WITH listed AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}') AS w
  FROM documents),
docs AS (SELECT d, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM listed WHERE len(w) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
items AS (SELECT row_number() OVER () AS i, * FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (
  SELECT i, item_id, term, CAST(count(*) AS BIGINT) AS times FROM (
    SELECT i, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term FROM items)
  GROUP BY ALL),
held AS (
  SELECT d, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT d, doc_id, n, unnest(w) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM held, corpus GROUP BY term, n_docs),
scores AS (
  SELECT i, item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), corpus GROUP BY i, item_id, d, doc_id),
ranks AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= {BEST_DOCUMENTS}
"""

_OP12 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
split_ AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
counts AS (
  SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
    FROM split_, (SELECT unnest(range(1, 4)) AS k))
  GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= {MIN_COUNT}),
parts AS (
  SELECT lang, k, phrase, a, place, array_to_string(w[1 : place], ' ') AS head, array_to_string(w[place + 1 :], ' ') AS tail
  FROM often, (SELECT unnest([1, 2]) AS place) WHERE place < k),
cuts AS (
  SELECT p.lang, p.k, p.phrase, p.a, p.place, l.f AS l, r.f AS r,
    CAST((1000000::HUGEINT * p.a * p.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM parts p JOIN counts l ON l.lang = p.lang AND l.phrase = p.head JOIN counts r ON r.lang = p.lang AND r.phrase = p.tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[place : place + 1], ' ') AS phrase, max(a) AS longest
  FROM often, (SELECT unnest([1, 2]) AS place) WHERE k = 3 GROUP BY ALL),
ranks AS (
  SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, o.phrase) AS rank
  FROM lowest o LEFT JOIN inner_ i ON i.lang = o.lang AND i.phrase = o.phrase AND o.k = 2
  WHERE i.longest IS NULL OR 100 * i.longest < {COVERED} * o.a)
SELECT lang, rank, phrase, a, l, r, n, score, k AS words FROM ranks JOIN totals USING (lang) WHERE rank <= {BEST_PHRASES}
"""

ORACLE_SQL: dict[str, str] = {
    "op1_sharding": _OP1,
    "op2_quality": _OP2,
    "op4_perspectives": _OP4,
    "op6_fmindex": _OP6,
    "op11_termsearch": _OP11,
    "op12_collocations": _OP12,
}
