"""The text queries that SQL expresses, for an independent engine."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = (
    f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# CRC-32 of each different word: its table by the rule of the polynomial, then byte after byte.
RESAMPLING = f"""
WITH crc AS (
  SELECT [list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                      k::bigint) FOR k IN range(256)] AS tab),
docs AS (SELECT doc_id, coalesce({_TERMS}, []) AS words FROM documents),
used AS (
  SELECT 's' AS side, unnest(words) AS word FROM docs
  UNION ALL SELECT 't' AS side, unnest(coalesce({_TERMS}, [])) AS word FROM benchmark),
hashed AS (
  SELECT word, xor(list_reduce(
    [('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::bigint FOR i IN range(octet_length(encode(word)))],
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM used), crc),
counts AS (
  SELECT bucket, count_if(side = 's') AS s, count_if(side = 't') AS t FROM used JOIN hashed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, cast(floor(1000 * ln((t + 1)::double * (ss + 10000)::double / ((s + 1)::double * (tt + 10000)::double)))
    AS bigint) AS gain
  FROM counts, (SELECT sum(s) AS ss, sum(t) AS tt FROM counts)),
weights AS (
  SELECT doc_id, count(word) AS n_features, coalesce(sum(gain), 0) AS weight
  FROM (SELECT row_number() OVER () AS r, doc_id, unnest(CASE WHEN len(words) = 0 THEN [NULL] ELSE words END) AS word
        FROM docs) LEFT JOIN hashed USING (word) LEFT JOIN gains USING (bucket)
  GROUP BY r, doc_id),
scored AS (
  SELECT doc_id, n_features, cast(weight AS bigint) AS weight, cast(weight + floor(-1000 * ln(-ln(
    (('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint::double + 0.5) / 4294967296.0::double
  ))) AS bigint) AS score FROM weights),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank, n_features AS n_words
FROM ranked"""

SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents),
lengths AS (SELECT r, doc_id, cast(len(words) AS bigint) AS n FROM docs WHERE len(words) > 0),
totals AS (SELECT count(*) AS nn, cast(sum(n) AS bigint) AS ll FROM lengths),
asked AS (
  SELECT q, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS q, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
found AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, cast(floor(1000 * ln((2.0::double * nn + 2) / (2 * df + 1))) AS bigint) AS w
  FROM (SELECT term, count(*) AS df FROM found GROUP BY term), totals),
scores AS (
  SELECT q, item_id, doc_id, cast(sum(
    times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS bigint) AS score
  FROM asked JOIN found USING (term) JOIN weights USING (term) JOIN lengths USING (r), totals
  GROUP BY q, item_id, r, doc_id)
SELECT item_id, cast(rank AS integer) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20"""

TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, cast(rank AS integer) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, d.vec_id, cast(list_inner_product(q.e, d.e) AS bigint) AS score
    FROM vectors q JOIN vectors d ON d.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0))
WHERE rank <= 20"""
