"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of ASCII letters, digits and what lies beyond ASCII, A-Z lower-cased.
_LETTER_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3"""

# CRC-32 byte by byte, each distinct run once.
RESAMPLING = f"""
WITH step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda s, i:
           CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END, b)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, {_LETTER_WORDS} AS w FROM documents),
b AS (SELECT {_LETTER_WORDS} AS w FROM benchmark),
run AS (
  SELECT r, array_to_string(w[i : i + k - 1], ' ') AS f
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM (SELECT r, w, unnest([1, 2, 3]) AS k
              FROM (SELECT r, w FROM d UNION ALL SELECT NULL, w FROM b)))),
hashed AS (
  SELECT f, xor(list_reduce(
      list_transform(range(0, strlen(f)), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM run), step),
n AS (
  SELECT bucket, count(r) AS s, count(*) - count(r) AS t FROM run JOIN hashed USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE
           / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE)))::BIGINT AS gain FROM n),
weighed AS (
  SELECT r, sum(gain)::BIGINT AS weight, count(*) AS n_features
  FROM run JOIN hashed USING (f) JOIN gain USING (bucket) WHERE r IS NOT NULL GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
         coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE
           / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weighed USING (r)),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)"""


# Windows of a document are looked up by their text, for every length that an item has.
DECONTAMINATION = f"""
WITH item AS (
  SELECT row_number() OVER () AS item, name, w
  FROM (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS name, text, {_LETTER_WORDS} AS w FROM benchmark)
  WHERE len(w) > 0),
cut AS (
  SELECT item, name, least(len(w), 10) AS n, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item),
wanted AS (SELECT DISTINCT item, name, n, array_to_string(w[i : i + n - 1], ' ') AS f FROM cut),
d AS (SELECT row_number() OVER () AS r, doc_id, {_LETTER_WORDS} AS w FROM documents),
place AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS f
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM wanted))),
hit AS (SELECT r, item, name, i, n FROM place JOIN wanted USING (n, f)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, item, name FROM hit) GROUP BY r),
token AS (SELECT r, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
often AS (SELECT t, count(*) AS c FROM token GROUP BY t),
rarest AS (
  SELECT item, name, f, first(t ORDER BY c, t) AS t
  FROM (SELECT item, name, f, unnest(list_distinct(string_split(f, ' '))) AS t FROM wanted) LEFT JOIN often USING (t)
  GROUP BY item, name, f HAVING count(*) = count(c)),
near_hit AS (
  SELECT DISTINCT r, item, name FROM rarest JOIN token USING (t) JOIN d USING (r)
  WHERE len(list_filter(string_split(f, ' '),
                        lambda x: NOT list_contains(w[greatest(p - 15, 1) : p + 15], x))) = 0),
close AS (
  SELECT r, count(*) AS n_near_items, string_agg(name, ',' ORDER BY name) AS near_names FROM near_hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near_items, 0)::BIGINT AS n_near_items, sha256(coalesce(near_names, '')) AS near_items_sha256
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r) LEFT JOIN close USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_decontamination": DECONTAMINATION,
        "op12_hard_negatives": HARD_NEGATIVES,
        "op13_resampling": RESAMPLING,
    }
