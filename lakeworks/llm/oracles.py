"""SQL over the same tables for the operators that SQL can express."""

from __future__ import annotations

#: The eight-digit groups of a key's digest, as numbers.
_GROUPS = ", ".join(f"('0x' || substr(d, {8 * g + 1}, 8))::BIGINT AS h{g + 1}" for g in range(4))

FILL_IN_MIDDLE = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id::VARCHAR) AS d,
         regexp_extract_all(coalesce(text, ''), E'[^\\n]*\\n|[^\\n]+') AS units
  FROM documents
), numbers AS (
  SELECT *, len(units)::BIGINT AS n, {_GROUPS} FROM hashed
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form != 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form != 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: One step of a CRC-32 for each zero bit behind a byte.
_BITS = "list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"

RESAMPLING = f"""
WITH corpus AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents
), target AS (
  SELECT regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark
), used AS MATERIALIZED (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM corpus
), wanted AS MATERIALIZED (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM target
), bits AS (SELECT {_BITS} AS t
), hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen(f) + 1), lambda i: ('0x' || substr(hex(f), 2 * i - 1, 2))::BIGINT)),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT f FROM used UNION SELECT f FROM wanted), bits
), of_corpus AS (SELECT bucket, count(*) AS s FROM used JOIN hashed USING (f) GROUP BY bucket
), of_target AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (f) GROUP BY bucket
), gain AS (
  SELECT r.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM used) + 10000)
                              / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000)))) AS g
  FROM (SELECT unnest(range(10000)) AS bucket) r LEFT JOIN of_corpus c USING (bucket) LEFT JOIN of_target USING (bucket)
), weight AS (
  SELECT doc_id, count(*) AS n, floor(sum(g) / count(*))::BIGINT AS weight
  FROM used JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM corpus LEFT JOIN weight USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM placed
"""

DECONTAMINATION = f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k,
         unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS g
  FROM items WHERE len(w) > 0
), runs AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
), hits AS MATERIALIZED (
  SELECT doc_id, i, k, item_id FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM runs) JOIN windows USING (k, g)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
