"""DuckDB SQL for those training-data queries that SQL can express, written from the definitions."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, [word FOR word IN string_split_regex(piece, '[\\x20\\x09]+') IF word <> ''] AS held FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(held)) AS BIGINT) AS n FROM words GROUP BY lang
), grams AS (
  SELECT lang, k, held[i:i + k - 1] AS gram
  FROM (SELECT lang, held, k, unnest(range(1, len(held) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) sizes)
), f AS (
  SELECT lang, k, gram, count(*) AS a FROM grams GROUP BY lang, k, gram
), candidates AS (
  SELECT * FROM f WHERE k > 1 AND a >= 30
), inner_parts AS (
  SELECT lang, a, gram[i:i + size - 1] AS part
  FROM (SELECT lang, a, k, gram, size, unnest(range(1, k - size + 2)) AS i
        FROM (SELECT lang, a, k, gram, unnest(range(2, k)) AS size FROM candidates) sized) placed
), around AS (
  SELECT lang, part, max(a) AS around FROM inner_parts GROUP BY lang, part
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN around o ON c.lang = o.lang AND c.gram = o.part
  WHERE o.around IS NULL OR CAST(100 AS HUGEINT) * o.around < CAST(80 AS HUGEINT) * c.a
), cuts AS (
  SELECT lang, gram, a, k, unnest(range(1, k)) AS cut FROM kept
), scored AS (
  SELECT c.lang, c.gram, c.a, c.cut, x.a AS l, y.a AS r, CAST(2000000 AS HUGEINT) * c.a // (CAST(x.a AS HUGEINT) + y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.gram = c.gram[1:c.cut]
  JOIN f y ON y.lang = c.lang AND y.gram = c.gram[c.cut + 1:c.k]
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, array_to_string(gram, ' ') AS phrase FROM best
)
SELECT r.lang, row_number() OVER (PARTITION BY r.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM ranked r JOIN totals t ON r.lang = t.lang
QUALIFY row_number() OVER (PARTITION BY r.lang ORDER BY score DESC, a DESC, phrase) <= 2000"""

FILL_MIDDLE = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), numbers AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         [CAST('0x' || substr(digest, 8 * g + 1, 8) AS BIGINT) FOR g IN range(0, 4)] AS h
  FROM texts
), placed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h[3] % 100 >= 100
              THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS prefix,
         coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
         coalesce(array_to_string(units[high + 1:n], ''), '') AS suffix
  FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE body END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts"""
