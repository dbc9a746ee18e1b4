"""DuckDB SQL of the training-data queries that SQL can express, by other ways than the operators'."""

from __future__ import annotations

# crc32 bit by bit: a byte is xored in, then eight shifts (marked -1) follow.
OP11 = """
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[a-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents)
  GROUP BY doc_id, run),
points AS (
  SELECT doc_id, run, n, list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                                        lambda c: unicode(c)) AS p FROM runs),
bits AS (
  SELECT doc_id, run, n, flatten(list_transform(p, lambda c: CASE WHEN c < 128
      THEN [c::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
      ELSE [192 + (c::BIGINT >> 6), -1, -1, -1, -1, -1, -1, -1, -1,
            128 + (c::BIGINT & 63), -1, -1, -1, -1, -1, -1, -1, -1] END)) AS b FROM points),
hashed AS (
  SELECT doc_id, run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x:
      CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h FROM bits),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0
          THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
          ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gone AS (
  SELECT word, n, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
inserted AS (
  SELECT DISTINCT gone.word AS a, gone.n AS na, w.word AS b, w.n AS nb
  FROM gone JOIN words w ON w.word = gone.head || gone.tail),
near AS (
  SELECT a AS word, b AS other, nb AS m FROM inserted
  UNION ALL SELECT b, a, na FROM inserted
  UNION ALL SELECT x.word, y.word, y.n FROM gone x JOIN gone y
    ON x.head = y.head AND x.tail = y.tail AND x.word <> y.word),
best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
formed AS (
  SELECT w.word, CASE WHEN b.m >= 2 * w.n THEN
      (SELECT min(o.other) FROM near o WHERE o.word = w.word AND o.m = b.m) END AS form,
    w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL),
ends AS (
  SELECT c.word, c.at FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NULL)
SELECT f.word, f.form, e.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM formed f JOIN ends e ON e.word = f.word
"""

OP12 = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM pieces),
starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
phrases AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, i, unnest([1, 2, 3, 4]) AS k FROM starts)
  WHERE i + k - 1 <= len(ws) GROUP BY ALL),
totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY lang),
candidates AS (
  SELECT lang, k, phrase, f AS a FROM phrases WHERE k > 1 AND f >= 30),
inside AS (
  SELECT DISTINCT c.lang, array_to_string(string_split(c.phrase, ' ')[s:s + m - 1], ' ') AS phrase, c.a
  FROM candidates c, range(1, 4) AS x(s), range(2, 4) AS y(m) WHERE m < c.k AND s + m - 1 <= c.k),
kept AS (
  SELECT c.* FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase
      AND 100 * i.a::HUGEINT >= 80 * c.a::HUGEINT)),
halves AS (
  SELECT c.lang, c.phrase, c.a, cut, array_to_string(string_split(c.phrase, ' ')[1:cut], ' ') AS head,
    array_to_string(string_split(c.phrase, ' ')[cut + 1:], ' ') AS tail
  FROM kept c, range(1, 4) AS x(cut) WHERE cut < c.k),
cuts AS (
  SELECT h.lang, h.phrase, h.a, h.cut, l.f AS l, r.f AS r,
    (2000000 * h.a::HUGEINT) // (l.f::HUGEINT + r.f::HUGEINT) AS score
  FROM halves h JOIN phrases l ON l.lang = h.lang AND l.phrase = h.head
    JOIN phrases r ON r.lang = h.lang AND r.phrase = h.tail),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT k.lang, k.rank::BIGINT AS rank, k.phrase, k.a::BIGINT AS a, k.l::BIGINT AS l, k.r::BIGINT AS r, t.n,
  k.score::BIGINT AS score
FROM ranked k JOIN totals t ON t.lang = k.lang WHERE k.rank <= 2000
"""

OP3 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents
), cut AS (
  SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs
), words AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM cut
), windows AS (
  SELECT rid, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS win
  FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)
), repeated AS (
  SELECT rid, i FROM windows WHERE win IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY rid, win) > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY rid
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), counts AS (
  SELECT rid, doc_id, host, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM docs JOIN cut USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < 50 AS fails_short, 100 * n_repeat_words > 50 * n_words AS fails_repeats,
         100 * n_symbols > 10 * n_words AS fails_symbols, 100 * n_dup_lines > 30 * n_lines AS fails_dup_lines,
         word_chars < 2 * n_words OR word_chars > 20 * n_words AS fails_word_length
  FROM counts
), rules AS (
  UNPIVOT (SELECT rid, host, COLUMNS('fails_.*') FROM judged WHERE host IS NOT NULL)
  ON COLUMNS('fails_.*') INTO NAME rule VALUE failed
), hosts AS (
  SELECT host, rule, count(*)::DOUBLE AS n, (count(*) FILTER (WHERE failed))::DOUBLE AS f FROM rules GROUP BY ALL
), sums AS (
  SELECT rule, count(*) AS hosts, sum(n) AS docs, sum(f) / sum(n) AS mean, sum(f * f / n) AS squares
  FROM hosts GROUP BY rule
), spread AS (
  SELECT rule, mean, (squares - docs * mean * mean - (hosts - 1) * mean * (1 - mean)) / docs AS between_hosts FROM sums
), priors AS (
  SELECT rule, mean, CASE WHEN between_hosts <= 0 THEN 1e6
         ELSE least(greatest(mean * (1 - mean) / between_hosts - 1, 1.0), 1e6) END AS strength FROM spread
), verdicts AS (
  SELECT host, max((f + mean * strength) / (n + strength)) > 0.5 AS host_rejected
  FROM hosts JOIN priors USING (rule) GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fails_short OR fails_repeats AS base_failed, coalesce(host_rejected, false) AS host_rejected,
       NOT (fails_short OR fails_repeats OR fails_symbols OR fails_word_length OR coalesce(host_rejected, false)) AS kept
FROM judged LEFT JOIN verdicts USING (host)
"""
