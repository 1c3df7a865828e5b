"""SQL twins of the sharding, run and phrase queries, written from their definitions.

They share no code with the operators: shards are searched by recursion over one capacity
after the other, runs come from a self-join on equal words, phrases from grouped windows.
"""

from __future__ import annotations

#: Fixed pattern of the contract: a word of a text.
_WORD = r"[^\x20\x09-\x0D]+"


def crc32(text: str) -> str:
    """The checksum of a text's bytes, unsigned, bit by bit."""
    steps = f"flatten(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: [('0x' || b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, b: {step}), 4294967295)"


def shards_sql(shards: int) -> str:
    return f"""
WITH RECURSIVE rows_of AS (
  SELECT doc_id, coalesce(text, '') AS body, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size FROM documents),
groups AS (SELECT body, sum(size)::BIGINT AS bytes, min(doc_id) AS first FROM rows_of GROUP BY body),
total AS (SELECT sum(bytes)::BIGINT AS total FROM groups),
ordered AS (
  SELECT body, bytes, row_number() OVER (
    ORDER BY CASE WHEN bytes >= greatest(total // {shards}, 1) THEN -bytes ELSE 0 END, first IS NULL, first, sha256(body)) AS place
  FROM groups, total),
summed AS MATERIALIZED (SELECT body, sum(bytes) OVER (ORDER BY place)::BIGINT AS upto FROM ordered),
search AS (
  SELECT {shards} AS waiting, 0::BIGINT AS start, (total + {shards - 1}) // {shards} AS low, total AS high, 0 AS step, 0::BIGINT AS here, total,
    []::BIGINT[] AS cuts FROM total
  UNION ALL
  SELECT CASE WHEN found THEN waiting - 1 ELSE waiting END,
    CASE WHEN found THEN reached ELSE start END,
    CASE WHEN found THEN (total - reached + greatest(waiting - 2, 0)) // greatest(waiting - 1, 1)
      WHEN reached < total AND step + 1 = waiting THEN middle + 1 ELSE low END,
    CASE WHEN found THEN total - reached WHEN reached = total THEN middle ELSE high END,
    CASE WHEN found OR reached = total OR step + 1 = waiting THEN 0 ELSE step + 1 END,
    CASE WHEN found THEN reached WHEN reached = total OR step + 1 = waiting THEN start ELSE reached END,
    total,
    CASE WHEN found THEN list_append(cuts, reached) ELSE cuts END
  FROM (
    SELECT *, (low + high) // 2 AS middle, low >= high AS found,
      coalesce((SELECT max(upto) FROM summed WHERE upto <= here + (low + high) // 2), here) AS reached
    FROM search WHERE waiting > 0)),
cuts AS (SELECT unnest(cuts[:-2]) AS cut FROM search WHERE waiting = 0),
placed AS (SELECT body, upto, (SELECT count(*) FROM cuts WHERE cut < upto)::INT AS shard FROM summed)
SELECT doc_id, size, {crc32('body')} AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY upto, doc_id NULLS LAST) - 1 AS slot, NULL::INT AS grown_shard
FROM rows_of JOIN placed USING (body)
"""


RUNS = f"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w, {crc32("doc_id::VARCHAR")} AS h FROM documents),
laws AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g FROM split),
turned AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM laws),
numbered AS (SELECT row, n, unnest(range(n)) AS i, w, a, p FROM turned),
words AS (
  SELECT row, n, i, CASE WHEN a IS NOT NULL AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word FROM numbered),
pairs AS (
  SELECT x.row, x.i, y.i - x.i AS q FROM words x JOIN words y
    ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT row, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY row, q, island),
runs AS (
  SELECT row, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY row, start, length),
longest AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY length DESC, start, period) AS place FROM runs),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS list FROM runs GROUP BY row),
dropped AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS body FROM words ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(list, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM split LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)
  LEFT JOIN (SELECT * FROM longest WHERE place = 1) USING (row)
"""


def phrases_sql(least: int, longest: int, most: int) -> str:
    follow = ", ".join(f"lead(word, {k}) OVER (PARTITION BY piece ORDER BY i) AS w{k}" for k in range(1, longest))
    windows = " UNION ALL ".join(
        f"SELECT lang, {m} AS size, concat_ws(' ', {', '.join(['word', *[f'w{k}' for k in range(1, m)]])}) AS w FROM suffixes" + (f" WHERE w{m - 1} IS NOT NULL" if m > 1 else "")
        for m in range(1, longest + 1)
    )
    return rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, body FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS body FROM documents)),
split AS (SELECT piece, lang, regexp_extract_all(body, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT piece, lang, unnest(w) AS word, unnest(range(len(w))) AS i FROM split),
suffixes AS MATERIALIZED (SELECT lang, word, {follow} FROM words),
counts AS MATERIALIZED (SELECT lang, size, w, count(*) AS f FROM ({windows}) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT *, string_split(w, ' ') AS parts FROM counts WHERE size > 1 AND f >= {least}),
cuts AS (SELECT lang, parts, w, f AS a, unnest(range(1, size)) AS k FROM candidates),
sides AS (SELECT lang, w, a, k, array_to_string(parts[:k], ' ') AS first, array_to_string(parts[k + 1:], ' ') AS rest FROM cuts),
scored AS (
  SELECT s.*, l.f AS l, r.f AS r, n, 1000::HUGEINT * a * n // (l.f::HUGEINT * r.f) AS score
  FROM sides s JOIN totals USING (lang) JOIN counts l ON l.lang = s.lang AND l.w = s.first JOIN counts r ON r.lang = s.lang AND r.w = s.rest),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS place FROM scored),
inner_parts AS (
  SELECT lang, array_to_string(parts[s:s + m - 1], ' ') AS w, max(f) AS longer FROM (
    SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates)) GROUP BY ALL),
kept AS (
  SELECT lang, w AS phrase, a, l, r, n, score FROM lowest LEFT JOIN inner_parts USING (lang, w)
  WHERE place = 1 AND (longer IS NULL OR longer < a)),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= {most}
"""
