"""DuckDB SQL for queries that SQL can express, by plainer ways than the operators'."""

# All quotients that could win are listed, up to one for every block; the level at which sources
# that stop are cut is looked for among all sources; a document's words are its share of every turn.
MIX_SQL = r"""
WITH RECURSIVE
sizes AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS own
  FROM documents),
sources AS MATERIALIZED (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sizes GROUP BY source),
weighed AS MATERIALIZED (
  SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight, sum(source_size) OVER () AS total FROM sources),
-- Round by round: those above their stop leave, and the rest is shared again.
rounds(round, stopped, words, weights) AS (
  SELECT 0, []::BIGINT[], max(total)::BIGINT, sum(weight)::BIGINT FROM weighed
  UNION ALL
  SELECT round + 1, now.stopped, now.words, now.weights
  FROM rounds, LATERAL (
    SELECT list(rank) FILTER (above) AS stopped,
           (max(total) - coalesce(sum(3 * source_size) FILTER (above), 0))::BIGINT AS words,
           coalesce(sum(weight) FILTER (NOT above), 0)::BIGINT AS weights
    FROM (SELECT w.*, list_contains(rounds.stopped, w.rank)
                 OR w.weight * rounds.words >= 3 * w.source_size * rounds.weights AS above FROM weighed w)) now
  WHERE len(now.stopped) > len(rounds.stopped)),
level AS (SELECT * FROM rounds ORDER BY round DESC LIMIT 1),
targets AS MATERIALIZED (
  SELECT w.source, w.rank, w.source_size, (2 * w.total + 16)::BIGINT // 32 AS blocks,
         greatest(ceil(sqrt(w.source_size / 4096)), 1)::BIGINT AS shards,
         CASE WHEN list_contains(level.stopped, w.rank) THEN (3 * w.source_size)::DOUBLE
              ELSE w.weight * level.words / level.weights::DOUBLE END AS target
  FROM weighed w, level),
source_quotients AS (
  SELECT rank, blocks, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, rank, j) AS place
  FROM targets, LATERAL (SELECT unnest(generate_series(0, blocks)) AS j) WHERE target > 0),
source_blocks AS MATERIALIZED (SELECT rank, count(*) AS blocks FROM source_quotients WHERE place <= blocks GROUP BY rank),
dealt AS MATERIALIZED (
  SELECT s.*, t.rank, t.source_size, t.target,
         ('0x' || substr(md5('7:' || own), 1, 15))::BIGINT % t.shards AS shard
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
shards AS MATERIALIZED (
  SELECT rank, shard, sum(size)::BIGINT AS ring FROM dealt GROUP BY rank, shard),
shard_quotients AS (
  SELECT rank, shard, b.blocks,
         row_number() OVER (PARTITION BY rank ORDER BY ring / (2 * j + 1) DESC, shard, j) AS place
  FROM shards JOIN source_blocks b USING (rank), LATERAL (SELECT unnest(generate_series(0, b.blocks)) AS j)
  WHERE ring > 0),
shard_blocks AS (SELECT rank, shard, count(*) AS quota FROM shard_quotients WHERE place <= blocks GROUP BY rank, shard),
quotas AS MATERIALIZED (
  SELECT rank, shard, ring, least(coalesce(quota, 0) * 16, 3 * ring)::BIGINT AS words,
         (('0x' || substr(md5('7:' || rank || ':' || shard), 1, 15))::BIGINT
          % greatest(ceil(ring / 16), 1)::BIGINT) * 16 AS begin_word
  FROM shards LEFT JOIN shard_blocks USING (rank, shard)),
placed AS (
  SELECT d.*, q.ring, q.words, q.begin_word,
         (sum(size) OVER (PARTITION BY rank, shard ORDER BY
            ('0x' || substr(md5('8:' || own), 1, 15))::BIGINT, own
            ROWS UNBOUNDED PRECEDING))::BIGINT - size AS doc_start
  FROM dealt d JOIN quotas q USING (rank, shard))
-- The words begin_word, begin_word + 1, ... of the endless ring: of each of its turns, what lies in the document.
SELECT doc_id, size, source_size, target,
       list_sum([greatest(0, least(begin_word + words, turn * ring + doc_start + size)
                              - greatest(begin_word, turn * ring + doc_start))
                 FOR turn IN [0, 1, 2, 3]])::BIGINT AS taken
FROM placed
"""

FILL_MIDDLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hash
  FROM documents),
numbered AS (
  SELECT *, ('0x' || substr(hash, 1, 8))::BIGINT % (n + 1) AS cut_1, ('0x' || substr(hash, 9, 8))::BIGINT % (n + 1) AS cut_2,
         ('0x' || substr(hash, 17, 8))::BIGINT % 100 AS plain_draw, ('0x' || substr(hash, 25, 8))::BIGINT % 100 AS order_draw
  FROM texts),
formed AS (
  SELECT *, least(cut_1, cut_2) AS prefix_end, greatest(cut_1, cut_2) AS middle_end,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR plain_draw >= 90 THEN 'plain'
              WHEN order_draw < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered),
parts AS (
  SELECT *, substr(text, 1, prefix_end) AS prefix, substr(text, prefix_end + 1, middle_end - prefix_end) AS middle,
         substr(text, middle_end + 1) AS suffix
  FROM formed)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN prefix_end END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN middle_end - prefix_end END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
