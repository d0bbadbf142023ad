"""Independent DuckDB statements of the operators that SQL can express."""

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) AS no
  FROM sized GROUP BY source),
w AS (
  SELECT *, CAST([3, 1, 2][(no - 1) % 3 + 1] AS DOUBLE) AS weight, 2 * source_size AS cap,
         CAST(2 * source_size AS DOUBLE) / [3, 1, 2][(no - 1) % 3 + 1] AS ratio,
         1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget
  FROM src),
lv AS (
  SELECT *, (budget - CAST(coalesce(sum(cap) OVER b, 0) AS DOUBLE))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY ratio, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fixed AS (SELECT arg_min(level, (ratio, no)) AS level FROM lv WHERE ratio > level),
tgt AS (
  SELECT lv.*, CASE WHEN fixed.level IS NULL OR ratio <= fixed.level THEN CAST(cap AS DOUBLE)
                    ELSE fixed.level * weight END AS target
  FROM lv, fixed),
queue AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.budget,
         CAST(sum(s.size) OVER (PARTITION BY t.no ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS done
  FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source),
times AS (
  SELECT doc_id, size, budget, CAST(done + k * source_size AS DOUBLE) / target AS finish
  FROM queue, (VALUES (0), (1)) p(k) WHERE size > 0 AND target > 0),
cut AS (
  SELECT max(finish) AS t FROM (
    SELECT finish, budget, sum(size) OVER (ORDER BY finish RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM times) WHERE upto <= budget)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size > 0 AND target > 0
            THEN size * (CASE WHEN CAST(done AS DOUBLE) / target <= t THEN 1 ELSE 0 END
                       + CASE WHEN CAST(done + source_size AS DOUBLE) / target <= t THEN 1 ELSE 0 END)
            ELSE 0 END AS BIGINT) AS taken
FROM queue, cut
"""

PREFERENCE_SQL = """
WITH t AS (
  SELECT DISTINCT (conv_id - ((conv_id % 2) + 2) % 2) // 2 AS pair_id, ((conv_id % 2) + 2) % 2 AS side, turn,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side, turn ORDER BY role, text) AS nth FROM t),
differs AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.turn, r.turn) AS turn, coalesce(c.nth, r.nth) AS nth
  FROM (SELECT * FROM n WHERE side = 0) c FULL OUTER JOIN (SELECT * FROM n WHERE side = 1) r
    ON c.pair_id = r.pair_id AND c.turn = r.turn AND c.nth = r.nth
  WHERE c.pair_id IS NULL OR r.pair_id IS NULL OR c.role <> r.role OR c.text <> r.text),
cut AS (SELECT pair_id, min((turn, nth)) AS at FROM differs GROUP BY pair_id),
seg AS (
  SELECT n.pair_id, CASE WHEN cut.at IS NULL OR (n.turn, n.nth) < cut.at THEN 'prompt'
                         WHEN n.side = 0 THEN 'chosen' ELSE 'rejected' END AS part, n.turn, n.nth, n.role, n.side,
         '<|' || n.role || '|>' || chr(10) || n.text || '<|end|>' || chr(10) AS rendered
  FROM n LEFT JOIN cut ON n.pair_id = cut.pair_id)
SELECT pair_id, part, turn, CAST(nth AS INTEGER) AS nth, role, rendered,
       CAST(sum(length(rendered)) OVER (PARTITION BY pair_id, part ORDER BY turn, nth) - length(rendered) AS BIGINT) AS start,
       CAST(length(rendered) AS BIGINT) AS length, part <> 'prompt' AND role = 'assistant' AS trained
FROM seg WHERE NOT (part = 'prompt' AND side = 1)
"""

EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
