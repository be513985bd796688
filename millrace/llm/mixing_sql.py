"""The mix of mixing.py as one DuckDB statement over `documents`, written out step by step.

Shards are allocated without regions, which gives the same up to mixing.REGIONS shards a source.
"""

SIZES = r"""
SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
       md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h FROM documents"""

MIX = f"""
WITH m AS ({SIZES}),
w AS (SELECT source, sum(size)::BIGINT AS ss,
             [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
      FROM m GROUP BY source),
f AS (SELECT *, ((sum(ss) OVER ())::DOUBLE - 3 * coalesce(sum(ss) OVER o, 0)::DOUBLE) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0.0)) AS level
      FROM w WINDOW o AS (ORDER BY ss::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT level FROM f WHERE level * weight <= 3 * ss ORDER BY ss::DOUBLE / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, ss, least(coalesce((SELECT level FROM l), 0.0) * weight, 3 * ss::DOUBLE) AS target,
             greatest(1, ceil(ss / 2000000.0))::BIGINT AS n_shards FROM f),
t2 AS (SELECT *, round(sum(target) OVER () / 16)::BIGINT AS seats, sum(target) OVER () AS total FROM t),
t3 AS (SELECT *, CASE WHEN total > 0 THEN floor(target * seats / total + 0.5)::BIGINT ELSE 0 END AS base FROM t2),
t4 AS (SELECT *, CASE WHEN total > 0 THEN seats - sum(base) OVER () ELSE 0 END AS gap FROM t3),
c AS (SELECT source, gap, k, target / (2 * (CASE WHEN gap > 0 THEN base + k - 1 ELSE base - k END) + 1) AS q
      FROM t4, unnest(range(1, abs(gap)::BIGINT + 1)) AS u(k) WHERE gap > 0 OR k <= base),
r AS (SELECT *, row_number() OVER (ORDER BY -sign(gap) * q, source NULLS LAST, k) AS rank FROM c),
won AS (SELECT source, sum(sign(gap))::BIGINT AS n FROM r WHERE rank <= abs(gap) GROUP BY source),
a AS (SELECT t4.*, base + coalesce(n, 0) AS blocks FROM t4 LEFT JOIN won ON t4.source IS NOT DISTINCT FROM won.source),
d AS (SELECT m.*, a.ss, a.target, a.blocks, ('0x' || substr(h, 1, 8))::BIGINT % n_shards AS shard
      FROM m JOIN a ON m.source IS NOT DISTINCT FROM a.source),
d2 AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY h, doc_id NULLS LAST, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
s AS (SELECT source, shard, sum(size)::BIGINT AS length, any_value(blocks) AS blocks FROM d2 GROUP BY source, shard),
s2 AS (SELECT *, sum(length) OVER (PARTITION BY source) AS total FROM s),
s3 AS (SELECT *, CASE WHEN total > 0 THEN floor(length * blocks / total::DOUBLE + 0.5)::BIGINT ELSE 0 END AS base FROM s2),
s4 AS (SELECT *, CASE WHEN total > 0 THEN blocks - sum(base) OVER (PARTITION BY source) ELSE 0 END AS gap FROM s3),
sc AS (SELECT source, shard, gap, k, length / (2 * (CASE WHEN gap > 0 THEN base + k - 1 ELSE base - k END) + 1)::DOUBLE AS q
       FROM s4, unnest(range(1, abs(gap)::BIGINT + 1)) AS u(k) WHERE gap > 0 OR k <= base),
sr AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY -sign(gap) * q, shard, k) AS rank FROM sc),
sw AS (SELECT source, shard, sum(sign(gap))::BIGINT AS n FROM sr WHERE rank <= abs(gap) GROUP BY source, shard),
q AS (SELECT s4.source, s4.shard, length, least((base + coalesce(n, 0)) * 16, 3 * length) AS words, ceil(length / 16.0)::BIGINT AS nb
      FROM s4 LEFT JOIN sw ON s4.source IS NOT DISTINCT FROM sw.source AND s4.shard = sw.shard),
q2 AS (SELECT *, CASE WHEN length > 0 THEN floor(words / length::DOUBLE)::BIGINT ELSE 0 END AS rounds FROM q),
q3 AS (SELECT *, CASE WHEN length > 0 THEN least(nb, round((words - rounds * length) / 16.0)::BIGINT) ELSE 0 END AS extra,
              CASE WHEN nb > 0 THEN ('0x' || substr(md5('start7:' || coalesce(source, '') || ':' || shard), 1, 8))::BIGINT % nb ELSE 0 END AS begin FROM q2),
e AS (SELECT d2.*, rounds, extra, nb, begin, start + size AS stop, start // 16 AS i, (start + size) // 16 AS j
      FROM d2 JOIN q3 ON d2.source IS NOT DISTINCT FROM q3.source AND d2.shard = q3.shard)
SELECT doc_id, size, ss AS source_size, target,
       (rounds * size + CASE WHEN extra > 0 AND size > 0 THEN
          ((j * extra + begin) // nb) * 16 + (((j + 1) * extra + begin) // nb - (j * extra + begin) // nb) * (stop - j * 16)
        - ((i * extra + begin) // nb) * 16 - (((i + 1) * extra + begin) // nb - (i * extra + begin) // nb) * (start - i * 16)
       ELSE 0 END)::BIGINT AS taken
FROM e"""
