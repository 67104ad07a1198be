"""DuckDB SQL for the rows of the corpus pipeline, stage by stage in plain joins."""

from __future__ import annotations

from derrick.llm.decontaminate import SHARE, hits_sql
from derrick.llm.jaccard_metric import NEAR
from derrick.llm.line_dedup import lines_sql
from derrick.llm.mix_curriculum import plan_sql
from derrick.llm.quality_hosts import base_sql

_SHINGLES = f"""
    n_word AS (SELECT doc_id AS d, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM p2),
    n_set AS (SELECT DISTINCT d, array_to_string(w[i:i + {NEAR.n - 1}], ' ') AS g FROM
        (SELECT d, w, unnest(range(1, greatest(len(w) - {NEAR.n - 2}, 2))) AS i FROM n_word WHERE len(w) > 0)),
    n_size AS (SELECT d, count(*) AS n FROM n_set GROUP BY d),
    n_pair AS (SELECT a.d AS x, b.d AS y, count(*) AS k FROM n_set a JOIN n_set b ON a.g = b.g AND a.d < b.d GROUP BY a.d, b.d),
    n_link AS (SELECT x, y FROM n_pair JOIN n_size a ON a.d = x JOIN n_size b ON b.d = y WHERE 100 * k >= {NEAR.percent} * (a.n + b.n - k)),
    n_both AS (SELECT x, y FROM n_link UNION SELECT y, x FROM n_link),
    n_reach AS (SELECT d AS x, d AS y FROM n_size UNION SELECT r.x, e.y FROM n_reach r JOIN n_both e ON r.y = e.x),
    n_gone AS (SELECT x FROM n_reach GROUP BY x HAVING min(y) < x)"""

PIPELINE_SQL = f"""WITH RECURSIVE {base_sql("documents", "doc_id, text, lang, source, n_chars")},
    p1 AS (SELECT doc_id, text, lang, source, n_chars, row_number() OVER () AS rid1 FROM q_out WHERE kept),
{lines_sql("p1", "rid1")},
    p2 AS (SELECT doc_id, CASE WHEN n_dropped = 0 THEN text ELSE kept END AS text, lang, source,
        CASE WHEN n_dropped = 0 THEN n_chars ELSE length(kept) END AS n_chars FROM p1 JOIN l_out ON rid1 = k),
{_SHINGLES},
    p3 AS (SELECT *, row_number() OVER () AS rid3 FROM p2 WHERE doc_id NOT IN (SELECT x FROM n_gone)),
{hits_sql("p3", "rid3")},
    p4 AS (SELECT doc_id, text, lang, source, n_chars FROM p3 JOIN b_out ON rid3 = k WHERE NOT (n_hit > 0 AND {SHARE} * n_hit >= n_words)),
{plan_sql("p4", "doc_id, text, lang, source, n_chars")}
SELECT doc_id, text, lang, source, n_chars, size, source_size, target, taken, position_ppm FROM m_plan WHERE taken > 0"""
