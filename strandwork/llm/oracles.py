"""SQL that the survivorship queries must agree with."""

from __future__ import annotations

from .survivorship import DESCRIPTIVE, GOLDEN

VOID = "('', 'na', 'n/a', 'n.a.', 'none', 'null', 'nan', 'nil', 'unknown', 'not available', 'not applicable')"


def _void(c: str) -> str:
    t = f"lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))"
    return f"({c} IS NULL OR {t} IN {VOID} OR regexp_full_match({t}, '[^\\p{{L}}\\p{{N}}]*'))"


FILLED = " + ".join(f"(NOT {_void(c)})::INTEGER" for c in DESCRIPTIVE)
P3_FOUND = f"""WITH g AS (SELECT cluster_id, gene_id, loaded_at, {FILLED} AS n, coalesce(length(regexp_replace(regexp_replace(original_header, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')), 0) AS h FROM gene),
c AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, h DESC, loaded_at DESC, gene_id) AS rn, count(*) OVER (PARTITION BY cluster_id) AS m FROM g),
s AS (SELECT jrc_id, length(sequence) AS n, upper(regexp_replace(protein_id, '^\\s+|\\s+$', '', 'g')) AS k FROM sequence WHERE NOT {_void('protein_id')}),
t AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, jrc_id DESC) AS rn, count(*) OVER (PARTITION BY k) AS m FROM s)
SELECT 'cluster' AS group_kind, cluster_id AS group_id, gene_id::VARCHAR AS survivor_id FROM c WHERE rn = 1 AND m >= 2
UNION ALL SELECT 'protein', p.protein_id, t.jrc_id FROM t JOIN protein p ON upper(regexp_replace(p.protein_id, '^\\s+|\\s+$', '', 'g')) = t.k WHERE t.rn = 1 AND m >= 2"""

RANK = "CASE source WHEN 'CARD' THEN 3 WHEN 'NCBI' THEN 2 WHEN 'RESFINDER' THEN 1 ELSE 0 END"
BEST = ", ".join(
    f"arg_max(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), {{'r': {RANK}, 'at': loaded_at, 'v': regexp_replace({c}, '^\\s+|\\s+$', '', 'g')}}) FILTER (WHERE NOT {_void(c)}) AS {c}"
    for c in GOLDEN
)
P3_GOLDEN = f"SELECT cluster_id, count(*) AS n_rows, {BEST} FROM gene GROUP BY cluster_id"

ORACLES = {"p3_found": P3_FOUND, "p3_golden": P3_GOLDEN}
