"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

P4 = r"""
WITH n AS (SELECT greatest(3, floor(0.02 * count(*) + 1e-9)) AS cap FROM stories),
k AS (SELECT id, quality_total, regexp_replace(lower(author), '[^\p{L}\p{N}]', '', 'g') AS who FROM stories),
r AS (SELECT id, who, row_number() OVER (PARTITION BY who ORDER BY quality_total DESC NULLS LAST, id) AS pos, count(*) OVER (PARTITION BY who) AS n_rows
      FROM k WHERE who IS NOT NULL AND who NOT IN ('', 'unknownanonymous'))
"""
P7_LINES = r"""
WITH raw AS (SELECT DISTINCT id, lower(regexp_replace(source_archive, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS source, text FROM raw_stories WHERE id IS NOT NULL AND text IS NOT NULL),
docs AS (SELECT * FROM raw WHERE source <> ''),
parts AS (SELECT id, source, regexp_split_to_array(text, '\r?\n') AS ls FROM docs),
lines AS (SELECT id, source, unnest(range(1, len(ls) + 1)) AS line_no, regexp_replace(lower(unnest(ls)), '[^\p{L}]', '', 'g') AS line_key FROM parts),
sizes AS (SELECT source, count(DISTINCT id) AS n FROM docs GROUP BY source),
often AS (SELECT l.source, line_key FROM lines l JOIN sizes s ON l.source = s.source WHERE line_key <> '' GROUP BY l.source, line_key, n HAVING count(DISTINCT id) >= 3 AND count(DISTINCT id) >= ceil(0.05 * n - 1e-9))
"""
WHITE = r"[^\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"

SQL = {
    "p4_found": P4 + "SELECT id FROM r, n WHERE pos > cap",
    "p4_contributors": P4 + "SELECT who AS contributor, count(*) AS n_rows, count(*) FILTER (pos <= cap) AS n_kept, count(*) FILTER (pos > cap) AS n_removed FROM r, n WHERE n_rows > cap GROUP BY who",
    "p6_found": f"SELECT DISTINCT id, CAST(chunk_index AS INTEGER) AS chunk_index FROM chunk_texts WHERE length(text) > 2400 OR len(regexp_extract_all(text, '{WHITE}')) > 350",
    "p7_found": P7_LINES + "SELECT DISTINCT id, CAST(line_no AS INTEGER) AS line_no FROM lines SEMI JOIN often ON lines.source = often.source AND lines.line_key = often.line_key",
}
