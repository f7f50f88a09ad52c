"""SQL for DuckDB that gives the same rows as the queries in ``problems``."""

_SPACE = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def _acc(col: str) -> str:
    u = f"upper(trim({col}, {_SPACE}))"
    return f"CASE WHEN {u} NOT IN ('', 'NA', 'N/A', 'NONE', 'NULL', '-') THEN {u} END"


def _field(col: str) -> str:
    return f"trim(regexp_replace(lower({col}), '[^a-z0-9]+', '_', 'g'), '_')"


_P2 = f"""
WITH refs AS (
  SELECT 'run' AS kind, {_acc('run_accession')} AS key, 'override_rows' AS src_table, override_row_id AS row_id, 'run_accession' AS ref_field, added_at AS t FROM override_rows
  UNION ALL SELECT 'sample', {_acc('sample_accession')}, 'override_rows', override_row_id, 'sample_accession', added_at FROM override_rows
  UNION ALL SELECT 'run', {_acc('run_accession')}, 'run_metadata', meta_id, 'run_accession', updated_at FROM run_metadata
), life AS (
  SELECT a.run, a.arrived, w.withdrawn
  FROM (SELECT {_acc('run_accession')} AS run, min(ingested_at) AS arrived FROM runs GROUP BY 1) a
  LEFT JOIN (SELECT {_acc('run_accession')} AS run, min(withdrawn_at) AS withdrawn FROM run_withdrawals GROUP BY 1) w ON a.run = w.run
), held AS (
  SELECT DISTINCT 'run' AS kind, {_acc('run_accession')} AS key, {_acc('run_accession')} AS run FROM runs
  UNION SELECT DISTINCT 'sample', {_acc('sample_accession')}, {_acc('run_accession')} FROM runs
), joined AS (
  SELECT r.src_table, r.row_id, r.ref_field, r.t, count(l.run) AS n,
    count(*) FILTER (l.arrived <= r.t) AS here, count(*) FILTER (l.arrived <= r.t AND l.withdrawn <= r.t) AS gone
  FROM refs r LEFT JOIN held h ON r.kind = h.kind AND r.key = h.key LEFT JOIN life l ON h.run = l.run
  WHERE r.key IS NOT NULL GROUP BY ALL
), found AS (
  SELECT src_table, row_id, ref_field, strftime(t, '%Y-%m') AS ref_month,
    CASE WHEN n = 0 THEN 'missing' WHEN here = 0 THEN 'late' WHEN here = gone THEN 'withdrawn' END AS status
  FROM joined
)
"""

_WORDS = "('', '-', 'na', 'n/a', 'none', 'null', 'unknown', 'missing', 'not collected')"

_TYPED = f"""CASE
    WHEN v IS NULL OR lower(v) IN {_WORDS} THEN NULL
    WHEN value_type = 'integer' THEN CASE WHEN regexp_full_match(v, '[+-]?[0-9]+(\\.0*)?')
      THEN CAST(CAST(split_part(replace(v, '+', ''), '.', 1) AS HUGEINT) AS VARCHAR) END
    WHEN value_type = 'decimal' THEN CASE WHEN regexp_full_match(v, '[+-]?[0-9]+(\\.[0-9]*)?')
      THEN CAST(CAST(round(CAST(v AS DECIMAL(28, 9)), 1) AS DECIMAL(28, 1)) AS VARCHAR) END
    WHEN value_type = 'date' THEN strftime(coalesce(
      try_strptime(regexp_extract(v, '^[0-9]{{4}}[-/][0-9]{{1,2}}[-/][0-9]{{1,2}}', 0), ['%Y-%m-%d', '%Y/%m/%d']),
      CASE WHEN regexp_full_match(v, '[0-9]{{8}}') THEN try_strptime(v, '%Y%m%d') END,
      try_strptime(v, ['%d-%b-%Y', '%d %b %Y', '%d %B %Y', '%B %d, %Y', '%b %d, %Y'])), '%Y-%m-%d')
    WHEN value_type = 'boolean' THEN CASE WHEN lower(v) IN ('true', 'yes', 'y', 't', '1') THEN 'true' WHEN lower(v) IN ('false', 'no', 'n', 'f', '0') THEN 'false' END
    ELSE lower(v) END"""

_P4 = f"""
WITH fields AS (
  SELECT DISTINCT {_field('source_column')} AS field, canonical_field, value_type FROM column_map WHERE canonical_field IS NOT NULL
), raw AS (
  SELECT {_acc('run_accession')} AS run_accession, {_field('field_name')} AS field, trim(field_value, {_SPACE}) AS v, updated_at, meta_id FROM run_metadata
), typed AS (
  SELECT r.run_accession, f.canonical_field, r.updated_at, r.meta_id, v, {_TYPED} AS cell_value
  FROM raw r JOIN fields f ON r.field = f.field WHERE r.run_accession IS NOT NULL
), cells AS (
  SELECT run_accession, canonical_field, cell_value FROM typed WHERE cell_value IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run_accession, canonical_field ORDER BY updated_at DESC, meta_id DESC) = 1
)
"""

_FIELDS = [
    ("age_days", "DECIMAL(38,0)"), ("base_count", "DECIMAL(38,0)"), ("batch", "VARCHAR"), ("collection_date", "DATE"), ("condition", "VARCHAR"),
    ("first_public", "DATE"), ("is_control", "BOOLEAN"), ("is_pooled", "BOOLEAN"), ("library_kit", "VARCHAR"), ("read_count", "DECIMAL(38,0)"),
    ("replicate", "DECIMAL(38,0)"), ("rin_score", "DECIMAL(38,1)"), ("sex", "VARCHAR"), ("tissue", "VARCHAR"),
]

_P4_WIDE = (
    _P4
    + f"""
, bad AS (
  SELECT run_accession, canonical_field, v FROM typed WHERE cell_value IS NULL AND v IS NOT NULL AND lower(v) NOT IN {_WORDS}
  QUALIFY row_number() OVER (PARTITION BY run_accession, canonical_field ORDER BY updated_at DESC, meta_id DESC) = 1
)
SELECT t.run_accession, {', '.join(f"CAST(max(c.cell_value) FILTER (c.canonical_field = '{n}') AS {k}) AS {n}" for n, k in _FIELDS)},
  coalesce(any_value(b.cast_failures), '') AS cast_failures
FROM (SELECT DISTINCT run_accession FROM typed) t
LEFT JOIN cells c ON t.run_accession = c.run_accession
LEFT JOIN (SELECT run_accession, string_agg(canonical_field || '=' || v, '; ' ORDER BY canonical_field) AS cast_failures FROM bad GROUP BY 1) b ON t.run_accession = b.run_accession
GROUP BY t.run_accession
"""
)

_P3 = """
WITH long AS (
  UNPIVOT (SELECT report_row_id, fastq_ftp, fastq_md5, fastq_bytes, submitted_ftp FROM ena_reports)
  ON fastq_ftp, fastq_md5, fastq_bytes, submitted_ftp INTO NAME field_name VALUE packed
), bare AS (
  SELECT report_row_id, field_name, regexp_replace(regexp_replace(packed, '^\\s+|\\s+$', '', 'g'), '^\\[\\s*(.*?)\\s*\\]$', '\\1', 's') AS s FROM long
), items AS (
  SELECT report_row_id, field_name, unnest(l) AS raw, unnest(range(1, len(l) + 1)) AS pos FROM (
    SELECT report_row_id, field_name, regexp_extract_all(s, '("(?:[^"]|"")*"|''(?:[^'']|'''')*''|[^\\s;,|]*)(?:\\s*[;,|]\\s*|\\s+|$)', 1) AS l FROM bare)
), clean AS (
  SELECT report_row_id, field_name, pos, trim(CASE
    WHEN raw LIKE '"%"' AND len(raw) > 1 THEN replace(raw[2:-2], '""', '"')
    WHEN raw LIKE '''%''' AND len(raw) > 1 THEN replace(raw[2:-2], '''''', '''') ELSE raw END) AS item FROM items
)
SELECT report_row_id, field_name, pos, item FROM clean WHERE item <> ''
"""

_P5 = f"""
WITH files AS (
  SELECT feed_id, file_no, row_number() OVER (PARTITION BY feed_id ORDER BY file_no) AS rk
  FROM (SELECT feed_id, file_no FROM runs UNION SELECT feed_id, file_no FROM resolver_configs) WHERE feed_id IS NOT NULL AND file_no IS NOT NULL
), docs AS (
  SELECT feed_id, file_no, CAST(metadata AS JSON) AS j FROM runs WHERE CASE WHEN json_valid(metadata) THEN json_type(metadata) = 'OBJECT' ELSE false END
), vals AS (
  SELECT feed_id, file_no, {_field('k')} AS field, json_type(json_extract(j, '$."' || k || '"')) AS jt FROM (SELECT feed_id, file_no, j, unnest(json_keys(j)) AS k FROM docs)
  UNION ALL SELECT feed_id, file_no, {_field('k')}, 'NULL' FROM (SELECT feed_id, file_no, unnest(fields) AS k FROM resolver_configs)
), held AS (
  SELECT v.feed_id, v.file_no, rk, field, CASE
    WHEN count(*) FILTER (jt <> 'NULL') = 0 THEN NULL
    WHEN bool_and(jt IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'UHUGEINT')) FILTER (jt <> 'NULL') THEN 'integer'
    WHEN bool_and(jt = 'BOOLEAN') FILTER (jt <> 'NULL') THEN 'boolean'
    WHEN bool_and(jt IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'UHUGEINT', 'DOUBLE')) FILTER (jt <> 'NULL') THEN 'decimal'
    ELSE 'string' END AS typ
  FROM vals v JOIN files f ON v.feed_id = f.feed_id AND v.file_no = f.file_no WHERE field <> '' GROUP BY ALL
), cm AS (
  SELECT DISTINCT {_field('source_column')} AS field, canonical_field AS c FROM column_map WHERE canonical_field IS NOT NULL
), come AS (
  SELECT h.feed_id, h.rk, h.field, c FROM held h LEFT JOIN held p ON h.feed_id = p.feed_id AND h.rk = p.rk + 1 AND h.field = p.field LEFT JOIN cm ON h.field = cm.field
  WHERE p.field IS NULL AND h.rk > 1
), gone AS (
  SELECT p.feed_id, f.rk, p.field, c FROM held p JOIN files f ON f.feed_id = p.feed_id AND f.rk = p.rk + 1
  LEFT JOIN held h ON h.feed_id = p.feed_id AND h.rk = p.rk + 1 AND h.field = p.field LEFT JOIN cm ON p.field = cm.field WHERE h.field IS NULL
), renamed AS (
  SELECT a.feed_id, a.rk, a.field AS new, g.field AS old FROM
    (SELECT feed_id, rk, c, min(field) AS field FROM come WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) = 1) a JOIN
    (SELECT feed_id, rk, c, min(field) AS field FROM gone WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) = 1) g
    ON a.feed_id = g.feed_id AND a.rk = g.rk AND a.c = g.c
), seg AS (
  SELECT *, rk - row_number() OVER (PARTITION BY feed_id, field ORDER BY rk) AS stretch FROM held
), typed AS (
  SELECT *, last_value(typ IGNORE NULLS) OVER (PARTITION BY feed_id, field, stretch ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_typ FROM seg
), changes AS (
  SELECT feed_id, rk, 'renamed' AS change_kind, new AS field_name, old AS old_name FROM renamed
  UNION ALL SELECT feed_id, rk, 'added', field, '' FROM come x WHERE NOT EXISTS (SELECT 1 FROM renamed r WHERE r.feed_id = x.feed_id AND r.rk = x.rk AND r.new = x.field)
  UNION ALL SELECT feed_id, rk, 'removed', field, '' FROM gone x WHERE NOT EXISTS (SELECT 1 FROM renamed r WHERE r.feed_id = x.feed_id AND r.rk = x.rk AND r.old = x.field)
  UNION ALL SELECT feed_id, rk, 'retyped', field, '' FROM typed WHERE typ <> last_typ
)
SELECT c.feed_id, f.file_no, c.change_kind, c.field_name, c.old_name FROM changes c JOIN files f ON c.feed_id = f.feed_id AND c.rk = f.rk
"""

_P5_TABLE = f"""
WITH docs AS (
  SELECT ingest_id, CAST(metadata AS JSON) AS j FROM runs WHERE CASE WHEN json_valid(metadata) THEN json_type(metadata) = 'OBJECT' ELSE false END
), pairs AS (
  SELECT ingest_id, k, {_field('k')} AS field, trim(json_extract_string(j, '$."' || k || '"'), {_SPACE}) AS v, json_extract_string(j, '$."' || k || '"') AS raw
  FROM (SELECT ingest_id, j, unnest(json_keys(j)) AS k FROM docs)
), fields AS (
  SELECT DISTINCT {_field('source_column')} AS field, canonical_field, value_type FROM column_map WHERE canonical_field IS NOT NULL
), typed AS (
  SELECT ingest_id, k, canonical_field, {_TYPED} AS cell FROM pairs JOIN fields USING (field)
), cells AS (
  SELECT ingest_id, canonical_field, first(cell ORDER BY k) AS cell FROM typed WHERE cell IS NOT NULL GROUP BY ALL
), rest AS (
  SELECT ingest_id, string_agg(field || '=' || raw, '; ' ORDER BY field || '=' || raw) AS other_fields FROM pairs
  WHERE raw IS NOT NULL AND field NOT IN (SELECT field FROM fields) GROUP BY 1
)
SELECT r.ingest_id, feed_id, file_no, {', '.join(f"c.{n}" for n, _ in _FIELDS)},
  CASE WHEN r.ingest_id IN (SELECT ingest_id FROM docs) THEN coalesce(other_fields, '') END AS other_fields
FROM runs r LEFT JOIN rest ON r.ingest_id = rest.ingest_id
LEFT JOIN (SELECT ingest_id, {', '.join(f"any_value(cell) FILTER (canonical_field = '{n}') AS {n}" for n, _ in _FIELDS)} FROM cells GROUP BY 1) c ON r.ingest_id = c.ingest_id
"""

ORACLES = {
    "p2_found": _P2 + "SELECT src_table, row_id, ref_field, ref_month, status FROM found WHERE status IS NOT NULL",
    "p2_report": _P2 + "SELECT src_table, ref_field, ref_month, status, count(*) AS n_refs FROM found WHERE status IS NOT NULL GROUP BY ALL",
    "p3_found": _P3,
    "p4_found": _P4 + "SELECT run_accession, canonical_field, cell_value FROM cells",
    "p4_wide": _P4_WIDE,
    "p5_found": _P5,
    "p5_table": _P5_TABLE,
    "p7_found": f"SELECT {_acc('study_accession')} AS study_accession FROM runs WHERE {_acc('study_accession')} IS NOT NULL GROUP BY 1 HAVING count(*) >= 0.05 * (SELECT count(*) FROM runs)",
    "p7_studies": f"SELECT {_acc('study_accession')} AS study_accession, count(*) AS n_rows, count(*) FILTER (state LIKE '%\\_FAILED' ESCAPE '\\') AS n_failed, min(ingested_at) AS first_at, max(ingested_at) AS last_at FROM runs GROUP BY 1",
}
