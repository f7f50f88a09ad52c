"""Queries of the metadata, control-plane and text operators, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import scalars as S
from cohortloom.functions.text import accession
from cohortloom.operators import annotate, catalog, metadata, progress, qc, states
from cohortloom.plans.problems_sql import _acc
from cohortloom.session import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """The last delivery of each run under one spelling of its accessions."""
    runs = table(spark, sf, "runs").withColumns({c: accession(c) for c in ("run_accession", "sample_accession", "study_accession")})
    return catalog.latest(runs.where(F.col("run_accession").isNotNull()), ["run_accession"], ["ingested_at", "ingest_id"])


_RUNS = f"""
WITH r AS (
  SELECT * REPLACE ({_acc('run_accession')} AS run_accession, {_acc('sample_accession')} AS sample_accession, {_acc('study_accession')} AS study_accession)
  FROM runs WHERE {_acc('run_accession')} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_acc('run_accession')} ORDER BY ingested_at DESC, ingest_id DESC) = 1
)
"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("user_id").alias("run"), F.col("event_type").alias("message"), F.col("ts").alias("at"), F.col("value").alias("amount"), F.col("event_id").alias("seq"))


# --- aggregates, limits ---------------------------------------------------------------------------


@query(_RUNS + "SELECT state, count(*) AS n_runs FROM r GROUP BY state")
def state_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _runs(spark, sf).groupBy("state").agg(F.count(F.lit(1)).alias("n_runs"))


@query("SELECT coalesce(sum(l_quantity), 0) AS total_bytes, coalesce(sum(l_quantity) FILTER (l_returnflag IN ('A', 'R')), 0) AS raw_bytes, count(DISTINCT l_orderkey) AS n_runs FROM lineitem")
def disk_usage(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    raw = F.when(F.col("l_returnflag").isin("A", "R"), F.col("l_quantity"))
    return items.agg(F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("total_bytes"), F.coalesce(F.sum(raw), F.lit(0.0)).alias("raw_bytes"), F.count_distinct("l_orderkey").alias("n_runs"))


@query("SELECT ingest_id, run_accession, last_error, updated_at FROM runs WHERE last_error IS NOT NULL ORDER BY updated_at DESC, ingest_id LIMIT 25")
def last_errors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "runs").where(F.col("last_error").isNotNull()).orderBy(F.col("updated_at").desc(), "ingest_id").limit(25).select("ingest_id", "run_accession", "last_error", "updated_at")


@query("SELECT event_id, ts, user_id, event_type FROM events ORDER BY event_id DESC LIMIT 50")
def latest_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").orderBy(F.col("event_id").desc()).limit(50).select("event_id", "ts", "user_id", "event_type")


@query("SELECT DISTINCT field_name FROM run_metadata WHERE field_name IS NOT NULL")
def metadata_fields(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.metadata_columns(table(spark, sf, "run_metadata"))


@query(f"""SELECT DISTINCT key FROM (SELECT {_acc('run_accession')} AS key FROM run_metadata UNION ALL SELECT {_acc('run_accession')} FROM override_rows) WHERE key IS NOT NULL""")
def named_runs(spark: SparkSession, sf: str) -> DataFrame:
    keys = [table(spark, sf, t).select(accession("run_accession").alias("key")) for t in ("run_metadata", "override_rows")]
    return catalog.key_union([k.where(F.col("key").isNotNull()) for k in keys])


# --- selection ------------------------------------------------------------------------------------


@query(
    _RUNS
    + f"""SELECT run_accession, sample_accession, library_layout, instrument_platform FROM r
WHERE coalesce(lower(trim(library_layout)) = 'paired', false) AND NOT coalesce(lower(trim(instrument_platform)) = 'illumina', false)
AND coalesce(lower(trim(study_accession)) <> 'srp990417', false)
AND sample_accession IS NOT NULL AND sample_accession NOT IN (SELECT {_acc('sample_accession')} FROM override_rows WHERE merge_strategy = 'override' AND {_acc('sample_accession')} IS NOT NULL)
AND run_accession IN (SELECT run_accession FROM r)"""
)
def selected_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = _runs(spark, sf)
    excluded = table(spark, sf, "override_rows").where(F.col("merge_strategy") == "override").select("sample_accession")
    chosen = metadata.select_runs(runs, runs.select("sample_accession"), excluded, ["library_layout=PAIRED", "study_accession!=SRP990417"], ["instrument_platform=illumina"])
    return chosen.select("run_accession", "sample_accession", "library_layout", "instrument_platform")


_KIND = "CASE WHEN {u} SIMILAR TO '(SRR|ERR|DRR).*' THEN 'RUN' WHEN {u} SIMILAR TO '(SRP|ERP|DRP).*' THEN 'STUDY' WHEN {u} LIKE 'PRJ%' THEN 'PROJECT' WHEN {u} SIMILAR TO '(SRS|ERS|DRS|SAM).*' THEN 'SAMPLE' END"


@query(
    f"""WITH ids AS (SELECT run_accession AS id FROM runs UNION SELECT study_accession FROM runs UNION SELECT sample_accession FROM runs UNION SELECT source_study_accession FROM runs UNION SELECT experiment_accession FROM runs)
SELECT id, {_KIND.format(u='upper(trim(id))')} AS kind FROM ids WHERE id IS NOT NULL"""
)
def accession_kinds(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "runs")
    ids = catalog.key_union([runs.select(F.col(c).alias("id")) for c in ("run_accession", "study_accession", "sample_accession", "source_study_accession", "experiment_accession")])
    return ids.where(F.col("id").isNotNull()).withColumn("kind", S.accession_kind("id"))


def _in(states_: tuple[str, ...]) -> str:
    return "state IN (" + ", ".join(f"'{s}'" for s in states_) + ")"


_RECOVERED = "CASE state " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in states.RECOVERED.items()) + " ELSE state END"


@query(
    _RUNS
    + f"""SELECT run_accession, state, {_in(states.DOWNLOAD_DONE)} AS download_done, {_in(states.PREPROCESS_DONE)} AS preprocess_done, {_in(states.QUANT_DONE)} AS quant_done,
{_in(states.DE_DONE)} AS de_done, {_in(states.CORR_DONE)} AS corr_done, {_RECOVERED} AS after_recovery FROM r"""
)
def run_state_flags(spark: SparkSession, sf: str) -> DataFrame:
    return states.state_flags(_runs(spark, sf))


# --- report files ---------------------------------------------------------------------------------

_LAST_REPORTS = f"""SELECT * REPLACE ({_acc('run_accession')} AS run_accession) FROM ena_reports WHERE {_acc('run_accession')} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {_acc('run_accession')} ORDER BY received_at DESC, report_row_id DESC) = 1"""

_FILES = """
WITH reports AS (SELECT * FROM ena_reports), u AS (
  SELECT report_row_id, library_layout, false AS submitted, coalesce(fastq_ftp, '') AS f, coalesce(fastq_md5, '') AS m, coalesce(fastq_bytes, '') AS b FROM reports
  UNION ALL SELECT report_row_id, library_layout, true, coalesce(submitted_ftp, ''), coalesce(submitted_md5, ''), coalesce(submitted_bytes, '') FROM reports
), e AS (
  SELECT report_row_id, library_layout, submitted, unnest(string_split(f, ';')) AS url, unnest(range(1, len(string_split(f, ';')) + 1)) AS i, string_split(m, ';') AS m, string_split(b, ';') AS b FROM u
), t AS (
  SELECT report_row_id, submitted, upper(coalesce(nullif(trim(library_layout, ' '), ''), 'UNKNOWN')) AS layout, i, trim(url, ' ') AS url, nullif(trim(m[i], ' '), '') AS md5,
    CASE WHEN regexp_full_match(trim(b[i], ' '), '[0-9]{1,18}') THEN CAST(trim(b[i], ' ') AS BIGINT) END AS bytes FROM e
), h AS (
  SELECT * REPLACE (CASE WHEN url LIKE 'ftp://%' THEN 'https://' || url[7:] WHEN url LIKE 'http://%' OR url LIKE 'https://%' THEN url ELSE 'https://' || url END AS url) FROM t WHERE url <> ''
), n AS (
  SELECT *, regexp_replace(string_split(url, '/')[-1], '[^A-Za-z0-9._-]', '_', 'g') AS basename FROM h
), files AS (
  SELECT report_row_id, row_number() OVER (PARTITION BY report_row_id ORDER BY submitted, i) AS file_no, url, md5, bytes, basename, submitted, layout, CASE
    WHEN submitted AND basename LIKE '%.sra' THEN 'SRA'
    WHEN layout = 'PAIRED' AND (contains(basename, '_1.') OR contains(basename, 'R1')) THEN 'FASTQ_R1'
    WHEN layout = 'PAIRED' AND (contains(basename, '_2.') OR contains(basename, 'R2')) THEN 'FASTQ_R2'
    WHEN layout = 'PAIRED' AND submitted THEN 'SUBMITTED' ELSE 'FASTQ' END AS kind
  FROM n
)
"""
_LAST_FILES = _FILES.replace("SELECT * FROM ena_reports", _LAST_REPORTS)


def _last_reports(spark: SparkSession, sf: str) -> DataFrame:
    """The last report of each run."""
    reports = table(spark, sf, "ena_reports").withColumn("run_accession", accession("run_accession")).where(F.col("run_accession").isNotNull())
    return catalog.latest(reports, ["run_accession"], ["received_at", "report_row_id"])


def _run_files(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.remote_files(_last_reports(spark, sf), "run_accession")


@query(_FILES + "SELECT report_row_id, file_no, url, md5, bytes, basename, kind, submitted, layout FROM files")
def remote_files(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.remote_files(table(spark, sf, "ena_reports"), "report_row_id")


@query(
    _FILES
    + """SELECT report_row_id, url, kind FROM (
SELECT *, bool_or(kind LIKE 'FASTQ%') OVER w AS a, bool_or(kind = 'SRA') OVER w AS b FROM files WINDOW w AS (PARTITION BY report_row_id))
WHERE CASE WHEN b THEN kind = 'SRA' WHEN a THEN kind LIKE 'FASTQ%' ELSE true END"""
)
def preferred_files(spark: SparkSession, sf: str) -> DataFrame:
    files = metadata.remote_files(table(spark, sf, "ena_reports"), "report_row_id")
    return metadata.preferred_files(files, "report_row_id", "SRA").select("report_row_id", "url", "kind")


@query(
    _FILES
    + """SELECT report_row_id, coalesce(arg_min(url, file_no) FILTER (kind = 'FASTQ_R1'), arg_min(url, file_no) FILTER (kind = 'FASTQ' AND layout = 'SINGLE')) AS read1,
arg_min(url, file_no) FILTER (kind = 'FASTQ_R2') AS read2 FROM files GROUP BY report_row_id"""
)
def read_files(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.read_files(metadata.remote_files(table(spark, sf, "ena_reports"), "report_row_id"), "report_row_id")


@query(
    """WITH t AS (SELECT *, nullif(trim(secondary_study_accession), '') AS s, nullif(trim(study_accession), '') AS p FROM ena_reports)
SELECT report_row_id, coalesce(s, p) AS study_accession, CASE WHEN s IS NOT NULL THEN p END AS source_study_accession, nullif(trim(run_accession), '') AS run_accession,
coalesce(nullif(trim(sample_accession), ''), nullif(trim(secondary_sample_accession), '')) AS sample_accession, coalesce(upper(nullif(trim(library_layout), '')), 'UNKNOWN') AS library_layout,
nullif(trim(library_strategy), '') AS strategy, p AS primary_study FROM t WHERE nullif(trim(run_accession), '') IS NOT NULL"""
)
def report_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = metadata.report_runs(table(spark, sf, "ena_reports"), "p")
    at = lambda k: F.element_at("metadata", F.lit(k))
    return runs.select(at("ena_report_row_id").cast("long").alias("report_row_id"), "study_accession", "source_study_accession", "run_accession", "sample_accession", "library_layout", at("ena_library_strategy").alias("strategy"), at("ena_primary_study_accession").alias("primary_study"))


# --- scalar functions -----------------------------------------------------------------------------


@query(
    """SELECT report_row_id, i AS file_no, CASE WHEN u LIKE 'ftp://%' THEN 'https://' || u[7:] WHEN u LIKE 'http://%' OR u LIKE 'https://%' THEN u ELSE 'https://' || u END AS url
FROM (SELECT report_row_id, unnest(range(1, len(string_split(fastq_ftp, ';')) + 1)) AS i, trim(unnest(string_split(fastq_ftp, ';')), ' ') AS u FROM ena_reports WHERE fastq_ftp IS NOT NULL) WHERE u <> ''"""
)
def url_normalize(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "ena_reports").select("report_row_id", F.posexplode(F.split("fastq_ftp", ";")).alias("at", "u")).where(F.trim("u") != "")
    return rows.select("report_row_id", (F.col("at") + 1).cast("long").alias("file_no"), S.normalize_url("u").alias("url"))


_SUFFIX = {0: "", 1: "k", 2: "MB", 3: " gib", 4: "tb", 5: "KiB", 6: "b", 7: "x"}


@query(
    """WITH t AS (SELECT p_partkey, p_size, p_partkey % 8 AS s FROM part)
SELECT p_partkey, CASE WHEN s = 7 THEN NULL ELSE CAST(round((p_size + 0.5) * CASE s WHEN 0 THEN 1 WHEN 1 THEN 1e3 WHEN 2 THEN 1e6 WHEN 3 THEN 1073741824.0 WHEN 4 THEN 1e12 WHEN 5 THEN 1024.0 ELSE 1 END) AS BIGINT) END AS n_bytes FROM t"""
)
def size_parse(spark: SparkSession, sf: str) -> DataFrame:
    suffix = F.element_at(F.array(*[F.lit(v) for v in _SUFFIX.values()]), (F.col("p_partkey") % 8 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", S.parse_size_bytes(F.concat(F.col("p_size").cast("string"), F.lit(".5"), suffix)).alias("n_bytes"))


@query(
    """WITH t AS (SELECT p_partkey, replace(p_brand, '#', '.') || CASE WHEN p_partkey % 3 = 0 THEN '.' || p_size WHEN p_partkey % 3 = 1 THEN '.1_PAR_Y' ELSE '' END AS id FROM part)
SELECT p_partkey, split_part(id, '.', 1) AS stem, regexp_replace(id, '\\.[0-9]+$', '') AS trailing, regexp_matches(id, '^.+\\.[0-9]+$') AS versioned FROM t"""
)
def stable_ids(spark: SparkSession, sf: str) -> DataFrame:
    tail = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("."), F.col("p_size").cast("string"))).when(F.col("p_partkey") % 3 == 1, ".1_PAR_Y").otherwise("")
    ids = table(spark, sf, "part").select("p_partkey", F.concat(F.replace("p_brand", F.lit("#"), F.lit(".")), tail).alias("id"))
    return ids.select("p_partkey", S.strip_version("id").alias("stem"), S.strip_trailing_version("id").alias("trailing"), S.is_versioned("id").alias("versioned"))


@query("SELECT p_partkey, regexp_replace(p_name || '/' || p_type, '[^A-Za-z0-9._-]', '_', 'g') AS file_name FROM part")
def basename_sanitize(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", S.sanitize_basename(F.concat_ws("/", "p_name", "p_type")).alias("file_name"))


@query(
    """WITH t AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS s FROM orders)
SELECT o_orderkey, CASE WHEN s // 3600 < 100 THEN lpad(CAST(s // 3600 AS VARCHAR), 2, '0') ELSE CAST(s // 3600 AS VARCHAR) END || ':' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS lasts FROM t"""
)
def duration_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", S.format_duration("o_totalprice").alias("lasts"))


@query("SELECT doc_id, md5(text) AS md5, 'blobs/sha256/' || substr(sha256(text), 1, 2) || '/' || substr(sha256(text), 3, 2) || '/' || sha256(text) AS blob FROM documents WHERE text IS NOT NULL")
def checksums(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").where(F.col("text").isNotNull())
    return docs.select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("md5"), S.blob_path(F.sha2(F.encode("text", "UTF-8"), 256)).alias("blob"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'own_' || n_name ELSE 'region_' || n_name || '_vs_' || r_name END AS contrast FROM nation JOIN region ON n_regionkey = r_regionkey")
def contrast_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    own = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("own_"), "n_name")).otherwise(" ")
    return rows.select("n_nationkey", S.contrast_name(own, F.lit("region"), F.col("n_name"), F.col("r_name")).alias("contrast"))


@query(
    _LAST_FILES
    + """SELECT run_accession, CASE WHEN fq > 0 THEN fq WHEN sra > 0 THEN sra ELSE everything END AS bytes FROM (
SELECT run_accession, coalesce(sum(bytes) FILTER (kind LIKE 'FASTQ%'), 0) AS fq, coalesce(sum(bytes) FILTER (kind = 'SRA'), 0) AS sra, coalesce(sum(bytes), 0) AS everything FROM files JOIN reports USING (report_row_id) GROUP BY 1)"""
)
def expected_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.expected_bytes(_run_files(spark, sf), "run_accession")


@query(f"""SELECT count(DISTINCT key) AS n_runs FROM (SELECT {_acc('run_accession')} AS key FROM ena_reports UNION ALL SELECT {_acc('run_accession')} FROM runs WHERE state = 'VERIFIED')""")
def named_run_count(spark: SparkSession, sf: str) -> DataFrame:
    verified = table(spark, sf, "runs").where(F.col("state") == "VERIFIED")
    return progress.named_run_count([d.select(accession("run_accession").alias("key")) for d in (table(spark, sf, "ena_reports"), verified)])


#: Names of outputs, one for each remainder of a part's number.
_OUTPUTS = (
    "gene_counts.tsv", "gene_counts_annotated.tsv", "gene_norm_counts.tsv", "vst.tsv", "vst.rds", "deseq2_manifest.json", "de_a_vs_b.tsv", "de_list.txt", "other_manifest.json",
    "edges_topk.tsv", "edges_topk_annotated.tsv", "corr_dense.tsv", "modules_top_genes.tsv", "module_fgsea.tsv", "module_t_values.tsv", "adjusted_matrix.tsv", "corr.json", "notes.txt",
)


@query(
    "WITH t AS (SELECT p_partkey, [" + ", ".join(f"'{n}'" for n in _OUTPUTS) + f"""][p_partkey % {len(_OUTPUTS)} + 1] AS n FROM part)
SELECT p_partkey, CASE WHEN n SIMILAR TO 'gene_counts(_annotated)?\\.tsv' THEN 'COUNTS' WHEN n SIMILAR TO 'gene_norm_counts(_annotated)?\\.tsv' THEN 'NORM_COUNTS' WHEN n SIMILAR TO 'vst(_annotated)?\\.tsv' THEN 'VST'
  WHEN n = 'vst.rds' THEN 'VST_RDS' WHEN n SIMILAR TO 'de_.*\\.tsv' THEN 'DE_TABLE' WHEN n SIMILAR TO '.*_manifest\\.json' THEN 'MANIFEST' END AS de_kind,
CASE WHEN contains(n, 'edges') THEN 'CORR_EDGES' WHEN contains(n, 'dense') THEN 'CORR_DENSE' WHEN contains(n, 'modules_') THEN 'CORR_MODULES' WHEN contains(n, 'module_fgsea') OR contains(n, 'module_t_values') THEN 'ENRICHMENT_TABLE'
  WHEN contains(n, 'adjusted_matrix') THEN 'ADJUSTED_MATRIX' WHEN n LIKE '%.json' THEN 'MANIFEST' END AS corr_kind FROM t"""
)
def artifact_kinds(spark: SparkSession, sf: str) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(f"out/{n}") for n in _OUTPUTS]), (F.col("p_partkey") % len(_OUTPUTS) + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", S.artifact_kind(name, "deseq2").alias("de_kind"), S.artifact_kind(name, "corr").alias("corr_kind"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, printf('%.4f', l_discount * l_tax * 10) AS rate, printf('%.2f', l_extendedprice / 7) AS price, printf('%.1f', l_quantity * 100.0 / 64) AS share FROM lineitem"""
)
def fixed_decimals(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", S.fixed(c("l_discount") * c("l_tax") * 10, 4).alias("rate"), S.fixed(c("l_extendedprice") / 7, 2).alias("price"),
        S.fixed(S.ratio_pct(c("l_quantity"), F.lit(64)), 1).alias("share"),
    )


@query(
    """WITH t AS (SELECT n_nationkey, 'region|' || n_name || '|' || r_name || CASE n_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN '|' ELSE '|own_' || n_name END AS spec FROM nation JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT n_nationkey, string_split(spec, '|') AS p FROM t)
SELECT n_nationkey, p[1] AS factor, p[2] AS level_a, p[3] AS level_b, coalesce(nullif(p[4], ''), p[1] || '_' || p[2] || '_vs_' || p[3]) AS name FROM p"""
)
def contrast_specs(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    tail = F.when(F.col("n_nationkey") % 3 == 0, "").when(F.col("n_nationkey") % 3 == 1, "|").otherwise(F.concat(F.lit("|own_"), "n_name"))
    spec = S.contrast_spec(F.concat(F.lit("region|"), "n_name", F.lit("|"), "r_name", tail))
    return rows.select("n_nationkey", spec.alias("s")).select("n_nationkey", "s.*")


@query(
    """WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 1 THEN '' ELSE p_brand || CASE WHEN p_partkey % 3 = 0 THEN '.2' ELSE '' END END AS id FROM part),
f AS (SELECT * FROM t ORDER BY p_partkey LIMIT 32) SELECT coalesce(arg_min(regexp_matches(id, '^.+\\.[0-9]+$'), p_partkey) FILTER (id <> ''), false) AS needs_rebuild FROM f"""
)
def rebuild_check(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("p_partkey") % 5 == 1, "").otherwise(F.concat("p_brand", F.when(F.col("p_partkey") % 3 == 0, ".2").otherwise("")))
    return annotate.needs_rebuild(table(spark, sf, "part").select("p_partkey", text.alias("gene_id")), "gene_id", "p_partkey")


@query(
    """WITH l AS (SELECT doc_id, unnest(regexp_extract_all(text, 'href="([^"]+)"', 1)) AS n FROM documents), k AS (
SELECT doc_id, count(*) AS n_links, max(n) FILTER (contains(n, '.example/') AND n LIKE '%.html' AND NOT contains(n, 'patch')) AS picked FROM l GROUP BY doc_id)
SELECT doc_id, n_links, picked FROM k"""
)
def listing_pick(spark: SparkSession, sf: str) -> DataFrame:
    names = annotate.listing_names(F.col("text"))
    docs = table(spark, sf, "documents").where(F.size(names) > 0)
    return docs.select("doc_id", F.size(names).cast("long").alias("n_links"), annotate.pick_listing(names, ".example/", ".html").alias("picked"))


# --- overrides, samplesheet -----------------------------------------------------------------------


def _merged(spark: SparkSession, sf: str, strategy: str | None) -> DataFrame:
    runs = _runs(spark, sf).withColumn("metadata", F.create_map(F.lit("rep"), F.col("instrument_platform"), F.lit("library_kit"), F.col("library_layout")))
    rows = table(spark, sf, "override_rows").withColumn("ord", F.col("override_row_id"))
    if strategy:
        rows = rows.withColumn("merge_strategy", F.lit(strategy))
    merged = metadata.merge_overrides(runs, rows)
    return merged.select("run_accession", F.explode("metadata").alias("field", "value"))


_STEPS = (
    _RUNS
    + f""", o AS (
  SELECT override_row_id AS ord, {_acc('run_accession')} AS ro, {_acc('sample_accession')} AS so, unnest(map_keys(override_values)) AS k, unnest(map_values(override_values)) AS v FROM override_rows
), hit AS (
  SELECT DISTINCT r.run_accession, o.ord, o.k, o.v FROM r JOIN o ON r.run_accession = o.ro WHERE trim(v) <> ''
  UNION SELECT DISTINCT r.run_accession, o.ord, o.k, o.v FROM r JOIN o ON r.sample_accession = o.so WHERE trim(v) <> ''
), steps AS (
  SELECT run_accession, -1 AS ord, 'rep' AS k, instrument_platform AS v FROM r UNION ALL SELECT run_accession, -1, 'library_kit', library_layout FROM r UNION ALL SELECT * FROM hit
)
"""
)


@query(_STEPS + "SELECT run_accession, k AS field, arg_max(v, ord) AS value FROM steps GROUP BY ALL")
def merge_override(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "override")


@query(_STEPS + "SELECT run_accession, k AS field, arg_min(v, ord) AS value FROM steps GROUP BY ALL")
def merge_prefer_remote(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "prefer_remote")


@query(
    _STEPS
    + """, kept AS (SELECT run_accession, k, arg_min(v, ord) AS v FROM steps GROUP BY ALL),
diff AS (SELECT s.run_accession, s.k, k.v AS remote, arg_max(s.v, s.ord) AS local FROM steps s JOIN kept k ON s.run_accession = k.run_accession AND s.k = k.k WHERE s.v <> k.v GROUP BY ALL)
SELECT run_accession, k AS field, v AS value FROM kept UNION ALL SELECT run_accession, 'remote_' || k, remote FROM diff UNION ALL SELECT run_accession, 'local_' || k, local FROM diff"""
)
def merge_union_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, "union_with_prefix")


@query(
    _STEPS.split(", o AS (", 1)[0]
    + f""", o AS (
  SELECT override_row_id AS ord, {_acc('run_accession')} AS ro, {_acc('sample_accession')} AS so, lower(trim(merge_strategy)) AS s, unnest(map_keys(override_values)) AS k, unnest(map_values(override_values)) AS v FROM override_rows
), hit AS (
  SELECT DISTINCT r.run_accession, o.ord, o.s, o.k, o.v FROM r JOIN o ON r.run_accession = o.ro WHERE trim(v) <> ''
  UNION SELECT DISTINCT r.run_accession, o.ord, o.s, o.k, o.v FROM r JOIN o ON r.sample_accession = o.so WHERE trim(v) <> ''
), steps AS (
  SELECT run_accession, -1 AS ord, 'override' AS s, 'rep' AS k, instrument_platform AS v FROM r UNION ALL SELECT run_accession, -1, 'override', 'library_kit', library_layout FROM r UNION ALL SELECT * FROM hit
), lists AS (
  SELECT run_accession, k, list(struct_pack(s := s, v := v, r := CAST(NULL AS VARCHAR), l := CAST(NULL AS VARCHAR)) ORDER BY ord) AS steps FROM steps GROUP BY ALL
), f AS (
  SELECT run_accession, k, list_reduce(steps, lambda a, x: struct_pack(s := a.s,
    v := CASE WHEN a.v IS NULL OR x.s NOT IN ('prefer_remote', 'union_with_prefix') THEN x.v ELSE a.v END,
    r := CASE WHEN x.s = 'union_with_prefix' AND a.v <> x.v THEN a.v ELSE a.r END, l := CASE WHEN x.s = 'union_with_prefix' AND a.v <> x.v THEN x.v ELSE a.l END)) AS z FROM lists
)
SELECT run_accession, k AS field, z.v AS value FROM f UNION ALL SELECT run_accession, 'remote_' || k, z.r FROM f WHERE z.r IS NOT NULL UNION ALL SELECT run_accession, 'local_' || k, z.l FROM f WHERE z.l IS NOT NULL"""
)
def merge_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Each override row by its own strategy, in order."""
    return _merged(spark, sf, None)


@query(
    _RUNS
    + f""", md AS (
  SELECT run_accession, field_name, arg_max(v, (updated_at, meta_id)) AS v FROM (SELECT {_acc('run_accession')} AS run_accession, field_name, trim(field_value, ' ') AS v, updated_at, meta_id FROM run_metadata)
  WHERE run_accession IS NOT NULL AND v <> '' GROUP BY ALL
), hits AS (
  SELECT md.run_accession, c.canonical_field, arg_min(md.v, (CASE WHEN c.source_column = c.canonical_field THEN 0 ELSE 1 END, c.source_column)) AS v
  FROM md JOIN column_map c ON md.field_name = c.source_column WHERE c.canonical_field IN ('condition', 'batch') GROUP BY ALL
)
SELECT r.project_id, r.study_accession, r.run_accession, r.library_layout, a.v AS condition, b.v AS batch
FROM r LEFT JOIN hits a ON r.run_accession = a.run_accession AND a.canonical_field = 'condition' LEFT JOIN hits b ON r.run_accession = b.run_accession AND b.canonical_field = 'batch'"""
)
def samplesheet(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.samplesheet(_runs(spark, sf), metadata.metadata_map(table(spark, sf, "run_metadata")), table(spark, sf, "column_map"))


@query(
    "SELECT source_column, CASE WHEN contains(source_column, 'condition') OR contains(source_column, 'group') OR contains(source_column, 'treatment') THEN 'condition' WHEN contains(source_column, 'batch') OR contains(source_column, 'lane') OR contains(source_column, 'center') THEN 'batch' END AS suggested FROM column_map"
)
def column_suggestions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "column_map").select("source_column", metadata.suggest_canonical(F.col("source_column")).alias("suggested"))


# --- catalog --------------------------------------------------------------------------------------


@query(_RUNS + f"SELECT run_accession, state FROM r WHERE run_accession NOT IN (SELECT {_acc('run_accession')} FROM run_metadata WHERE {_acc('run_accession')} IS NOT NULL)")
def backfill_runs(spark: SparkSession, sf: str) -> DataFrame:
    held = table(spark, sf, "run_metadata").select(accession("run_accession").alias("run_accession"))
    return catalog.backfill(_runs(spark, sf), held, "run_accession").select("run_accession", "state")


@query("SELECT l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey)) FILTER (l_returnflag = 'A') AS A, arg_min(l_partkey, (l_linenumber, l_partkey)) FILTER (l_returnflag = 'R') AS R FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_orderkey")
def first_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    return catalog.first_of_kind(items, "l_orderkey", ["A", "R"], ["l_linenumber", "l_partkey"], "l_returnflag", "l_partkey")


@query("SELECT o_orderkey, coalesce(n = 2, false) AS valid FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n FROM lineitem WHERE l_returnflag IN ('N', 'R') AND l_quantity > 10 GROUP BY 1) ON o_orderkey = l_orderkey")
def valid_outputs(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("kind"), (F.col("l_quantity") - 10).alias("bytes"))
    return catalog.split_valid(table(spark, sf, "orders").select("o_orderkey"), items, "o_orderkey", ["N", "R"])


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM (SELECT * REPLACE (coalesce(value, -1) AS value) FROM events) GROUP BY user_id")
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.coalesce("value", F.lit(-1.0)).alias("value"))
    return catalog.latest(log, ["user_id"], ["event_id"])


@query("SELECT user_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.earliest(table(spark, sf, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])


@query("SELECT user_id, event_type FROM (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id) WHERE event_type <> 'error'")
def tombstones(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"))
    return catalog.with_tombstones(log, ["user_id"], ["event_id"])


@query("SELECT feed_id, file_no, config_id, provider FROM resolver_configs QUALIFY file_no = max(file_no) OVER (PARTITION BY feed_id)")
def last_batches(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.last_batch(table(spark, sf, "resolver_configs"), ["feed_id"], "file_no").select("feed_id", "file_no", "config_id", "provider")


@query(
    f"""SELECT run, arg_max(library_layout, (ingested_at, ingest_id)) AS library_layout, arg_max(updated_at, (ingested_at, ingest_id)) AS updated_at, arg_min(state, (ingested_at, ingest_id)) AS state
FROM (SELECT *, {_acc('run_accession')} AS run FROM runs) WHERE run IS NOT NULL GROUP BY run"""
)
def upsert_keeps_state(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "runs").select(accession("run_accession").alias("run"), "ingested_at", "ingest_id", "library_layout", "updated_at", "state").where(F.col("run").isNotNull())
    return catalog.upsert_runs(log, ["run"], ["ingested_at", "ingest_id"], ["state"])


@query("SELECT o_orderkey, coalesce(s, o_orderstatus) AS state FROM orders LEFT JOIN (SELECT l_orderkey, arg_max(l_linestatus, (l_linenumber, l_partkey, l_suppkey)) AS s FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON o_orderkey = l_orderkey")
def state_changes(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("state"))
    changes = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("seq"), F.col("l_linestatus").alias("state"))
    return catalog.apply_state_changes(runs, changes, "o_orderkey")


# --- quality gate ---------------------------------------------------------------------------------

_GATE = qc.Gate(min_pass_rate=0.50, max_low_quality_rate=0.25, max_too_short_rate=0.26)


def _judged(spark: SparkSession, sf: str, gate: qc.Gate) -> DataFrame:
    """Reports made of the order lines of each supplier: what came back are failures."""
    amount = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))).cast("long")
    sums = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("run_accession")).agg(amount("N").alias("n"), amount("R").alias("r"), amount("A").alias("a"))
    json = F.to_json(F.struct(F.struct(F.col("n").alias("passed_filter_reads"), F.col("r").alias("low_quality_reads"), F.col("a").alias("too_short_reads")).alias("filtering_result")))
    record = qc.qc_record(sums.select("run_accession", qc.parse_report(json).alias("report")))
    return qc.apply_gate(qc.gate_rates(record), gate)


def _reason(name: str, count: str, sign: str, limit: float) -> str:
    return f"CASE WHEN {count} / total {sign} {limit} THEN printf('{name} %.4f {sign} {limit:.4f}', {count} / total) END"


_QC = f"""
WITH s AS (SELECT l_suppkey AS run_accession, CAST(sum(l_quantity) FILTER (l_returnflag = 'N') AS BIGINT) AS n, CAST(sum(l_quantity) FILTER (l_returnflag = 'R') AS BIGINT) AS r, CAST(sum(l_quantity) FILTER (l_returnflag = 'A') AS BIGINT) AS a FROM lineitem GROUP BY 1),
q AS (SELECT run_accession, coalesce(n, 0) AS passed, coalesce(r, 0) + coalesce(a, 0) AS failed, coalesce(n, 0) + coalesce(r, 0) + coalesce(a, 0) AS total, coalesce(r, 0) AS low, coalesce(a, 0) AS short FROM s),
j AS (SELECT *, nullif(concat_ws('; ', {_reason('pass_rate', 'passed', '<', 0.5)}, {_reason('low_quality_rate', 'low', '>', 0.25)}, {_reason('too_short_rate', 'short', '>', 0.26)}), '') AS reason,
  nullif(concat_ws('; ', {_reason('pass_rate', 'passed', '<', 0.6)}, {_reason('low_quality_rate', 'low', '>', 0.3)}, {_reason('too_short_rate', 'short', '>', 0.4)}), '') AS old FROM q)
"""


@query(_QC + "SELECT run_accession, passed, failed, total, round(passed / total, 6) AS pass_rate, reason AS gate_reason, reason IS NULL AS gate_passed FROM j")
def qc_gate(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf, _GATE).select("run_accession", "passed", "failed", "total", F.round("pass_rate", 6).alias("pass_rate"), "gate_reason", "gate_passed")


_STATES = "CASE run_accession % 4 WHEN 0 THEN 'QUANT_DONE' WHEN 1 THEN 'PREPROCESS_DONE' WHEN 2 THEN 'PREPROCESS_FAILED' ELSE 'VERIFIED' END"
_AGAIN = (
    _QC
    + f""", k AS (SELECT run_accession, run_accession % 9 <> 0 AS seen, reason, old, {_STATES} AS state, CASE WHEN run_accession % 4 = 2 THEN 'earlier' END AS last_error, run_accession % 10 <> 0 AS known FROM j),
x AS (SELECT *, seen AND (NOT known OR (reason IS NULL) <> (old IS NULL)) AS flip, seen AND (NOT known OR reason IS DISTINCT FROM old) AS changed FROM k),
y AS (SELECT run_accession, CASE WHEN seen THEN reason IS NULL END AS gate_passed, CASE WHEN seen THEN reason END AS gate_reason, state, last_error, changed, flip AS invalidates,
  CASE WHEN NOT changed THEN state WHEN reason IS NOT NULL THEN 'PREPROCESS_FAILED' WHEN run_accession % 3 = 0 THEN 'QUANT_DONE' WHEN run_accession % 3 = 1 THEN 'PREPROCESS_DONE' ELSE 'VERIFIED' END AS new_state,
  CASE WHEN changed AND reason IS NOT NULL THEN reason ELSE last_error END AS new_error FROM x)
"""
)


def _again(spark: SparkSession, sf: str) -> DataFrame:
    """Runs judged again; each ninth has no report, each tenth no earlier verdict."""
    run = F.col("run_accession")
    seen = run % 9 != 0
    now = _judged(spark, sf, _GATE).withColumns({"has_quant": run % 3 == 0, "has_trimmed": run % 3 == 1, "gate_reason": F.when(seen, F.col("gate_reason")), "gate_passed": F.when(seen, F.col("gate_passed"))})
    state = F.element_at(F.array(*[F.lit(x) for x in ("QUANT_DONE", "PREPROCESS_DONE", "PREPROCESS_FAILED", "VERIFIED")]), (run % 4 + 1).cast("int"))
    now = now.withColumns({"state": state, "last_error": F.when(run % 4 == 2, "earlier")})
    return qc.reevaluate(now, _judged(spark, sf, qc.Gate()).where(run % 10 != 0))


@query(_AGAIN + "SELECT * FROM y")
def qc_reevaluate(spark: SparkSession, sf: str) -> DataFrame:
    return _again(spark, sf)


@query(
    _AGAIN
    + """SELECT count(gate_passed) AS qc_reevaluated, count(*) FILTER (gate_passed) AS qc_passed, count(*) FILTER (NOT gate_passed) AS qc_failed,
count(*) FILTER (gate_passed IS NOT NULL AND (new_state <> state OR new_error IS DISTINCT FROM last_error)) AS qc_state_changes, count(*) FILTER (changed) AS qc_gate_outcome_changed,
count(*) FILTER (gate_passed IS NULL) AS qc_missing_reports, bool_or(invalidates) AS project_outputs_invalidated FROM y"""
)
def qc_counters(spark: SparkSession, sf: str) -> DataFrame:
    return qc.reevaluation_counts(_again(spark, sf))


@query(_AGAIN + "SELECT stage, CASE WHEN stage IN ('normalize', 'deseq2', 'corr') AND (SELECT bool_or(invalidates) FROM y) THEN 'PENDING' ELSE state END AS state FROM (" + "SELECT ['refs', 'quant', 'deseq2', 'corr', 'normalize'][r_regionkey + 1] AS stage, CASE WHEN r_regionkey % 2 = 0 THEN 'DONE' ELSE 'PENDING' END AS state FROM region)")
def invalidated_stages(spark: SparkSession, sf: str) -> DataFrame:
    return qc.invalidated_stages(_stages(spark, sf), _again(spark, sf))


def _stages(spark: SparkSession, sf: str) -> DataFrame:
    """States of the project's stages, one per region."""
    names = F.array(*[F.lit(x) for x in ("refs", "quant", "deseq2", "corr", "normalize")])
    key = F.col("r_regionkey")
    return table(spark, sf, "region").select(F.element_at(names, (key + 1).cast("int")).alias("stage"), F.when(key % 2 == 0, "DONE").otherwise("PENDING").alias("state"))


# --- progress -------------------------------------------------------------------------------------

_SPANS = """
WITH s AS (SELECT user_id AS run, arg_max(ts, event_id) FILTER (event_type = 'view') AS a, arg_max(ts, event_id) FILTER (event_type = 'purchase') AS b,
  max_by(value, event_id) FILTER (event_type = 'purchase' AND value IS NOT NULL) AS v, max(event_id) FILTER (event_type = 'purchase') AS last FROM events GROUP BY 1),
p AS (SELECT run, a AS started_at, b AS done_at, CASE WHEN b >= a THEN (epoch_us(b) - epoch_us(a)) / 1e6 END AS seconds, (SELECT e.value FROM events e WHERE e.event_id = last) AS amount FROM s)
"""


@query(_SPANS + "SELECT run, started_at, done_at, seconds, amount FROM p")
def event_spans(spark: SparkSession, sf: str) -> DataFrame:
    return progress.event_spans(_events(spark, sf), "run", "view", "purchase").select("run", "started_at", "done_at", "seconds", "amount")


@query(_SPANS + "SELECT count(*) AS n_spans, round(sum(amount), 4) AS amount, round(sum(seconds), 4) AS seconds, round(sum(amount) / sum(seconds), 9) AS per_second FROM p WHERE seconds IS NOT NULL AND amount IS NOT NULL")
def download_throughput(spark: SparkSession, sf: str) -> DataFrame:
    out = progress.throughput(progress.event_spans(_events(spark, sf), "run", "view", "purchase"))
    return out.select("n_spans", F.round("amount", 4).alias("amount"), F.round("seconds", 4).alias("seconds"), F.round("per_second", 9).alias("per_second"))


@query(
    """WITH t AS (SELECT count(*) FILTER (event_type = 'purchase') AS n_done, (epoch_us(max(ts) FILTER (event_type = 'purchase')) - epoch_us(min(ts) FILTER (event_type = 'view'))) / 1e6 AS seconds FROM events)
SELECT n_done, round(seconds, 4) AS seconds, CASE WHEN seconds > 0 THEN round(n_done / seconds, 9) END AS per_second FROM t"""
)
def stage_rate(spark: SparkSession, sf: str) -> DataFrame:
    out = progress.stage_rate(_events(spark, sf), "view", "purchase")
    return out.select("n_done", F.round("seconds", 4).alias("seconds"), F.round("per_second", 9).alias("per_second"))


@query("SELECT user_id % 5 AS stage, round((epoch_us(max(ts) FILTER (event_type = 'purchase')) - epoch_us(max(ts) FILTER (event_type = 'view'))) / 1e6, 4) AS seconds FROM events GROUP BY 1")
def stage_duration(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf).withColumn("stage", F.col("run") % 5)
    return progress.stage_duration(events, "stage", "view", "purchase").select("stage", F.round("seconds", 4).alias("seconds"))


def _count(states_: tuple[str, ...]) -> str:
    return f"count(*) FILTER ({_in(states_)})"


def _project(spark: SparkSession, sf: str, stages: DataFrame | None = None) -> DataFrame:
    """The snapshot of a project: runs, the first read files as what was downloaded, user events as those of five stages."""
    stage = F.element_at(F.array(*[F.lit(x) for x in progress.MESSAGES]), (F.col("user_id") % 5 + 1).cast("int"))
    words = F.element_at(F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in progress.MESSAGES.values()]), (F.col("user_id") % 5 + 1).cast("int"))
    message = F.when(F.col("event_type") == "view", words[0]).when(F.col("event_type") == "purchase", words[1])
    events = table(spark, sf, "events").select(
        stage.alias("stage"), F.col("user_id").alias("run"), message.alias("message"), F.col("ts").alias("at"), F.col("value").alias("amount"), F.col("event_id").alias("seq"),
    )
    files = _run_files(spark, sf)
    return progress.snapshot(_runs(spark, sf), files.where(F.col("file_no") == 1), events, _stages(spark, sf) if stages is None else stages, metadata.expected_bytes(files, "run_accession"))


_SNAPSHOT = (
    _LAST_FILES
    + ", r AS ("
    + _RUNS.split("r AS (", 1)[1]
    + f""", a AS (SELECT run_accession, bytes FROM files JOIN reports USING (report_row_id) WHERE file_no = 1 AND kind IN ('FASTQ_R1', 'FASTQ_R2', 'FASTQ_SINGLE', 'SRA')
), want AS (
  SELECT sum(CASE WHEN fq > 0 THEN fq WHEN sra > 0 THEN sra ELSE everything END) AS bytes FROM (
    SELECT coalesce(sum(bytes) FILTER (kind LIKE 'FASTQ%'), 0) AS fq, coalesce(sum(bytes) FILTER (kind = 'SRA'), 0) AS sra, coalesce(sum(bytes), 0) AS everything FROM files GROUP BY report_row_id)
), ev AS (
  SELECT user_id % 5 AS stage, user_id, event_type, ts, value, event_id FROM events
), span AS (
  SELECT (epoch_us(arg_max(ts, event_id) FILTER (event_type = 'purchase')) - epoch_us(arg_max(ts, event_id) FILTER (event_type = 'view'))) / 1e6 AS s,
    arg_max(coalesce(value, 0), event_id) FILTER (event_type = 'purchase') AS v FROM ev WHERE stage = 0 GROUP BY user_id
), rate AS (
  SELECT stage, count(*) FILTER (event_type = 'purchase') AS n, (epoch_us(max(ts) FILTER (event_type = 'purchase')) - epoch_us(min(ts) FILTER (event_type = 'view'))) / 1e6 AS s,
    (epoch_us(max(ts) FILTER (event_type = 'purchase')) - epoch_us(max(ts) FILTER (event_type = 'view'))) / 1e6 AS lasts, sum(value) FILTER (event_type = 'purchase') AS v FROM ev GROUP BY stage
), c AS (
  SELECT count(*) AS n_runs, {_count(states.DOWNLOAD_DONE)} AS downloaded_states, {_count(states.PREPROCESS_DONE)} AS preprocess_done, {_count(states.QUANT_DONE)} AS quant_done,
    {_count(states.DE_DONE)} AS de_done, {_count(states.CORR_DONE)} AS corr_done, count(*) FILTER (state LIKE '%\\_FAILED' ESCAPE '\\') AS failed,
    count(*) FILTER (state = 'QUANT_RUNNING') AS quantifying, count(*) FILTER (state = 'PREPROCESS_RUNNING') AS preprocessing, count(*) FILTER (state = 'DOWNLOADING') AS downloading,
    count(*) FILTER (state IN ('PREPROCESS_DONE', 'QUANT_RUNNING', 'QUANT_FAILED', 'DE_RUNNING', 'DE_DONE', 'DE_FAILED', 'CORR_RUNNING', 'CORR_DONE', 'CORR_FAILED', 'CLEANED')) AS waiting FROM r
), d AS (
  SELECT *, (SELECT count(DISTINCT k) FROM (SELECT run_accession AS k FROM a UNION ALL SELECT run_accession FROM r WHERE {_in(states.DOWNLOAD_DONE)})) AS download_done,
    (SELECT coalesce(sum(bytes), 0) FROM a) AS downloaded_bytes,
    coalesce((SELECT CASE WHEN sum(v) / sum(s) > 0 THEN sum(v) / sum(s) END FROM span WHERE s > 0), (SELECT CASE WHEN s > 0 THEN v / s END FROM rate WHERE stage = 0), 0) AS byte_rate,
    coalesce((SELECT CASE WHEN s > 0 THEN n / s END FROM rate WHERE stage = 1), 0) AS preprocess_rate, coalesce((SELECT CASE WHEN s > 0 THEN n / s END FROM rate WHERE stage = 2), 0) AS quant_rate,
    (SELECT CASE WHEN lasts > 0 THEN lasts END FROM rate WHERE stage = 4) AS corr_seconds FROM c
), w AS (
  SELECT *, greatest((SELECT bytes FROM want), downloaded_bytes) AS expected_bytes FROM d
), left_over AS (
  SELECT *, CASE WHEN expected_bytes <= downloaded_bytes THEN 0 WHEN byte_rate > 0 THEN (expected_bytes - downloaded_bytes) / byte_rate END AS download_eta,
    CASE WHEN n_runs <= preprocess_done THEN 0 WHEN preprocess_rate > 0 THEN (n_runs - preprocess_done) / preprocess_rate END AS p,
    CASE WHEN waiting <= quant_done THEN 0 WHEN quant_rate > 0 THEN (waiting - quant_done) / quant_rate END AS q,
    CASE WHEN corr_done = n_runs THEN 0 ELSE corr_seconds END AS cc, corr_done = n_runs AS corr_complete FROM w
), z AS (
  SELECT *, CASE WHEN p IS NOT NULL THEN CASE WHEN q IS NOT NULL AND cc IS NOT NULL THEN p + q + cc WHEN q IS NOT NULL THEN p + q WHEN cc IS NOT NULL THEN p + cc ELSE p END
    WHEN q IS NOT NULL AND cc IS NOT NULL THEN q + cc WHEN q IS NOT NULL THEN q WHEN cc IS NOT NULL THEN cc ELSE 0 END AS processing_eta,
    CASE WHEN quantifying > 0 THEN 'quantification' WHEN preprocessing > 0 THEN 'preprocessing' WHEN downloading > 0 THEN 'download' WHEN NOT corr_complete THEN 'correlation' ELSE 'complete' END AS active_stage FROM left_over
), snap AS (
  SELECT *, greatest(download_eta, processing_eta) AS total_eta, CASE WHEN download_eta >= processing_eta THEN 'download' ELSE 'processing' END AS limiting_stage, CASE active_stage
    WHEN 'quantification' THEN printf('quantifying %d run(s); %d/%d complete', quantifying, quant_done, n_runs) WHEN 'preprocessing' THEN printf('preprocessing %d run(s); %d/%d complete', preprocessing, preprocess_done, n_runs)
    WHEN 'download' THEN printf('downloading %d run(s); %d/%d completed', downloading, downloaded_states, n_runs) WHEN 'correlation' THEN printf('running adjusted correlation on %d samples', n_runs)
    ELSE printf('all stages complete for %d runs', n_runs) END AS active_detail FROM z
)
"""
)
@query(
    _SNAPSHOT
    + """SELECT n_runs, download_done, preprocess_done, quant_done, failed, true AS normalize_done, corr_complete, downloaded_bytes, expected_bytes, round(byte_rate, 9) AS byte_rate, round(preprocess_rate, 9) AS preprocess_rate,
round(quant_rate, 9) AS quant_rate, round(download_eta, 1) AS download_eta, round(processing_eta, 1) AS processing_eta, round(total_eta, 1) AS total_eta, limiting_stage, active_stage, active_detail FROM snap"""
)
def progress_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    r = lambda c, n: F.round(c, n).alias(c)
    return _project(spark, sf).select(
        "n_runs", "download_done", "preprocess_done", "quant_done", "failed", "normalize_done", "corr_complete", "downloaded_bytes", "expected_bytes", r("byte_rate", 9), r("preprocess_rate", 9),
        r("quant_rate", 9), r("download_eta", 1), r("processing_eta", 1), r("total_eta", 1), "limiting_stage", "active_stage", "active_detail",
    )


_HMS = "lpad(CAST({x} // 3600 AS VARCHAR), CAST(greatest(2, len(CAST({x} // 3600 AS VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST({x} % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({x} % 60 AS VARCHAR), 2, '0')"


def _eta(c: str, complete: str) -> str:
    seconds = f"CAST(floor({c}) AS BIGINT)"
    return f"CASE WHEN {c} IS NOT NULL AND ({complete} OR {c} > 0) THEN {_HMS.format(x=seconds)} WHEN {complete} THEN '00:00:00' ELSE 'estimating' END"


_PART = "printf('%d/%d (%.1f%%)', {a}, n_runs, {a} * 100.0 / n_runs)"
_LIMIT = 200_000_000_000


@query(
    _SNAPSHOT
    + f""", qc AS (SELECT l_suppkey, sum(l_quantity) FILTER (l_returnflag = 'N') * 2 >= sum(l_quantity) AS ok FROM lineitem GROUP BY 1), size AS (SELECT CAST(sum(l_extendedprice) AS BIGINT) AS b FROM lineitem),
rep AS (SELECT CAST(n_runs AS VARCHAR) AS runs_total, CAST((SELECT b FROM size) AS VARCHAR) AS active_storage_bytes, '{_LIMIT}' AS storage_limit_bytes, printf('%.1f', (SELECT b FROM size) * 100.0 / {_LIMIT}) AS storage_limit_utilization_pct,
  {_PART.format(a='download_done')} AS progress_download, {_PART.format(a='preprocess_done')} AS progress_preprocess, CAST((SELECT count(*) FROM qc) AS VARCHAR) AS preprocess_qc_records,
  CAST((SELECT count(*) FILTER (NOT ok) FROM qc) AS VARCHAR) AS preprocess_qc_failed, {_PART.format(a='quant_done')} AS progress_quant, '1/1 (100.0%)' AS progress_deseq2,
  CASE WHEN corr_complete THEN '1/1 (100.0%)' ELSE '0/1 (0.0%)' END AS progress_corr, CAST(downloaded_bytes AS VARCHAR) AS downloaded_bytes, CAST(expected_bytes AS VARCHAR) AS expected_total_download_bytes,
  CASE WHEN byte_rate > 0 THEN printf('%.2f', byte_rate / 1048576) ELSE 'unknown' END AS download_speed_mbps, CASE WHEN quant_rate > 0 THEN printf('%.2f', quant_rate * 3600) ELSE 'unknown' END AS quant_rate_runs_per_hour,
  {_eta('download_eta', 'download_done >= n_runs')} AS eta_download, {_eta('processing_eta', "active_stage = 'complete'")} AS eta_processing, {_eta('total_eta', "active_stage = 'complete'")} AS eta_total,
  limiting_stage, active_detail AS active FROM snap)
SELECT metric, value FROM (UNPIVOT rep ON COLUMNS(*) INTO NAME metric VALUE value)"""
)
def status_report(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    stored = items.agg(F.round(F.sum("l_extendedprice")).cast("long")).scalar()
    judged = items.groupBy("l_suppkey").agg((F.coalesce(F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity"))), F.lit(0.0)) * 2 >= F.sum("l_quantity")).alias("gate_passed"))
    return progress.status_report(_project(spark, sf), stored, _LIMIT, judged)


_POLICIES = {"both": "false", "original": "kind IN ('FASTQ_TRIMMED_R1', 'FASTQ_TRIMMED_R2', 'FASTQ_TRIMMED_SINGLE')", "trimmed": "kind IN ('FASTQ_R1', 'FASTQ_R2', 'FASTQ_SINGLE')", "none": "kind LIKE 'FASTQ%'"}
_KINDS = ("FASTQ_R1", "FASTQ_R2", "FASTQ_SINGLE", "FASTQ_TRIMMED_R1", "FASTQ_TRIMMED_R2", "FASTQ_TRIMMED_SINGLE", "SRA", "ABUNDANCE_H5", "RUN_INFO_JSON", "VST")


def _artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """Artifacts made of the order lines: their order is the run."""
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("l_partkey") % 10 + 1).cast("int"))
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run_accession"), kind.alias("kind"), "l_partkey", "l_linenumber", (F.col("l_quantity") - 5).alias("bytes"))


_ARTIFACTS = "art AS (SELECT l_orderkey AS run_accession, [" + ", ".join(f"'{k}'" for k in _KINDS) + "][l_partkey % 10 + 1] AS kind, l_partkey, l_linenumber, l_quantity - 5 AS bytes FROM lineitem)"


@query(f"WITH {_ARTIFACTS} " + " UNION ALL ".join(f"SELECT '{k}' AS policy, run_accession, kind, l_partkey, l_linenumber FROM art WHERE {v}" for k, v in _POLICIES.items()))
def retention_removals(spark: SparkSession, sf: str) -> DataFrame:
    rows = [states.removable(_artifacts(spark, sf), p).select(F.lit(p).alias("policy"), "run_accession", "kind", "l_partkey", "l_linenumber") for p in _POLICIES]
    return reduce(DataFrame.unionByName, rows)


_ORDER_STATE = "[" + ", ".join(f"'{x}'" for x in states.RUN_STATES) + f"][o_custkey % {len(states.RUN_STATES)} + 1]"


@query(
    f"""WITH {_ARTIFACTS}, st AS (SELECT o_orderkey AS run_accession, {_ORDER_STATE} AS state FROM orders), b AS (SELECT *, {_RECOVERED} AS back FROM st),
f AS (SELECT run_accession, bool_or(kind IN ('FASTQ_R1', 'FASTQ_R2', 'FASTQ_SINGLE', 'SRA')) AS raw, bool_or(kind = 'ABUNDANCE_H5') AND bool_or(kind = 'RUN_INFO_JSON') AS quant FROM art WHERE bytes > 0 GROUP BY 1),
v AS (SELECT b.*, CASE WHEN raw AND back IN ('NEW', 'RESOLVED', 'DOWNLOADING', 'DOWNLOADED', 'DOWNLOAD_FAILED', 'VERIFY_FAILED') THEN 'VERIFIED' ELSE back END AS seen, coalesce(quant, false) AS quant FROM b LEFT JOIN f USING (run_accession)),
n AS (SELECT *, CASE WHEN quant AND seen IN ('VERIFIED', 'PREPROCESS_DONE', 'QUANT_RUNNING', 'QUANT_FAILED') THEN 'QUANT_DONE' ELSE seen END AS new_state FROM v)
SELECT run_accession, state, new_state, CASE WHEN new_state <> seen THEN 'quantification reconciled from existing outputs' WHEN seen <> back THEN 'download state reconciled from existing artifacts' WHEN back <> state THEN 'interrupted work recovered' END AS event FROM n"""
)
def restart_states(spark: SparkSession, sf: str) -> DataFrame:
    state = F.element_at(F.array(*[F.lit(x) for x in states.RUN_STATES]), (F.col("o_custkey") % len(states.RUN_STATES) + 1).cast("int"))
    return states.reconcile(table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_accession"), state.alias("state")), _artifacts(spark, sf))


# --- annotation -----------------------------------------------------------------------------------


def _gtf(spark: SparkSession, sf: str) -> DataFrame:
    """Feature lines made of the parts: a gene per brand and size, a transcript per part."""
    text = (
        "concat('chr1\\tsrc\\t', if(p_partkey % 7 = 0, 'gene', 'transcript'), '\\t1\\t9\\t.\\t+\\t.\\t', if(p_partkey % 11 = 0, '', concat('gene_id \"', p_brand, '_', p_size, '.3\"; ')),"
        " if(p_partkey % 7 = 0, '', concat('transcript_id \"T', p_partkey, '.1\"; ')), 'gene_name \"', p_name, '\"; gene_biotype \"', p_type, '\";')"
    )
    return table(spark, sf, "part").select(F.col("p_partkey").alias("line_no"), F.expr(text).alias("value"))


@query(
    """SELECT p_brand || '_' || p_size AS gene_id, arg_min(p_name, (CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 1 END, p_partkey)) AS gene_name,
arg_min(p_type, (CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 1 END, p_partkey)) AS gene_biotype FROM part WHERE p_partkey % 11 <> 0 GROUP BY 1"""
)
def gtf_genes(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.gene_annotation(annotate.gtf_records(_gtf(spark, sf)))


@query("SELECT DISTINCT 'T' || p_partkey AS transcript_id, p_brand || '_' || p_size AS gene_id FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 7 <> 0")
def gtf_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return annotate.tx2gene(annotate.gtf_records(_gtf(spark, sf)))


@query("SELECT r_name, 'human_gencode_' || 'v' || r_regionkey || '_txall_v2' AS by_release, 'custom_' || substr(sha256(r_name), 1, 12) || '_' || substr(sha256(upper(r_name) || 'x'), 1, 12) AS by_content FROM region")
def reference_ids(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("r_name")
    release = F.concat(F.lit("v"), F.col("r_regionkey").cast("string"))
    made = lambda r: annotate.reference_id(F.concat(F.upper(name), F.lit("x")), name, F.lit("human"), r)
    return table(spark, sf, "region").select("r_name", made(release).alias("by_release"), made(F.lit(None).cast("string")).alias("by_content"))
