"""Run metadata: reports to runs, selection, ordered overrides, samplesheets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.scalars import accession_kind, basename, blank_to_null, file_kind, first_match, normalize_url, parse_setting, sanitize_basename
from cohortloom.functions.text import accession
from cohortloom.operators.eav import MAP_ROWS
from cohortloom.operators.skew import SHARD_ROWS, heavy_keys, replicate, spread

#: Columns that a predicate may name directly; any other field is looked up in the metadata.
CORE_FIELDS = (
    "project_id", "study_accession", "source_study_accession", "run_accession", "sample_accession",
    "experiment_accession", "library_layout", "instrument_platform", "instrument_model",
)
STRATEGIES = ("override", "prefer_local", "prefer_remote", "union_with_prefix")


# --- reports -------------------------------------------------------------------------------------


def remote_files(reports: DataFrame, key: str) -> DataFrame:
    """The files of each report row: ``key, file_no, url, md5, bytes, basename, kind, submitted, layout``.

    The lists are zipped by place before empty addresses are dropped, so checksums and sizes stay with
    their file. Sizes that are no number are null. Addresses are made https ones, and their last part,
    with odd characters replaced, is the name. FASTQ files come first, then submitted ones.
    """

    def listed(prefix: str, submitted: bool) -> Column:
        part = lambda c: F.transform(F.split(F.coalesce(F.col(f"{prefix}_{c}"), F.lit("")), ";"), lambda x: F.trim(x))
        zipped = F.arrays_zip(part("ftp").alias("url"), part("md5").alias("md5"), part("bytes").alias("bytes"))
        return F.transform(zipped, lambda z: F.struct(z["url"].alias("url"), z["md5"].alias("md5"), z["bytes"].alias("bytes"), F.lit(submitted).alias("submitted")))

    files = F.filter(F.concat(listed("fastq", False), listed("submitted", True)), lambda f: F.coalesce(f["url"], F.lit("")) != "")
    layout = F.upper(F.coalesce(blank_to_null("library_layout"), F.lit("UNKNOWN")))
    flat = reports.select(key, layout.alias("layout"), F.posexplode(files).alias("at", "f")).withColumn("url", normalize_url("f.url"))
    name = sanitize_basename(basename("url"))
    return flat.select(
        key, (F.col("at") + 1).cast("long").alias("file_no"), "url", F.nullif("f.md5", F.lit("")).alias("md5"),
        F.when(F.col("f.bytes").rlike("^[0-9]{1,18}$"), F.col("f.bytes")).try_cast("long").alias("bytes"),
        name.alias("basename"), file_kind(name, F.col("layout"), F.col("f.submitted")).alias("kind"), "f.submitted", "layout",
    )


def preferred_files(files: DataFrame, key: str, preference: str = "FASTQ") -> DataFrame:
    """Per row the FASTQ files, or the SRA ones, whichever are preferred and there; else all."""
    by_row = Window.partitionBy(key)
    fastq, sra = F.col("kind").startswith("FASTQ"), F.col("kind") == "SRA"
    first, second = (fastq, sra) if preference == "FASTQ" else (sra, fastq)
    has = lambda c: F.max(c.cast("int")).over(by_row) == 1
    marked = files.withColumns({"__a": has(first), "__b": has(second)})
    return marked.where(F.when(F.col("__a"), first).when(F.col("__b"), second).otherwise(True)).drop("__a", "__b")


def read_files(files: DataFrame, key: str) -> DataFrame:
    """The address of the first and the second read file of each row, null where there is none.

    The first read of a single-end run is its first FASTQ file, if none is marked.
    """
    pick = lambda fits: F.min_by("url", F.when(fits, F.col("file_no")))
    single = (F.col("kind") == "FASTQ") & (F.col("layout") == "SINGLE")
    return files.groupBy(key).agg(F.coalesce(pick(F.col("kind") == "FASTQ_R1"), pick(single)).alias("read1"), pick(F.col("kind") == "FASTQ_R2").alias("read2"))


def expected_bytes(files: DataFrame, key: str, preference: str = "FASTQ") -> DataFrame:
    """``key, bytes``: what a download of each row's files will take: those preferred, else the other kind, else all that are listed."""
    total = lambda fits: F.coalesce(F.sum(F.when(fits, F.col("bytes"))), F.lit(0).cast("long"))
    sums = files.groupBy(key).agg(total(F.col("kind").isin("FASTQ", "FASTQ_R1", "FASTQ_R2")).alias("FASTQ"), total(F.col("kind") == "SRA").alias("SRA"), total(F.lit(True)).alias("__all"))
    first, second = ("FASTQ", "SRA") if parse_setting("download", preference.lower()) == "FASTQ" else ("SRA", "FASTQ")
    return sums.select(key, F.when(F.col(first) > 0, F.col(first)).when(F.col(second) > 0, F.col(second)).otherwise(F.col("__all")).alias("bytes"))


def report_runs(reports: DataFrame, project_id: str) -> DataFrame:
    """Runs of report rows: the secondary study is preferred, the primary one kept; other fields become metadata.

    Blank and null texts are absent. The metadata map has an ``ena_`` prefix on its keys.
    """
    consumed = {
        "run_accession", "study_accession", "secondary_study_accession", "sample_accession", "experiment_accession", "library_layout",
        "instrument_platform", "instrument_model", "fastq_ftp", "fastq_md5", "fastq_bytes", "submitted_ftp", "submitted_md5", "submitted_bytes",
    }
    names = reports.columns
    text = lambda c: blank_to_null(F.col(c).cast("string")) if c in names else F.lit(None).cast("string")
    extra = [(f"ena_{c}", text(c)) for c in sorted(set(names) - consumed)]
    extra += [("ena_primary_study_accession", text("study_accession")), ("ena_secondary_study_accession", text("secondary_study_accession"))]
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in extra]), F.array(*[v for _, v in extra]))
    return reports.select(
        F.lit(project_id).alias("project_id"),
        F.coalesce(text("secondary_study_accession"), text("study_accession")).alias("study_accession"),
        F.when(text("secondary_study_accession").isNotNull(), text("study_accession")).alias("source_study_accession"),
        text("run_accession").alias("run_accession"),
        F.coalesce(text("sample_accession"), text("secondary_sample_accession")).alias("sample_accession"),
        text("experiment_accession").alias("experiment_accession"),
        F.coalesce(F.upper(text("library_layout")), F.lit("UNKNOWN")).alias("library_layout"),
        text("instrument_platform").alias("instrument_platform"),
        text("instrument_model").alias("instrument_model"),
        F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("metadata"),
        F.lit("RESOLVED").alias("state"),
    ).where(F.col("run_accession").isNotNull())


# --- selection -----------------------------------------------------------------------------------


class Predicate:
    """``field=value`` or ``field!=value``, compared in lower case without outer space; a missing field is never a match."""

    def __init__(self, text: str) -> None:
        operator = "!=" if "!=" in text else "="
        if operator not in text:
            raise ValueError(f"predicate needs = or !=: {text!r}")
        field, value = text.split(operator, 1)
        self.field, self.value, self.equal = field.strip().lower(), value.strip().lower(), operator == "="
        if not self.field or not self.value:
            raise ValueError(f"predicate needs a field and a value: {text!r}")

    def column(self, metadata: Column | None) -> Column:
        if self.field in CORE_FIELDS:
            held = F.col(self.field)
        elif metadata is None:
            return F.lit(False)
        else:
            mine = F.filter(F.map_entries(metadata), lambda e: F.lower(e["key"]) == self.field)
            held = F.try_element_at(F.transform(mine, lambda e: e["value"]), F.lit(1))
        low = F.lower(F.trim(held))
        return F.coalesce(low == self.value if self.equal else low != self.value, F.lit(False))


def split_inputs(inputs: DataFrame) -> DataFrame:
    """Project inputs with the kind of their accession; selectors keep their own type."""
    selector = F.col("input_type").isin("SAMPLE_INCLUDE", "SAMPLE_EXCLUDE", "FILTER_INCLUDE", "FILTER_EXCLUDE")
    return inputs.withColumn("kind", F.when(selector, F.col("input_type")).otherwise(accession_kind("input_id")))


def select_runs(
    runs: DataFrame, include_samples: DataFrame | None = None, exclude_samples: DataFrame | None = None,
    include: list[str] = (), exclude: list[str] = (), metadata: Column | None = None,
) -> DataFrame:
    """Runs in the included samples, not in the excluded ones, that meet all include and no exclude predicates.

    Sample sets have a column ``sample_accession`` and are compared in one spelling; null never matches.
    """
    wanted = [Predicate(p).column(metadata) for p in include] + [~Predicate(p).column(metadata) for p in exclude]
    out = runs.where(reduce(Column.__and__, wanted)) if wanted else runs
    out = out.withColumn("__s", accession("sample_accession"))
    for samples, how in ((include_samples, "left_semi"), (exclude_samples, "left_anti")):
        if samples is not None:
            out = out.join(samples.select(accession("sample_accession").alias("__s")).where(F.col("__s").isNotNull()), "__s", how)
    return out.select(*runs.columns)


# --- overrides -----------------------------------------------------------------------------------


def _merge_step(state: Column, step: Column) -> Column:
    """One override row applied to the metadata: existing map, (strategy, values) to the new map."""
    values = F.map_filter(step["vals"], lambda _, v: F.coalesce(F.trim(v), F.lit("")) != "")
    strategy = step["strategy"]
    both = F.map_zip_with(state, values, lambda _, old, new: F.coalesce(new, old))
    kept = F.map_zip_with(state, values, lambda _, old, new: F.coalesce(old, new))
    clash = F.map_filter(values, lambda k, v: F.coalesce(F.element_at(state, k) != v, F.lit(False)))
    prefixed = lambda prefix, source: F.transform_keys(F.map_filter(source, lambda k, _: F.map_contains_key(clash, k)), lambda k, _: F.concat(F.lit(prefix), k))
    union = F.map_zip_with(
        F.map_zip_with(kept, prefixed("remote_", state), lambda _, a, b: F.coalesce(b, a)), prefixed("local_", values), lambda _, a, b: F.coalesce(b, a)
    )
    return F.when(strategy == "prefer_remote", kept).when(strategy == "union_with_prefix", union).otherwise(both)


def matched_overrides(runs: DataFrame, overrides: DataFrame, run: str = "run_accession", sample: str = "sample_accession", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``run, ord, strategy, vals``: each override row once for each run that its run or its sample names.

    Two equi-joins, never one with OR; a null key never matches. ``overrides`` has ``ord``.
    """
    steps = overrides.select(accession("run_accession").alias("__r"), accession("sample_accession").alias("__s"), "ord", F.lower(F.trim("merge_strategy")).alias("strategy"), F.col("override_values").alias("vals"))
    held = runs.select(accession(run).alias("__r"), accession(sample).alias("__s")).where(F.col("__r").isNotNull()).distinct()
    by_run = steps.where(F.col("__r").isNotNull()).drop("__s").join(held.select("__r").distinct(), "__r")
    by_sample = steps.where(F.col("__s").isNotNull()).drop("__r")
    pairs = held.where(F.col("__s").isNotNull())
    heavy = heavy_keys(pairs, ["__s"], shard_rows)
    spread_out = spread(pairs, heavy, ["__s"], F.col("__r")).join(replicate(by_sample, heavy, ["__s"]), ["__s", "__shard"])
    columns = ["__r", "ord", "strategy", "vals"]
    return by_run.select(*columns).unionByName(spread_out.select(*columns)).dropDuplicates(["__r", "ord"])


def merge_overrides(runs: DataFrame, overrides: DataFrame, key: str = "run_accession", base: str = "metadata") -> DataFrame:
    """``key, metadata``: each run's metadata after all its override rows in order of ``ord``.

    ``override`` and ``prefer_local`` replace, ``prefer_remote`` keeps what is there,
    ``union_with_prefix`` keeps it and adds both values under ``remote_`` and ``local_`` where they
    differ. The fold is ordered, since the strategies do not commute. Blank values never count.
    """
    matched = matched_overrides(runs, overrides, key)
    steps = matched.groupBy("__r").agg(F.collect_list(F.struct("ord", "strategy", "vals")).alias("steps"))
    ordered = F.array_sort(F.col("steps"), lambda a, b: F.when(a["ord"] < b["ord"], -1).when(a["ord"] > b["ord"], 1).otherwise(0))
    start = F.coalesce(F.col(base), F.create_map().cast("map<string,string>"))
    joined = runs.withColumn("__r", accession(key)).join(steps, "__r", "left")
    folded = F.aggregate(F.coalesce(ordered, F.array().cast(steps.schema["steps"].dataType)), start, _merge_step)
    return joined.select(key, folded.alias(base))


def metadata_map(run_metadata: DataFrame, key: str = "run_accession") -> DataFrame:
    """The attribute rows of each run as one map: the latest value of each field name, blanks left out."""
    latest = run_metadata.where(F.coalesce(F.trim("field_value"), F.lit("")) != "").groupBy(accession(key).alias(key), "field_name").agg(F.max_by(F.trim("field_value"), F.struct("updated_at", "meta_id")).alias("v"))
    return latest.where(F.col(key).isNotNull()).groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field_name", "v")))).alias("metadata"))


def metadata_columns(run_metadata: DataFrame) -> DataFrame:
    """All field names in use."""
    return run_metadata.select("field_name").where(F.col("field_name").isNotNull()).distinct()


# --- samplesheet ---------------------------------------------------------------------------------


def suggest_canonical(c: Column) -> Column:
    """``condition`` or ``batch`` where a column's name suggests it."""
    low = F.lower(c)
    has = lambda *words: reduce(Column.__or__, [low.contains(w) for w in words])
    return first_match([(has("condition", "group", "treatment"), F.lit("condition")), (has("batch", "lane", "center"), F.lit("batch"))])


def samplesheet(runs: DataFrame, metadata: DataFrame, column_map: DataFrame, reads: DataFrame | None = None) -> DataFrame:
    """One row per run with condition and batch from its metadata, directly or through the column map.

    The first mapped source column in order of its name that the run has a value for counts. The column
    map is a configuration table; its pairs become literals, and longer ones are refused.
    """
    mapped: dict[str, list[str]] = {"condition": [], "batch": []}
    rows = column_map.where(F.col("canonical_field").isin(*mapped)).select("canonical_field", "source_column").distinct().limit(MAP_ROWS + 1).collect()
    if len(rows) > MAP_ROWS:
        raise ValueError(f"the column map has more than {MAP_ROWS} source columns of condition and batch")
    for r in rows:
        mapped[r[0]].append(r[1])
    out = runs.select("project_id", "study_accession", accession("run_accession").alias("run_accession"), "library_layout").dropDuplicates(["run_accession"])
    out = out.join(metadata, "run_accession", "left")
    value = lambda k: blank_to_null(F.element_at("metadata", F.lit(k)))
    picked = {name: F.coalesce(value(name), *[value(s) for s in sorted(sources) if s != name]) for name, sources in mapped.items()}
    out = out.withColumns(picked).drop("metadata")
    return out.join(reads, "run_accession", "left") if reads is not None else out

