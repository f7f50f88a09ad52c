"""States of runs and stages, and the rules between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.scalars import parse_setting

# The states of a run, in the order of the pipeline.
RUN_STATES = (
    "NEW", "RESOLVED", "DOWNLOADING", "DOWNLOADED", "DOWNLOAD_FAILED", "VERIFIED", "VERIFY_FAILED",
    "PREPROCESS_RUNNING", "PREPROCESS_DONE", "PREPROCESS_FAILED", "QUANT_RUNNING", "QUANT_DONE", "QUANT_FAILED",
    "DE_RUNNING", "DE_DONE", "DE_FAILED", "CORR_RUNNING", "CORR_DONE", "CORR_FAILED", "CLEANED",
)
STAGE_STATES = ("PENDING", "RUNNING", "DONE", "FAILED")
QUANT_DONE = ("QUANT_DONE", "DE_RUNNING", "DE_DONE", "DE_FAILED", "CORR_RUNNING", "CORR_DONE", "CORR_FAILED", "CLEANED")
PREPROCESS_DONE = ("PREPROCESS_DONE", "QUANT_RUNNING", *QUANT_DONE)
DOWNLOAD_DONE = ("DOWNLOADED", "VERIFIED", "PREPROCESS_RUNNING", "PREPROCESS_FAILED", "QUANT_FAILED", *PREPROCESS_DONE)
DE_DONE = ("DE_DONE", "CORR_RUNNING", "CORR_DONE", "CORR_FAILED")
CORR_DONE = ("CORR_DONE", "CLEANED")
#: What an interrupted run goes back to at the next start.
RECOVERED = {"DOWNLOADING": "RESOLVED", "PREPROCESS_RUNNING": "PREPROCESS_FAILED", "QUANT_RUNNING": "QUANT_FAILED", "DE_RUNNING": "QUANT_DONE", "CORR_RUNNING": "DE_DONE"}
#: States in which a run has its checked files; any other with raw artifacts is behind what lies on disk.
VERIFIED_DONE = tuple(s for s in DOWNLOAD_DONE if s != "DOWNLOADED")
#: States from which finished quantification outputs move a run on.
BEFORE_QUANT = ("VERIFIED", "PREPROCESS_DONE", "QUANT_RUNNING", "QUANT_FAILED")
QUANT_KINDS = ("ABUNDANCE_H5", "RUN_INFO_JSON")
# Kinds of FASTQ artifacts that each retention policy removes.
TRIMMED_KINDS = ("FASTQ_TRIMMED_R1", "FASTQ_TRIMMED_R2", "FASTQ_TRIMMED_SINGLE")
ORIGINAL_KINDS = ("FASTQ_R1", "FASTQ_R2", "FASTQ_SINGLE")
REMOVED_KINDS = {"both": (), "original": TRIMMED_KINDS, "trimmed": ORIGINAL_KINDS, "none": (*ORIGINAL_KINDS, *TRIMMED_KINDS)}
RAW_KINDS = ("FASTQ_R1", "FASTQ_R2", "FASTQ_SINGLE", "SRA")


def is_done(state: Column, done: tuple[str, ...]) -> Column:
    return F.coalesce(state.isin(*done), F.lit(False))


def recovered(state: Column) -> Column:
    """The state after a crash: running ones fall back, the others stay."""
    out = F.when(F.lit(False), state)
    for old, new in RECOVERED.items():
        out = out.when(state == old, F.lit(new))
    return out.otherwise(state)


def known_state(state: Column) -> Column:
    """Whether the text is a state of runs at all."""
    return F.coalesce(state.isin(*RUN_STATES), F.lit(False))


def derived_state(passed: Column, has_quant: Column, has_trimmed: Column) -> Column:
    """The state that follows from the quality gate and the artifacts of a run."""
    return F.when(~passed, "PREPROCESS_FAILED").when(has_quant, "QUANT_DONE").when(has_trimmed, "PREPROCESS_DONE").otherwise("VERIFIED")


def state_flags(runs: DataFrame, key: str = "run_accession") -> DataFrame:
    """For each run which stages it is through."""
    s = F.col("state")
    names = {"download_done": DOWNLOAD_DONE, "preprocess_done": PREPROCESS_DONE, "quant_done": QUANT_DONE, "de_done": DE_DONE, "corr_done": CORR_DONE}
    return runs.select(key, "state", *[is_done(s, v).alias(k) for k, v in names.items()], recovered(s).alias("after_recovery"))


def removable(artifacts: DataFrame, policy: str) -> DataFrame:
    """The artifacts that a retention policy removes; deleting them is left to the caller."""
    kinds = REMOVED_KINDS[parse_setting("retention", policy)]
    return artifacts.where(F.col("kind").isin(*kinds)) if kinds else artifacts.where(F.lit(False))


def reconcile(runs: DataFrame, artifacts: DataFrame, key: str = "run_accession") -> DataFrame:
    """``key, state, new_state, event``: runs brought in line with the artifacts that are there after a restart.

    An interrupted state falls back first. Then a run that is not yet verified but has a raw file is
    verified, and one that waits for quantification, or failed in it, but has all its outputs is done.
    One aggregation of flags per run; the artifacts themselves are never collected.
    """
    flags = artifacts.where(F.col(key).isNotNull() & F.coalesce(F.col("bytes") > 0, F.lit(False))).groupBy(key).agg(
        F.bool_or(F.col("kind").isin(*RAW_KINDS)).alias("raw"), (F.count_distinct(F.when(F.col("kind").isin(*QUANT_KINDS), F.col("kind"))) == len(QUANT_KINDS)).alias("quant")
    )
    has = lambda name: F.coalesce(F.col(name), F.lit(False))
    back = recovered(F.col("state"))
    joined = runs.select(key, "state", back.alias("__back")).join(flags, key, "left")
    verified = F.when(~is_done(F.col("__back"), VERIFIED_DONE) & has("raw"), "VERIFIED").otherwise(F.col("__back"))
    after = joined.withColumn("__seen", verified)
    new = F.when(F.col("__seen").isin(*BEFORE_QUANT) & has("quant"), "QUANT_DONE").otherwise(F.col("__seen"))
    event = (
        F.when(new != F.col("__seen"), "quantification reconciled from existing outputs")
        .when(F.col("__seen") != F.col("__back"), "download state reconciled from existing artifacts")
        .when(F.col("__back") != F.col("state"), "interrupted work recovered")
    )
    return after.select(key, "state", new.alias("new_state"), event.alias("event"))
