"""Quality gates over preprocessing reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.scalars import fixed, ratio
from cohortloom.operators.states import derived_state


@dataclass(frozen=True)
class Gate:
    """Thresholds of the gate; None turns one off."""

    min_pass_rate: float | None = 0.60
    max_low_quality_rate: float | None = 0.30
    max_low_complexity_rate: float | None = None
    max_too_many_n_rate: float | None = 0.10
    max_too_short_rate: float | None = 0.40
    max_duplication_rate: float | None = None


_REPORT = (
    "mode STRING, threads BIGINT, passed_reads BIGINT, failed_reads BIGINT, adapter_trimmed_reads BIGINT, adapter_trimmed_bases BIGINT,"
    " summary STRUCT<before_filtering: STRUCT<total_reads: BIGINT>, after_filtering: STRUCT<total_reads: BIGINT>>,"
    " filtering_result STRUCT<passed_filter_reads: BIGINT, low_quality_reads: BIGINT, low_complexity_reads: BIGINT, too_many_N_reads: BIGINT, too_short_reads: BIGINT, too_long_reads: BIGINT>,"
    " duplication STRUCT<rate: DOUBLE>, adapter_cutting STRUCT<adapter_trimmed_reads: BIGINT, adapter_trimmed_bases: BIGINT>"
)
FAILURES = ("low_quality", "low_complexity", "too_many_n", "too_short")


def parse_report(json: Column) -> Column:
    """A preprocessing report as a struct; broken text gives null fields."""
    return F.from_json(json, _REPORT)


def qc_record(reports: DataFrame, report: str = "report") -> DataFrame:
    """The counts of each report with their fall-backs; the other columns stay.

    passed: the filter's count, else the plain one, else 0. failed: the plain count, else the sum of
    the failing kinds. total: what went in, and no less than passed and failed.
    """
    r = lambda path: F.col(f"{report}.{path}")
    zero = F.lit(0).cast("long")
    kinds = {"low_quality": "low_quality_reads", "low_complexity": "low_complexity_reads", "too_many_n": "too_many_N_reads", "too_short": "too_short_reads"}
    out = reports.withColumns({k: F.coalesce(r(f"filtering_result.{v}"), zero) for k, v in kinds.items()})
    out = out.withColumns(
        {
            "passed": F.coalesce(r("filtering_result.passed_filter_reads"), r("passed_reads"), zero),
            "failed": F.coalesce(r("failed_reads"), F.col("low_quality") + F.col("low_complexity") + F.col("too_many_n") + F.col("too_short")),
            "duplication_rate": r("duplication.rate"),
            "adapter_trimmed_reads": F.coalesce(r("adapter_cutting.adapter_trimmed_reads"), r("adapter_trimmed_reads"), zero),
            "mode": F.coalesce(r("mode"), F.lit("unknown")),
            "threads": F.coalesce(r("threads"), F.lit(1).cast("long")),
        }
    )
    both = F.col("passed") + F.col("failed")
    return out.withColumn("total", F.greatest(F.coalesce(r("summary.before_filtering.total_reads"), both), both)).drop(report)


def gate_rates(record: DataFrame) -> DataFrame:
    """The rates that the gate looks at, 0 where there are no reads."""
    total = F.col("total")
    return record.withColumns({"pass_rate": ratio(F.col("passed"), total)} | {f"{k}_rate": ratio(F.col(k), total) for k in FAILURES})


def apply_gate(rates: DataFrame, gate: Gate = Gate()) -> DataFrame:
    """``gate_passed`` and ``gate_reason``: the failed tests in a fixed order with rate and threshold, null if none failed."""
    most = {
        "low_quality_rate": gate.max_low_quality_rate, "low_complexity_rate": gate.max_low_complexity_rate, "too_many_n_rate": gate.max_too_many_n_rate,
        "too_short_rate": gate.max_too_short_rate, "duplication_rate": gate.max_duplication_rate,
    }
    limits = [("pass_rate", "<", gate.min_pass_rate), *((name, ">", limit) for name, limit in most.items())]

    def failed(name: str, sign: str, limit: float) -> Column:
        rate, bound = F.coalesce(name, F.lit(0.0)), F.lit(float(limit))
        text = F.concat(F.lit(f"{name} "), fixed(rate, 4), F.lit(f" {sign} {limit:.4f}"))
        return F.when(rate < bound if sign == "<" else rate > bound, text)

    tests = [failed(name, sign, limit) for name, sign, limit in limits if limit is not None]
    reason = F.nullif(F.concat_ws("; ", *tests), F.lit("")) if tests else F.lit(None).cast("string")
    return rates.withColumn("gate_reason", reason).withColumn("gate_passed", F.col("gate_reason").isNull())


def reevaluate(now: DataFrame, before: DataFrame, key: str = "run_accession") -> DataFrame:
    """Runs judged again against their earlier verdict: what changed, the state and error that follow, what to redo.

    ``now`` has ``gate_passed, gate_reason, has_quant, has_trimmed`` and may have the run's ``state`` and
    ``last_error``; runs without a report have a null ``gate_passed`` and stay as they are. ``before`` is
    the earlier verdict. A change is another verdict or reason, or the first one; later stages are redone
    where the verdict flipped or is new. An unchanged run keeps its state and error.
    """
    old = before.select(key, F.col("gate_passed").alias("old_passed"), F.col("gate_reason").alias("old_reason"))
    none = F.lit(None).cast("string")
    held = now.withColumns({c: none for c in ("state", "last_error") if c not in now.columns})
    joined = held.join(old, key, "left")
    judged = F.col("gate_passed").isNotNull()
    flipped = judged & (F.col("old_passed").isNull() | (F.col("old_passed") != F.col("gate_passed")))
    changed = flipped | (judged & ~F.col("old_reason").eqNullSafe(F.col("gate_reason")))
    state = F.when(changed, derived_state(F.col("gate_passed"), F.col("has_quant"), F.col("has_trimmed"))).otherwise(F.col("state"))
    error = F.when(changed & ~F.col("gate_passed"), F.col("gate_reason")).otherwise(F.col("last_error"))
    return joined.select(
        key, "gate_passed", "gate_reason", "state", "last_error", changed.alias("changed"), flipped.alias("invalidates"), state.alias("new_state"), error.alias("new_error"),
    )


def reevaluation_counts(judged: DataFrame) -> DataFrame:
    """One row that counts what ``reevaluate`` gave."""
    seen, c = F.col("gate_passed").isNotNull(), F.col
    moved = seen & (~c("new_state").eqNullSafe(c("state")) | ~c("new_error").eqNullSafe(c("last_error")))
    return judged.agg(
        F.count_if(seen).alias("qc_reevaluated"), F.count_if(c("gate_passed")).alias("qc_passed"), F.count_if(~c("gate_passed")).alias("qc_failed"),
        F.count_if(moved).alias("qc_state_changes"), F.count_if(c("changed")).alias("qc_gate_outcome_changed"), F.count_if(~seen).alias("qc_missing_reports"),
        F.coalesce(F.bool_or("invalidates"), F.lit(False)).alias("project_outputs_invalidated"),
    )


#: Stages of the project that are redone once a verdict flips.
REDONE_STAGES = ("normalize", "deseq2", "corr")


def invalidated_stages(stages: DataFrame, judged: DataFrame) -> DataFrame:
    """``stage, state`` with the later stages back to ``PENDING`` if any run invalidates them; others stay."""
    redo = judged.agg(F.coalesce(F.bool_or("invalidates"), F.lit(False))).scalar() & F.col("stage").isin(*REDONE_STAGES)
    return stages.select("stage", F.when(redo, "PENDING").otherwise(F.col("state")).alias("state"))
