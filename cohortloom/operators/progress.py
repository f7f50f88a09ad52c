"""Progress of a project: counts, rates, durations and expected times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.scalars import duration_from_rate, fixed, format_duration, ratio_pct
from cohortloom.operators import states as S

# The messages with which each stage begins and ends in the event log.
MESSAGES = {
    "download": ("download started", "download verified"),
    "preprocess": ("preprocessing started", "preprocessing completed"),
    "quant": ("quantification started", "quantification completed"),
    "deseq2": ("deseq2 stage started", "deseq2 stage completed"),
    "corr": ("corr stage started", "corr stage completed"),
}


def _seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two timestamps without zone, to the microsecond."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def _at(message: str, how, at: str = "at", name: str = "message") -> Column:
    return how(F.when(F.col(name) == message, F.col(at)))


def event_spans(events: DataFrame, run: str, started: str, done: str) -> DataFrame:
    """Per run the last start and the last end of a stage: ``run, started_at, done_at, seconds, amount``.

    One conditional aggregation. Runs without both, and those whose end is before their start, have
    null seconds. ``events`` has ``at, message, amount`` and ``seq``.
    """
    last = lambda m, v: F.max_by(v, F.when(F.col("message") == m, F.col("seq")))
    spans = events.groupBy(run).agg(last(started, "at").alias("started_at"), last(done, "at").alias("done_at"), last(done, "amount").alias("amount"))
    gap = _seconds(F.col("done_at"), F.col("started_at"))
    return spans.withColumn("seconds", F.when(gap >= 0, gap))


def throughput(spans: DataFrame) -> DataFrame:
    """Amount per second over completed spans, null if there is none."""
    done = F.col("seconds").isNotNull() & F.col("amount").isNotNull()
    return spans.agg(
        F.count_if(done).alias("n_spans"), F.sum(F.when(done, F.col("amount"))).alias("amount"), F.sum(F.when(done, F.col("seconds"))).alias("seconds"),
        F.try_divide(F.sum(F.when(done, F.col("amount"))), F.sum(F.when(done, F.col("seconds")))).alias("per_second"),
    )


def stage_rate(events: DataFrame, started: str, done: str) -> DataFrame:
    """Completed runs per second between the first start and the last end."""
    seconds = _seconds(_at(done, F.max), _at(started, F.min))
    n = F.count_if(F.col("message") == done)
    return events.agg(n.alias("n_done"), seconds.alias("seconds"), F.when(seconds > 0, n / seconds).alias("per_second"))


def stage_duration(events: DataFrame, stage: str, started: str, done: str) -> DataFrame:
    """For each stage the seconds from its last start to its last end."""
    return events.groupBy(stage).agg(_seconds(_at(done, F.max), _at(started, F.max)).alias("seconds"))


def processing_eta(p: Column, q: Column, d: Column, c: Column) -> Column:
    """Time of the stages still to come, from those whose time is known; not a sum of all that is known."""
    has = lambda *xs: F.lit(True) if not xs else (xs[0].isNotNull() if len(xs) == 1 else xs[0].isNotNull() & has(*xs[1:]))
    with_p = F.when(has(q, d, c), p + q + d + c).when(has(q), p + q).when(has(d, c), p + d + c).when(has(d), p + d).when(has(c), p + c).otherwise(p)
    without = F.when(has(q, d, c), q + d + c).when(has(q), q).when(has(d, c), d + c).when(has(d), d).when(has(c), c)
    return F.when(p.isNotNull(), with_p).otherwise(without)


def limiting_stage(download: Column, processing: Column) -> Column:
    return F.when(download.isNotNull() & (processing.isNull() | (download >= processing)), "download").when(processing.isNotNull(), "processing").otherwise("unknown")


def active_stage(quant: Column, preprocess: Column, download: Column, normalized: Column, correlated: Column, all_quant: Column) -> Column:
    """The stage at work, by a fixed precedence."""
    return (
        F.when(quant > 0, "quantification")
        .when(preprocess > 0, "preprocessing")
        .when(download > 0, "download")
        .when(normalized & ~correlated, "correlation")
        .when(all_quant & ~normalized, "normalization")
        .when(correlated, "complete")
        .otherwise("waiting")
    )


def byte_rate(events: DataFrame) -> DataFrame:
    """One row ``per_second``: bytes per second of the downloads, 0 where nothing is known.

    The sum over runs of the last start to the last end; if that gives nothing, all bytes from the
    first start to the last end of any run. ``events`` has ``stage, run, message, at, amount, seq``.
    """
    started, done = MESSAGES["download"]
    mine = events.where(F.col("stage") == "download")
    spans = event_spans(mine.where(F.col("run").isNotNull()), "run", started, done).where(F.col("seconds") > 0)
    exact = spans.agg(F.try_divide(F.sum(F.coalesce("amount", F.lit(0.0))), F.sum("seconds"))).scalar()
    seconds = _seconds(_at(done, F.max), _at(started, F.min))
    coarse = F.when(seconds > 0, F.sum(F.when(F.col("message") == done, F.col("amount"))) / seconds)
    whole = mine.agg(coarse.alias("coarse"))
    return whole.select(F.coalesce(F.when(exact > 0, exact), F.col("coarse"), F.lit(0.0)).alias("per_second"))


def snapshot(
    runs: DataFrame, artifacts: DataFrame, events: DataFrame, stages: DataFrame, expected: DataFrame, preprocess: bool = True,
) -> DataFrame:
    """One row: how far a project is, its rates and the expected times, all from its tables.

    ``runs`` has ``run_accession, state``, ``artifacts`` ``run_accession, kind, bytes``, ``events``
    ``stage, run, message, at, amount, seq``, ``stages`` ``stage, state`` and ``expected`` ``bytes`` of
    each run's download (``metadata.expected_bytes``). Each table is aggregated once to one row, and these
    rows meet as scalar values. Stages that are not known take no time in the sums; see ``processing_eta``.
    Empty tables count as zero; no runs at all are through every stage.
    """
    s = F.col("state")
    count = lambda states: F.count_if(s.isin(*states))
    raw = artifacts.where(F.col("kind").isin(*S.RAW_KINDS))
    got = raw.select("run_accession").union(runs.where(s.isin(*S.DOWNLOAD_DONE)).select("run_accession")).where(F.col("run_accession").isNotNull())
    rate = lambda stage: stage_rate(events.where(F.col("stage") == stage), *MESSAGES[stage]).select("per_second").scalar()
    lasts = lambda stage: events.where(F.col("stage") == stage).agg(_seconds(_at(MESSAGES[stage][1], F.max), _at(MESSAGES[stage][0], F.max))).scalar()
    stage_done = lambda *names: stages.agg(F.coalesce(F.bool_or(F.col("stage").isin(*names) & (s == "DONE")), F.lit(False))).scalar()
    before = ("PREPROCESS_DONE" if preprocess else "VERIFIED", "QUANT_RUNNING", "QUANT_FAILED", *(x for x in S.QUANT_DONE if x != "QUANT_DONE"))
    counts = runs.agg(
        F.count(F.lit(1)).alias("n_runs"), count(S.DOWNLOAD_DONE).alias("downloaded_states"), count(S.PREPROCESS_DONE).alias("preprocess_done"),
        count(S.QUANT_DONE).alias("quant_done"), count(S.DE_DONE).alias("de_done"), count(S.CORR_DONE).alias("corr_done"), F.count_if(s.endswith("_FAILED")).alias("failed"),
        count(("QUANT_RUNNING",)).alias("quantifying"), count(("PREPROCESS_RUNNING",)).alias("preprocessing"), count(("DOWNLOADING",)).alias("downloading"), count(before).alias("quant_waiting"),
    )
    c = F.col
    sized = counts.withColumns(
        {
            "preprocess_done": c("preprocess_done") if preprocess else c("n_runs"),
            "download_done": got.agg(F.count_distinct("run_accession")).scalar(),
            "downloaded_bytes": raw.agg(F.coalesce(F.sum("bytes"), F.lit(0))).scalar(),
            "normalize_done": stage_done("deseq2", "normalize") | (c("de_done") == c("n_runs")),
            "corr_complete": stage_done("corr") | (c("corr_done") == c("n_runs")),
            "byte_rate": byte_rate(events).scalar(),
            "preprocess_rate": F.coalesce(rate("preprocess"), F.lit(0.0)),
            "quant_rate": F.coalesce(rate("quant"), F.lit(0.0)),
            "de_seconds": lasts("deseq2"),
            "corr_seconds": lasts("corr"),
        }
    ).withColumn("expected_bytes", F.greatest(expected.agg(F.coalesce(F.sum("bytes"), F.lit(0))).scalar(), c("downloaded_bytes")))
    zero = F.lit(0.0)
    left = lambda a, b: F.greatest(a - b, F.lit(0))
    timed = sized.withColumns(
        {
            "download_eta": duration_from_rate(c("expected_bytes") - c("downloaded_bytes"), c("byte_rate")),
            "preprocess_eta": duration_from_rate(left(c("n_runs"), c("preprocess_done")), c("preprocess_rate")) if preprocess else zero,
            "quant_eta": duration_from_rate(left(c("quant_waiting"), c("quant_done")), c("quant_rate")),
            "de_eta": F.when(c("normalize_done"), zero).otherwise(F.when(c("de_seconds") > 0, c("de_seconds"))),
            "corr_eta": F.when(c("corr_complete"), zero).otherwise(F.when(c("corr_seconds") > 0, c("corr_seconds"))),
        }
    )
    timed = timed.withColumn("processing_eta", processing_eta(c("preprocess_eta"), c("quant_eta"), c("de_eta"), c("corr_eta")))
    out = timed.withColumns(
        {
            "total_eta": F.greatest("download_eta", "processing_eta"),
            "limiting_stage": limiting_stage(c("download_eta"), c("processing_eta")),
            "active_stage": active_stage(c("quantifying"), c("preprocessing"), c("downloading"), c("normalize_done"), c("corr_complete"), c("quant_done") == c("n_runs")),
        }
    )
    return out.withColumn("active_detail", active_detail(preprocess))


def active_detail(preprocess: bool = True) -> Column:
    """A sentence on the work at hand, from the columns of a snapshot."""
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    c, runs = F.col, F.col("n_runs")
    stage = c("active_stage")
    of_all = ("/", runs, " complete")
    done = text("preprocessing ", c("preprocessing"), " run(s); ", c("preprocess_done"), *of_all) if preprocess else F.lit("preprocessing disabled")
    return (
        F.when(stage == "download", text("downloading ", c("downloading"), " run(s); ", c("downloaded_states"), "/", runs, " completed"))
        .when(stage == "preprocessing", done)
        .when(stage == "quantification", text("quantifying ", c("quantifying"), " run(s); ", c("quant_done"), *of_all))
        .when(stage == "normalization", text("running DESeq2 normalization on ", runs, " samples"))
        .when(stage == "correlation", text("running adjusted correlation on ", runs, " samples"))
        .when(stage == "complete", text("all stages complete for ", runs, " runs"))
        .when(c("failed") > 0, text("waiting with ", c("failed"), " failed run(s) needing retry"))
        .otherwise("waiting for next eligible work item")
    )


def eta_text(seconds: Column, complete: Column) -> Column:
    """An expected time as text: what is known, zero once all is complete, else that it is being estimated."""
    return F.when(seconds.isNotNull() & (complete | (seconds > 0)), format_duration(seconds)).when(complete, "00:00:00").otherwise("estimating")


def status_report(snap: DataFrame, stored_bytes: Column, limit_bytes: int | None = None, qc: DataFrame | None = None, preprocess: bool = True) -> DataFrame:
    """``metric, value`` rows of a snapshot as the status command shows them.

    ``stored_bytes`` is what the project holds on disk; with ``limit_bytes`` its share is reported, 0 for
    a limit of 0. ``qc`` has ``gate_passed`` of each judged run.
    """
    c = F.col
    finished = c("active_stage") == "complete"
    part = lambda a, b: F.concat(a.cast("string"), F.lit("/"), b.cast("string"), F.lit(" ("), fixed(ratio_pct(a, b), 1), F.lit("%)"))
    flag = lambda x: F.when(x, "1/1 (100.0%)").otherwise("0/1 (0.0%)")
    known = lambda x, text: F.when(x > 0, text).otherwise("unknown")
    rows = {
        "runs_total": c("n_runs"),
        "active_storage_bytes": stored_bytes,
        "storage_limit_bytes": F.lit("unlimited" if limit_bytes is None else str(limit_bytes)),
        "storage_limit_utilization_pct": F.lit(None) if limit_bytes is None else fixed(ratio_pct(stored_bytes, F.lit(limit_bytes)), 1),
        "progress_download": part(c("download_done"), c("n_runs")),
        "progress_preprocess": part(c("preprocess_done"), c("n_runs")) if preprocess else F.lit("off"),
        "preprocess_qc_records": F.lit(0) if qc is None else qc.agg(F.count(F.lit(1))).scalar(),
        "preprocess_qc_failed": F.lit(0) if qc is None else qc.agg(F.count_if(~c("gate_passed"))).scalar(),
        "progress_quant": part(c("quant_done"), c("n_runs")),
        "progress_deseq2": flag(c("normalize_done")),
        "progress_corr": flag(c("corr_complete")),
        "downloaded_bytes": c("downloaded_bytes"),
        "expected_total_download_bytes": c("expected_bytes"),
        "download_speed_mbps": known(c("byte_rate"), fixed(c("byte_rate") / 1048576, 2)),
        "quant_rate_runs_per_hour": known(c("quant_rate"), fixed(c("quant_rate") * 3600, 2)),
        "eta_download": eta_text(c("download_eta"), c("download_done") >= c("n_runs")),
        "eta_processing": eta_text(c("processing_eta"), finished),
        "eta_total": eta_text(c("total_eta"), finished),
        "limiting_stage": c("limiting_stage"),
        "active": c("active_detail"),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("string").alias("value")) for k, v in rows.items()])
    return snap.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull())


def named_run_count(parts: list[DataFrame]) -> DataFrame:
    """``n_runs``: how many different runs several tables name, null ones left out."""
    keys = reduce(DataFrame.union, parts)
    return keys.agg(F.count_distinct(keys.columns[0]).alias("n_runs"))
