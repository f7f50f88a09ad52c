"""Counts to gene level, size factors, variance stabilisation and tests of differential expression."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.scalars import strip_version
from cohortloom.operators.design import column_basis
from cohortloom.operators.enrich import bh_adjust
from cohortloom.session import cut_lineage


def gene_abundance(transcripts: DataFrame, tx2gene: DataFrame) -> DataFrame:
    """Transcript rows ``tx, sample_id, counts, tpm, eff_length`` summed to genes.

    Gives ``gene_id, sample_id, counts, tpm, length``; the length is the mean of the effective lengths
    weighted by abundance, null where the gene has none. Versions of transcript ids are ignored; each
    transcript belongs to the first of its genes.
    """
    first = tx2gene.groupBy(strip_version("tx").alias("__tx")).agg(F.min("gene_id").alias("gene_id"))
    rows = transcripts.withColumn("__tx", strip_version("tx")).join(first, "__tx")
    weighted = F.try_divide(F.sum(F.col("tpm") * F.col("eff_length")), F.sum("tpm"))
    return rows.groupBy("gene_id", "sample_id").agg(F.sum("counts").alias("counts"), F.sum("tpm").alias("tpm"), weighted.alias("length"))


# How counts may be made of abundance.
COUNT_MODES = ("no", "scaledTPM", "lengthScaledTPM")


def gene_counts(genes: DataFrame, mode: str = "lengthScaledTPM") -> DataFrame:
    """``gene_id, sample_id, value`` of ``gene_abundance``: the counts as they are, or made of abundance.

    ``scaledTPM`` takes the abundance, ``lengthScaledTPM`` the abundance times the gene's mean length,
    each scaled to the sample's own total of counts. A sample without a length for a gene has the mean
    of the gene's others.
    """
    if mode not in COUNT_MODES:
        raise ValueError(f"unknown way to make counts: {mode!r}")
    if mode == "no":
        return genes.select("gene_id", "sample_id", F.col("counts").alias("value"))
    if mode == "scaledTPM":
        raw = genes.withColumn("raw", F.col("tpm"))
    else:
        mean = genes.groupBy("gene_id").agg(F.avg("length").alias("mean_length"))
        raw = genes.join(mean, "gene_id").withColumn("raw", F.col("tpm") * F.col("mean_length"))
    totals = raw.groupBy("sample_id").agg(F.sum("counts").alias("__c"), F.sum("raw").alias("__r"))
    scaled = raw.join(totals, "sample_id")
    return scaled.select("gene_id", "sample_id", F.coalesce(F.col("raw") * F.try_divide(F.col("__c"), F.col("__r")), F.lit(0.0)).alias("value"))


def check_runs(runs: int, stage: str) -> None:
    """At least two quantified runs are needed."""
    if runs < 2:
        raise ValueError(f"need at least 2 valid quantified runs for {stage}; found {runs}")


def size_factors(long: DataFrame, gene: str = "gene_id", sample: str = "sample_id") -> DataFrame:
    """``sample_id, size_factor``: median of a sample's ratios to the geometric means, over genes with all counts above 0."""
    logs = long.groupBy(gene).agg(F.min("value").alias("least"), F.avg(F.when(F.col("value") > 0, F.ln("value"))).alias("mean_log")).where(F.col("least") > 0)
    ratios = long.join(logs, gene).select(sample, (F.ln("value") - F.col("mean_log")).alias("x"))
    return ratios.groupBy(sample).agg(F.exp(F.percentile("x", F.lit(0.5))).alias("size_factor"))


def normalized(long: DataFrame, factors: DataFrame, sample: str = "sample_id") -> DataFrame:
    return long.join(factors, sample).withColumn("value", F.col("value") / F.col("size_factor")).drop("size_factor")


def vst(q: Column, asymptotic: float, extra: float) -> Column:
    """Closed form of the variance-stabilising transformation for a dispersion trend extra / mean + asymptotic."""
    a, e = F.lit(float(asymptotic)), F.lit(float(extra))
    return F.log2((1 + e + 2 * a * q + 2 * F.sqrt(a * q * (1 + e + a * q))) / (4 * a))


LEAST_DISPERSION = 1e-8
#: Least variance of the dispersions' prior, on the scale of logarithms.
LEAST_PRIOR = 0.25
#: Cells of the matrix that a task fits at a time.
FIT_CELLS = 1 << 21


def fit_trend(moments: DataFrame) -> tuple[float, float]:
    """``asymptotic, extra`` of the trend dispersion = extra / mean + asymptotic over ``mean, dispersion``.

    A regression with a gamma error and an identity link, refit without genes far off the trend until it
    rests. Each round is one aggregation of a few sums over all genes; the genes stay where they are. If
    no such trend with positive coefficients exists, it is flat at the mean dispersion.
    """
    y, x = F.col("dispersion"), 1 / F.col("mean")
    usable = cut_lineage(moments.where((F.col("mean") > 0) & (F.col("dispersion") > 100 * LEAST_DISPERSION)).select("mean", "dispersion"))
    a, e = 0.1, 1.0
    for _ in range(100):
        fitted = F.lit(a) + F.lit(e) * x
        near = usable.where((y / fitted > 1e-4) & (y / fitted < 15))
        w = 1 / (fitted * fitted)
        n, sw, sx, sxx, sy, sxy = near.agg(F.count(F.lit(1)), F.sum(w), F.sum(w * x), F.sum(w * x * x), F.sum(w * y), F.sum(w * x * y)).first()
        det = sw * sxx - sx * sx if n else 0.0
        new = ((sxx * sy - sx * sxy) / det, (sw * sxy - sx * sy) / det) if det else (0.0, 0.0)
        if min(new) <= 0:
            flat = usable.agg(F.avg("dispersion")).first()[0]
            return (flat if flat else LEAST_DISPERSION), 0.0
        moved = math.log(new[0] / a) ** 2 + math.log(new[1] / e) ** 2
        a, e = new
        if moved < 1e-6:
            break
    return a, e


def _trigamma(x: float) -> float:
    """Second derivative of the logarithm of the gamma function, for x > 0."""
    total = 0.0
    while x < 6:
        total += 1 / (x * x)
        x += 1
    return total + 1 / x + 1 / (2 * x * x) + 1 / (6 * x**3) - 1 / (30 * x**5) + 1 / (42 * x**7)


def shrunk_dispersions(moments: DataFrame, asymptotic: float, extra: float, freedom: int) -> DataFrame:
    """``moments`` with ``trend`` and ``alpha``: each gene's dispersion drawn towards the trend on the scale of logarithms.

    The weights are the sampling variance of a gene's own estimate, given the degrees of freedom, and the
    variance of the genes around the trend beyond that. Genes more than two deviations above keep their own.
    """
    trend = F.greatest(F.lit(LEAST_DISPERSION), F.lit(float(asymptotic)) + F.lit(float(extra)) / F.col("mean"))
    rows = moments.withColumn("trend", F.when(F.col("mean") > 0, trend)).withColumn("__off", F.ln("dispersion") - F.ln("trend"))
    known = rows.where(F.col("dispersion") > 100 * LEAST_DISPERSION)
    middle = known.agg(F.percentile_approx("__off", 0.5, 1_000_000)).first()[0] or 0.0
    spread = 1.4826 * (known.agg(F.percentile_approx(F.abs(F.col("__off") - middle), 0.5, 1_000_000)).first()[0] or 0.0)
    own = _trigamma(max(1, freedom) / 2)
    prior = max(spread**2 - own, LEAST_PRIOR)
    drawn = F.exp((F.ln("dispersion") / own + F.ln("trend") / prior) / (1 / own + 1 / prior))
    outlier = F.col("__off") > 2 * math.sqrt(prior + own)
    return rows.withColumn("alpha", F.when(outlier, F.col("dispersion")).otherwise(drawn)).drop("__off")


def _fit(y: np.ndarray, x: np.ndarray, log_size: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and their covariances of a negative binomial model with a log link for each row of ``y``."""
    a = alpha[:, None]
    mu = np.maximum(y, 0.5)
    eta = np.log(mu)
    ridge = np.eye(x.shape[1]) * 1e-6
    beta = np.zeros((len(y), x.shape[1]))
    cov = np.broadcast_to(ridge, (len(y), *ridge.shape)).copy()
    live = np.arange(len(y))
    for _ in range(100):
        w = mu / (1.0 + a * mu)
        z = eta - log_size + (y - mu) / mu
        cov[live] = np.linalg.inv(np.einsum("gn,np,nq->gpq", w, x, x, optimize=True) + ridge)
        new = np.einsum("gpq,gq->gp", cov[live], (w * z) @ x)
        moved = np.abs(new - beta[live]).max(1)
        beta[live] = new
        on = moved >= 1e-8
        if not on.any():
            break
        live, y, a, new = live[on], y[on], a[on], new[on]
        eta = np.clip(new @ x.T + log_size, -30.0, 30.0)
        mu = np.exp(eta)
    return beta, cov


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a column of equally long arrays; null values are NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    rows = max(1, FIT_CELLS // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def dispersion_moments(vectors: DataFrame, sizes: np.ndarray, design: np.ndarray, gene: str = "gene_id") -> DataFrame:
    """``gene_id, values, mean, dispersion``: mean of the normalised counts, and the moment estimate of the dispersion around the design's fit."""
    shared = vectors.sparkSession.sparkContext.broadcast((sizes, column_basis(design)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, q = shared.value
        freedom, inverse = max(1, len(size) - q.shape[1]), float((1 / size).mean())
        for batch in _chunks(batches, len(size)):
            norm = np.round(_matrix(batch.column(1))) / size
            mean = norm.mean(1)
            fitted = (norm @ q) @ q.T
            variance = ((norm - fitted) ** 2).sum(1) / freedom
            alpha = np.maximum(LEAST_DISPERSION, np.divide(variance - mean * inverse, (fitted**2).mean(1), out=np.zeros_like(mean), where=mean > 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mean), pa.array(alpha)], names=[gene, "values", "mean", "dispersion"])

    return vectors.select(gene, "values").mapInArrow(run, f"`{gene}` {vectors.schema[gene].dataType.simpleString()}, values array<double>, mean double, dispersion double")


def wald_test(vectors: DataFrame, sizes: np.ndarray, design: np.ndarray, contrasts: dict[str, np.ndarray], gene: str = "gene_id") -> DataFrame:
    """``contrast, gene_id, base_mean, log2_fold_change, lfc_se, stat, p_value, padj`` of contrasts of the design's coefficients.

    One negative binomial model per gene row ``gene_id, values``: dispersions by moments, a trend over
    their means, each gene's drawn towards it, then one fit for all contrasts. Genes without counts have
    nulls. Genes are fit in batches as arrays, on all tasks; what is broadcast has samples times
    coefficients.
    """
    moments = cut_lineage(dispersion_moments(vectors, sizes, design, gene))
    freedom = max(1, len(sizes) - column_basis(design).shape[1])
    rows = shrunk_dispersions(moments, *fit_trend(moments), freedom)
    names = list(contrasts)
    shared = vectors.sparkSession.sparkContext.broadcast((np.log(sizes), design, np.array([contrasts[n] for n in names])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_size, x, c = shared.value
        for batch in _chunks(batches, len(log_size)):
            mean, alpha = batch.column("mean").to_numpy(), batch.column("alpha").to_numpy(zero_copy_only=False)
            some = mean > 0
            y = np.round(_matrix(batch.column("values")))[some]
            beta, cov = _fit(y, x, log_size, alpha[some])
            for name, v in zip(names, c, strict=True):
                effect, se = beta @ v / math.log(2), np.sqrt(np.maximum(np.einsum("p,gpq,q->g", v, cov, v), 0.0)) / math.log(2)
                stat = np.divide(effect, se, out=np.zeros_like(effect), where=se > 0)
                p = np.array([math.erfc(abs(t) / math.sqrt(2)) for t in stat])

                def spread(values: np.ndarray, at: np.ndarray = some) -> pa.Array:
                    whole = np.zeros(len(at))
                    whole[at] = values
                    return pa.array(whole, mask=~at)

                label = pa.array([name] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([label, batch.column(gene), pa.array(mean), *map(spread, (effect, se, stat, p))], names=["contrast", gene, "base_mean", "log2_fold_change", "lfc_se", "stat", "p_value"])

    kind = vectors.schema[gene].dataType.simpleString()
    tested = rows.select(gene, "values", "mean", "alpha").mapInArrow(run, f"contrast string, `{gene}` {kind}, base_mean double, log2_fold_change double, lfc_se double, stat double, p_value double")
    return bh_adjust(tested, ["contrast"], order=[gene])


def stabilized(long: DataFrame, factors: DataFrame, samples: list, method: str = "vst", gene: str = "gene_id", sample: str = "sample_id") -> DataFrame:
    """``gene_id, sample_id, value``: counts on a scale of logarithms with even variance, without regard to the design.

    The dispersion trend is fit with an intercept alone. ``vst`` is the closed form for that trend;
    ``rlog`` draws the logarithm of each normalised count towards the gene's own mean, the more the less
    certain it is beside the spread of the genes' logarithms. This ridge estimate stands in for the
    iterative one of the published method.
    """
    from cohortloom.operators.matrix import to_vectors

    if method not in ("vst", "rlog"):
        raise ValueError(f"unknown transformation: {method!r}")
    sizes = {r[sample]: r["size_factor"] for r in factors.where(F.col(sample).isin(samples)).collect()}
    one = np.ones((len(samples), 1))
    moments = dispersion_moments(to_vectors(long, samples, gene, sample, missing=0.0), np.array([sizes[s] for s in samples]), one, gene)
    a, e = fit_trend(moments)
    norm = normalized(long, factors, sample)
    if method == "vst":
        return norm.select(gene, sample, vst(F.col("value"), a, e).alias("value"))
    stats = norm.groupBy(gene).agg(F.avg("value").alias("__mean"))
    some = norm.join(stats, gene).withColumns({"__x": F.log2(F.col("value") + 0.5), "__center": F.log2(F.col("__mean") + 0.5)})
    noise = (1 / (F.col("__mean") + 0.5) + F.lit(a) + F.lit(e) / (F.col("__mean") + 0.5)) / F.lit(math.log(2) ** 2)
    off = some.withColumns({"__off": F.col("__x") - F.col("__center"), "__noise": noise})
    prior = off.agg(F.greatest(F.lit(1e-3), F.avg(F.col("__off") * F.col("__off")) - F.avg("__noise"))).scalar()
    return off.select(gene, sample, (F.col("__center") + F.col("__off") * prior / (prior + F.col("__noise"))).alias("value"))


# --- contrasts ------------------------------------------------------------------------------------


def parse_contrasts(items: list[str]) -> list[tuple[str, str, str, str]]:
    """``(factor, level_a, level_b, name)`` of a flat list of triples."""
    if len(items) % 3:
        raise ValueError("contrasts come in groups of three: factor, level and level")
    return [contrast(f"{items[i]}|{items[i + 1]}|{items[i + 2]}") for i in range(0, len(items), 3)]


def contrast(text: str) -> tuple[str, str, str, str]:
    """``(factor, level_a, level_b, name)`` of ``factor|A|B`` or ``factor|A|B|name``."""
    parts = text.split("|")
    if len(parts) < 3:
        raise ValueError(f"invalid contrast: {text}")
    own = parts[3] if len(parts) > 3 else ""
    return parts[0], parts[1], parts[2], own or f"{parts[0]}_{parts[1]}_vs_{parts[2]}"


def check_contrasts(contrasts: list[tuple[str, str, str, str]], columns: list[str]) -> None:
    """Each contrast's factor has to be a column of the samplesheet."""
    for factor, *_ in contrasts:
        if factor not in columns:
            raise ValueError(f"contrast factor {factor!r} not found in samplesheet columns")


def contrast_vector(names: list[str], factor: str, a: str, b: str, levels: list[str]) -> np.ndarray:
    """Weights of the design's coefficients for level ``a`` against ``b`` of a factor; the first level is the base and has none."""
    out = np.zeros(len(names))
    for level, sign in ((a, 1.0), (b, -1.0)):
        if level not in levels:
            raise ValueError(f"{factor} has no level {level!r}")
        if f"{factor}={level}" in names:
            out[names.index(f"{factor}={level}")] += sign
        elif level != min(levels):
            raise ValueError(f"{factor} is no factor of the design")
    return out


def safe_name(text: str) -> str:
    """A contrast's name as part of a file's."""
    return re.sub("[^A-Za-z0-9._-]", "_", text)
