"""Scalar expressions: names, addresses, sizes, stable ids, durations, kinds."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Factors of size suffixes, in lower case.
SIZE_FACTORS = {
    "": 1, "b": 1,
    "k": 10**3, "kb": 10**3, "m": 10**6, "mb": 10**6, "g": 10**9, "gb": 10**9, "t": 10**12, "tb": 10**12,
    "kib": 2**10, "mib": 2**20, "gib": 2**30, "tib": 2**40,
}

#: Prefixes of accessions and the input kind each stands for.
ACCESSION_KINDS = {"RUN": ("SRR", "ERR", "DRR"), "STUDY": ("SRP", "ERP", "DRP"), "PROJECT": ("PRJ",), "SAMPLE": ("SRS", "ERS", "DRS", "SAM")}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(cases: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """The value of the first case whose condition holds."""
    out = reduce(lambda w, c: w.when(*c), cases[1:], F.when(*cases[0]))
    return out if otherwise is None else out.otherwise(otherwise)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def sanitize_basename(c: Column | str) -> Column:
    """Letters, digits, dot, underscore and dash stay; any other character becomes an underscore."""
    return F.regexp_replace(_col(c), "[^A-Za-z0-9._-]", "_")


def normalize_url(c: Column | str) -> Column:
    """FTP and bare addresses as https ones."""
    u = F.trim(_col(c))
    return first_match([(u.startswith("ftp://"), F.concat(F.lit("https://"), F.substr(u, F.lit(7)))), (u.rlike("^https?://"), u)], F.concat(F.lit("https://"), u))


def basename(c: Column | str) -> Column:
    return F.substring_index(_col(c), "/", -1)


def parse_size_bytes(c: Column | str) -> Column:
    """Bytes of a size such as ``1.5GiB``; null where it is none."""
    text = F.lower(F.trim(_col(c)))
    pattern = r"^([0-9]+(?:\.[0-9]+)?)\s*([a-z]*)$"
    number = F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double")
    suffix = F.regexp_extract(text, pattern, 2)
    factor = first_match([(suffix == k, F.lit(float(v))) for k, v in SIZE_FACTORS.items()])
    return F.round(number * factor).cast("long")


def strip_version(c: Column | str) -> Column:
    """A stable id up to its first dot."""
    return F.split_part(_col(c), F.lit("."), F.lit(1))


def strip_trailing_version(c: Column | str) -> Column:
    """A stable id without a last dot and digits."""
    return F.regexp_replace(_col(c), r"\.[0-9]+$", "")


def is_versioned(c: Column | str) -> Column:
    return _col(c).rlike(r"^.+\.[0-9]+$")


def split_list(c: Column | str) -> Column:
    """Trimmed items of a ``;`` list without the empty ones."""
    return F.filter(F.transform(F.split(_col(c), ";"), lambda x: F.trim(x)), lambda x: x != "")


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, or 0 where ``b`` is 0 or either is null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def ratio_pct(a: Column, b: Column) -> Column:
    """``a`` as a percentage of ``b``, or 0 where ``b`` is 0 or either is null."""
    return F.coalesce(F.try_divide(a * F.lit(100.0), b.cast("double")), F.lit(0.0))


def fixed(x: Column, digits: int) -> Column:
    """A number that is not negative with so many decimals, at least one, rounded by its exact binary value, halves to even.

    The usual formatting rounds the shortest decimal text instead, which is another number. Here the
    value is taken apart into whole multiples of 2^-68 and compared with the half between both texts.
    """
    unit, one = 10**digits, F.lit(Decimal(2**48))
    high = F.floor(x * F.lit(float(2**20))).cast("long")
    low = ((x * F.lit(float(2**20)) - high.cast("double")) * F.lit(float(2**48))).cast("long")
    exact = high.cast("decimal(20,0)") * one + low.cast("decimal(20,0)")
    down = F.floor(x * F.lit(float(unit))).cast("long")
    twice = exact.cast("decimal(32,0)") * F.lit(Decimal(2 * unit))
    half = (down.cast("decimal(17,0)") * 2 + 1) * F.lit(Decimal(2**68))
    up = (twice > half) | ((twice == half) & (down % 2 == 1))
    n = down + F.when(up, 1).otherwise(0)
    tail = F.pmod(n, F.lit(unit))
    return F.concat(F.floor((n - tail) / F.lit(unit)).cast("string"), F.lit("."), F.lpad(tail.cast("string"), digits, "0"))


def duration_from_rate(work: Column, rate: Column) -> Column:
    """Seconds that ``work`` takes: 0 without work, null without a rate."""
    return F.when(work <= 0, F.lit(0.0)).when(rate > 0, work / rate)


def format_duration(seconds: Column | str) -> Column:
    """``HH:MM:SS``; hours may have more digits; null for null."""
    s = F.floor(_col(seconds)).cast("long")
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    hours = F.floor(s / 3600).cast("long")
    text = F.concat_ws(":", F.when(hours < 100, pad(hours)).otherwise(hours.cast("string")), pad(F.floor(F.pmod(s, F.lit(3600)) / 60).cast("long")), pad(F.pmod(s, F.lit(60))))
    return F.when(s.isNotNull(), text)


def parse_instant(c: Column | str) -> Column:
    """A timestamp from RFC 3339 text; null where it is none."""
    text = F.trim(_col(c))
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"), text).try_cast("timestamp")


def accession_kind(c: Column | str) -> Column:
    """RUN, STUDY, PROJECT or SAMPLE by the prefix; null for any other text."""
    u = F.upper(F.trim(_col(c)))
    return first_match([(reduce(Column.__or__, [u.startswith(p) for p in prefixes]), F.lit(kind)) for kind, prefixes in ACCESSION_KINDS.items()])


def release_tag(c: Column | str) -> Column:
    """The release, such as v44 or vM33, in a file name."""
    return F.nullif(F.regexp_extract(_col(c), r"(vM?[0-9]+)", 1), F.lit(""))


def normalize_release(c: Column | str, organism: str) -> Column:
    """A release as its organism's files write it: ``44`` for human, ``M33`` for mouse; null if blank."""
    digits = F.nullif(F.regexp_extract(F.trim(_col(c)), r"^[vV]?[mM]?([0-9]+)$", 1), F.lit(""))
    return F.concat(F.lit("M"), digits) if organism == "mouse" else digits


def r_boolean(c: Column | str) -> Column:
    low = F.lower(F.trim(_col(c)))
    return F.when(low.isin("true", "t", "yes", "y", "1"), True).when(low.isin("false", "f", "no", "n", "0", ""), False)


def contrast_name(name: Column, factor: Column, a: Column, b: Column) -> Column:
    """A contrast's own name, or ``factor_A_vs_B``."""
    return F.coalesce(blank_to_null(name), F.format_string("%s_%s_vs_%s", factor, a, b))


def contrast_spec(c: Column | str) -> Column:
    """``factor, level_a, level_b, name`` of ``factor|A|B|name``; the name may be left out; null with fewer than three parts."""
    p = F.split(_col(c), r"\|")
    part = lambda i: F.get(p, F.lit(i))
    name = F.coalesce(F.nullif(part(3), F.lit("")), F.format_string("%s_%s_vs_%s", part(0), part(1), part(2)))
    return F.when(F.size(p) >= 3, F.struct(part(0).alias("factor"), part(1).alias("level_a"), part(2).alias("level_b"), name.alias("name")))


def blob_path(digest: Column) -> Column:
    """Place of a content-addressed blob."""
    return F.concat_ws("/", F.lit("blobs"), F.lit("sha256"), F.substr(digest, F.lit(1), F.lit(2)), F.substr(digest, F.lit(3), F.lit(2)), digest)


def file_kind(url_basename: Column, layout: Column, submitted: Column) -> Column:
    """Kind of a remote file by its name and the library's layout."""
    paired = F.upper(F.trim(layout)) == "PAIRED"
    return first_match(
        [
            (submitted & url_basename.endswith(".sra"), F.lit("SRA")),
            (paired & (url_basename.contains("_1.") | url_basename.contains("R1")), F.lit("FASTQ_R1")),
            (paired & (url_basename.contains("_2.") | url_basename.contains("R2")), F.lit("FASTQ_R2")),
            (paired & submitted, F.lit("SUBMITTED")),
        ],
        F.lit("FASTQ"),
    )


# Kinds of the files that the test of differential expression leaves behind, by name.
EXPRESSION_FILES = {
    "gene_counts.tsv": "COUNTS", "gene_counts_annotated.tsv": "COUNTS", "gene_norm_counts.tsv": "NORM_COUNTS", "gene_norm_counts_annotated.tsv": "NORM_COUNTS",
    "vst.tsv": "VST", "vst_annotated.tsv": "VST", "vst.rds": "VST_RDS", "deseq2_manifest.json": "MANIFEST",
}
# Kinds of the correlation's files by what is in their name, the first that fits.
CORRELATION_FILES = (
    ("edges", "CORR_EDGES"), ("dense", "CORR_DENSE"), ("modules_", "CORR_MODULES"), ("module_fgsea", "ENRICHMENT_TABLE"),
    ("module_t_values", "ENRICHMENT_TABLE"), ("adjusted_matrix", "ADJUSTED_MATRIX"),
)


def artifact_kind(path: Column | str, stage: str) -> Column:
    """Kind of an output of stage ``deseq2`` or ``corr`` by its file name; null for a file that is none."""
    n = basename(path)
    if stage == "deseq2":
        named = [(n == k, F.lit(v)) for k, v in EXPRESSION_FILES.items()]
        return first_match([*named, (n.startswith("de_") & n.endswith(".tsv"), F.lit("DE_TABLE")), (n.endswith("_manifest.json"), F.lit("MANIFEST"))])
    if stage == "corr":
        return first_match([*((n.contains(k), F.lit(v)) for k, v in CORRELATION_FILES), (n.endswith(".json"), F.lit("MANIFEST"))])
    raise ValueError(f"no outputs are known of stage {stage!r}")


# The spellings of settings, each with what it stands for.
SETTINGS = {
    "merge": {"override": "override", "prefer_remote": "prefer_remote", "prefer_local": "prefer_local", "union-with-prefix": "union_with_prefix", "union_with_prefix": "union_with_prefix"},
    "download": {"fastq": "FASTQ", "ena_fastq": "FASTQ", "sra": "SRA"},
    "cleanup": {"none": "none", "fastq": "fastq", "sra": "sra", "all": "all"},
    "retention": {"both": "both", "original": "original", "trimmed": "trimmed", "none": "none"},
}


def parse_setting(name: str, value: str) -> str:
    """The setting that ``value`` spells; any other text is an error."""
    if value not in SETTINGS[name]:
        raise ValueError(f"unsupported {name} setting: {value}")
    return SETTINGS[name][value]
