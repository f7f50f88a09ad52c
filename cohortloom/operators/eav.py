"""Attribute-value rows into one wide, typed row per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.text import accession, field_key, strip

# Texts that stand for no value, in lower case.
UNUSABLE = ("", "-", "na", "n/a", "none", "null", "unknown", "missing", "not collected")
TRUE_WORDS = ("true", "yes", "y", "t", "1")
FALSE_WORDS = ("false", "no", "n", "f", "0")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

#: Column maps up to this many rows are broadcast; longer ones are joined by Spark's own choice.
MAP_ROWS = 10_000

_SQL_TYPE = {"integer": "decimal(38,0)", "decimal": "decimal(38,1)", "date": "date", "boolean": "boolean", "string": "string"}


def _integer(v: Column) -> Column:
    digits = F.regexp_extract(v, r"^[+-]?0*([0-9]+)(?:\.0*)?$", 1)
    sign = F.when(v.startswith("-") & (digits != "0"), "-").otherwise("")
    return F.when(digits != "", F.concat(sign, digits))


def _decimal(v: Column) -> Column:
    number = F.when(v.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"), v)
    return F.round(number.try_cast("decimal(38,12)"), 1).cast("decimal(38,1)").cast("string")


def _boolean(v: Column) -> Column:
    low = F.lower(v)
    return F.when(low.isin(*TRUE_WORDS), "true").when(low.isin(*FALSE_WORDS), "false")


_TIME = r"(?:[T ,]\s*[0-9]{1,2}:[0-9]{2}.*)?$"
_YEAR_FIRST = r"^([0-9]{4})([-/. ])([0-9]{1,2}|[A-Za-z]{3,9})\2([0-9]{1,2})" + _TIME
_COMPACT = r"^([0-9]{4})([0-9]{2})([0-9]{2})" + r"(?:[T ].*)?$"
_DAY_FIRST = r"^([0-9]{1,2})(?:st|nd|rd|th)?[-/. ]+([A-Za-z]{3,9})\.?[-/., ]+([0-9]{4})" + _TIME
_MONTH_FIRST = r"^([A-Za-z]{3,9})\.?[-/. ]+([0-9]{1,2})(?:st|nd|rd|th)?(?:,\s*|[-/. ]+)([0-9]{4})" + _TIME


def _month(text: Column) -> Column:
    """A month's number, two digits, from digits or an English name of three letters or in full; one look-up, so ``text`` is made once."""
    number = {}
    for i, name in enumerate(MONTHS, 1):
        for written in (str(i), f"{i:02d}", name, name[:3], *(["sept"] if name == "september" else [])):
            number[written] = f"{i:02d}"
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in number.items() for x in pair]), F.lower(text))


def _date(v: Column) -> Column:
    def build(pattern: str, year: int, month: int, day: int) -> Column:
        part = lambda i: F.regexp_extract(v, pattern, i)
        return F.concat_ws("-", part(year), F.coalesce(_month(part(month)), F.lit("x")), F.lpad(part(day), 2, "0"))

    text = (
        F.when(v.rlike(_YEAR_FIRST), build(_YEAR_FIRST, 1, 3, 4))
        .when(v.rlike(_COMPACT), build(_COMPACT, 1, 2, 3))
        .when(v.rlike(_DAY_FIRST), build(_DAY_FIRST, 3, 2, 1))
        .when(v.rlike(_MONTH_FIRST), build(_MONTH_FIRST, 3, 1, 2))
    )
    return text.try_cast("date").cast("string")


def usable_text(value: Column) -> Column:
    """``value`` without outer white space, or null if it stands for no value."""
    v = strip(value)
    return F.when(~F.lower(v).isin(*UNUSABLE), v)


def typed_usable(usable: Column, value_type: Column) -> Column:
    """A usable text in the one written form of its type, or null if it is not wholly of it."""
    return (
        F.when(value_type == "integer", _integer(usable))
        .when(value_type == "decimal", _decimal(usable))
        .when(value_type == "date", _date(usable))
        .when(value_type == "boolean", _boolean(usable))
        .when(value_type == "string", F.lower(usable))
    )


def typed_text(value: Column, value_type: Column) -> Column:
    """``value`` in the one written form of its type, or null if it is unusable or not wholly of it."""
    return typed_usable(usable_text(value), value_type)


def mapped_fields(column_map: DataFrame) -> DataFrame:
    """``field, canonical_field, value_type`` of the mapped source columns, one row per field."""
    return (
        column_map.where(F.col("canonical_field").isNotNull() & F.col("value_type").isNotNull())
        .groupBy(field_key("source_column").alias("field"))
        .agg(F.min_by(F.struct("canonical_field", F.lower(strip("value_type")).alias("value_type")), "canonical_field").alias("m"))
        .select("field", "m.*")
    )


def resolve_pairs(metadata: DataFrame, column_map: DataFrame) -> DataFrame:
    """One row per entity: maps of its resolved pairs and of the values that failed their type.

    ``metadata`` has ``meta_id, run_accession, field_name, field_value, updated_at``. Gives
    ``run_accession``, ``pairs`` (canonical field to written value, the latest usable one by
    ``updated_at`` then ``meta_id``) and ``failures`` (canonical field to the latest value that is
    neither blank nor of the field's type). Both come from one partial aggregation by (entity, field),
    so an entity with very many rows costs no more at the reducer than any other, and the maps have at
    most as many entries as there are canonical fields.

    Rows without accession or with an unmapped field take no part. Rows with a null time are the oldest.
    """
    fields = mapped_fields(column_map)
    small = F.broadcast(fields) if column_map.limit(MAP_ROWS + 1).count() <= MAP_ROWS else fields
    rows = metadata.select(
        accession("run_accession").alias("run_accession"), field_key("field_name").alias("field"),
        "field_value", F.struct("updated_at", "meta_id").alias("__ord"),
    ).where(F.col("run_accession").isNotNull())
    # In steps, so that each is made once a row and not wherever the next one names it.
    rows = rows.join(small, "field").withColumn("__usable", usable_text(F.col("field_value")))
    rows = rows.withColumn("cell", typed_usable(F.col("__usable"), F.col("value_type")))
    rows = rows.withColumn("bad", F.when(F.col("cell").isNull(), F.col("__usable")))
    cells = rows.groupBy("run_accession", "canonical_field").agg(
        F.max_by(F.when(F.col("cell").isNotNull(), F.col("cell")), F.when(F.col("cell").isNotNull(), F.col("__ord"))).alias("cell"),
        F.max_by("bad", F.when(F.col("bad").isNotNull(), F.col("__ord"))).alias("bad"),
    )
    entry = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("canonical_field", c)))))
    return cells.groupBy("run_accession").agg(entry("cell").alias("pairs"), entry("bad").alias("failures"))


def wide_table(resolved: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """One typed column per (canonical field, value type) of ``fields``, and the map of cast failures."""
    typed = [F.element_at("pairs", F.lit(name)).try_cast(_SQL_TYPE[kind]).alias(name) for name, kind in fields]
    return resolved.select("run_accession", *typed, F.col("failures").alias("cast_failures"))


def filled_cells(wide: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """The filled cells of the wide table as ``run_accession, canonical_field, cell_value``, in written form."""

    def written(name: str, kind: str) -> Column:
        value = F.col(name)
        if kind == "decimal":
            return value.cast("decimal(38,1)").cast("string")
        return F.date_format(value, "yyyy-MM-dd") if kind == "date" else value.cast("string")

    cells = F.array(*[F.struct(F.lit(n).alias("canonical_field"), written(n, k).alias("cell_value")) for n, k in fields])
    return wide.select("run_accession", F.explode(cells).alias("c")).select("run_accession", "c.*").where(F.col("cell_value").isNotNull())


def canonical_fields(column_map: DataFrame) -> list[tuple[str, str]]:
    """The canonical fields and their types, sorted. The map is a configuration table; longer ones are refused."""
    rows = mapped_fields(column_map).select("canonical_field", "value_type").distinct().limit(MAP_ROWS + 1).collect()
    if len(rows) > MAP_ROWS:
        raise ValueError(f"the column map has more than {MAP_ROWS} canonical fields")
    return sorted((r[0], r[1]) for r in rows)
