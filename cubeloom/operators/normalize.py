"""Dimension rules and row-level columns, each one projection without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeloom.functions import text
from cubeloom.functions.numbers import number_column, total
from cubeloom.spec import DEFAULT_SPEC, CubeSpec


class MissingColumnsError(ValueError):
    """Raised while the plan is built, before any data is read."""


def missing_measures(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> list[str]:
    present = set(df.columns)
    return [m for m in spec.measures if m not in present]


def require_measures(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> None:
    missing = missing_measures(df, spec)
    if missing:
        raise MissingColumnsError(f"missing required measures: {', '.join(missing)}")


def _text_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def add_missing_dims(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Dimensions an old layout lacks become null, never a guessed value."""
    absent = {d: F.lit(None).cast("string") for d in spec.raw_dims if d not in df.columns}
    return df.withColumns(absent) if absent else df


def tokens_as_null(df: DataFrame, columns: list[str], spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return df.withColumns({c: text.tokens_to_null(F.col(c), spec.na_tokens) for c in columns})


def normalize_dims(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Null for blanks, both income ranges kept apart, code prefixes, absent columns null."""
    wanted = {
        key: text.blank_to_null(_text_or_null(df, spec.raw_name[key])).alias(key)
        for key in spec.key_dims
    }
    if spec.period in df.columns:
        wanted = {spec.period: text.blank_to_null(F.col(spec.period)).alias(spec.period), **wanted}
    others = [F.col(c) for c in df.columns if c not in wanted and c not in spec.raw_dims]
    out = df.select(*wanted.values(), *others)
    return out.withColumns(
        {name: F.substring(F.col(src), 1, n) for name, (src, n) in spec.code_prefixes.items()}
    )


def repair_integer_codes(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    present = [c for c in spec.integer_code_dims if c in df.columns]
    return df.withColumns({c: text.strip_defensive_decimal(F.col(c)) for c in present})


def integer_code_repair_counts(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Values :func:`repair_integer_codes` would change, one count per column, one pass."""

    def count(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0).cast("bigint")
        return F.count_if(text.has_defensive_decimal(F.col(name)))

    return df.agg(*[count(c).alias(c) for c in spec.integer_code_dims])


def label_dims(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Blank labels become the blank label; decimal-looking sector codes become integers."""
    rules = {
        c: text.blank_to_label(F.col(c), spec.blank_label)
        for c in spec.label_dims
        if c in df.columns
    }
    rules |= {c: text.clean_sector_code(F.col(c)) for c in spec.sector_dims if c in df.columns}
    return df.withColumns(rules)


def key_expression(df: DataFrame, key: str, spec: CubeSpec = DEFAULT_SPEC) -> Column:
    """All rules of one key column in one small expression.

    Equal to repair, blank to null, then label, one after the other.  It is
    written against the raw column so that generated code stays short enough
    for the JIT compiler; nested rules would repeat each other's code.
    """
    if key == spec.period:
        return text.blank_to_null(F.col(key)).alias(key)
    col = _text_or_null(df, spec.raw_name[key])
    if key in spec.sector_dims:
        # this rule covers all the defensive-decimal repair does
        out = text.clean_sector_code(col)
    elif key in spec.label_dims:
        out = text.blank_to_label(col, spec.blank_label)
    elif spec.raw_name[key] in spec.integer_code_dims:
        out = F.when(col != "", text.strip_defensive_decimal(col))
    else:
        out = text.blank_to_null(col)
    return out.alias(key)


def derived_sums(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Row-wise sums of parts; null as soon as one part is null."""
    return df.withColumns(
        {name: total([F.col(p) for p in parts]) for name, parts in spec.derived_sums.items()}
    )


def measure_rows(raw: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Raw rows as key + numeric measures, still one row per raw row."""
    require_measures(raw, spec)
    return raw.select(
        *[key_expression(raw, k, spec) for k in spec.keys],
        *[number_column(raw, m).alias(m) for m in spec.measures],
    )


def cube_rows(raw: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """:func:`measure_rows` + derived sums."""
    return derived_sums(measure_rows(raw, spec), spec)


def fact_defaults(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Facts have no blank dimension and no null measure; ratios stay nullable."""

    def value(name: str) -> Column:
        if name in spec.key_dims:
            filled = F.coalesce(
                F.nullif(F.trim(F.col(name)), F.lit("")), F.lit(spec.unavailable)
            )
            return filled.alias(name)
        if name in spec.sums:
            return F.coalesce(F.col(name), F.lit(0.0)).alias(name)
        return F.col(name)

    return df.select(*[value(c) for c in df.columns])


STAGING_METADATA = ("period_fingerprint_hash", "source_url", "loaded_at", "created_at")


def staging_projection(
    df: DataFrame, run_id: str | Column, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """Cube rows of any text layout as the staging columns.

    Text is trimmed, blanks become null, thousands separators leave the numbers
    and the first known spelling of a column name wins.
    """

    def source(name: str) -> Column | None:
        for candidate in spec.column_aliases.get(name, (name,)):
            if candidate in df.columns:
                return F.nullif(text.strip(F.col(candidate).cast("string")), F.lit(""))
        return None

    def text_value(name: str) -> Column:
        col = source(name)
        return (F.lit(None).cast("string") if col is None else col).alias(name)

    def number_value(name: str) -> Column:
        if name in df.columns and df.schema[name].dataType.typeName() != "string":
            return F.col(name).cast("double").alias(name)
        col = source(name)
        if col is None:
            return F.lit(None).cast("double").alias(name)
        return F.replace(col, F.lit(","), F.lit("")).cast("double").alias(name)

    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    return df.select(
        run.alias("run_id"),
        *[text_value(c) for c in spec.keys],
        *[number_value(c) for c in (*spec.sums, *spec.fact_ratios)],
        *[text_value(c) for c in STAGING_METADATA],
    )


def recode(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Replace listed values of one column."""
    col = F.col(column)
    out = col
    for old, new in mapping.items():
        out = F.when(col == old, F.lit(new)).otherwise(out)
    return df.withColumn(column, out)


def annotate(df: DataFrame, column: str, rules: list[tuple[Column, str]]) -> DataFrame:
    """A comment column; later rules overwrite earlier ones, no rule leaves ''."""
    out = F.lit("")
    for condition, comment in rules:
        out = F.when(condition, F.lit(comment)).otherwise(out)
    return df.withColumn(column, out)


def fill_labels_and_numbers(
    df: DataFrame, labels: dict[str, str], numbers: dict[str, float]
) -> DataFrame:
    return df.fillna(labels).fillna(numbers)
