"""Column and table profiles.

Distinct counts of many columns run over (column, value) rows that are counted
per value first, so no task sees more than combined counts, however many
columns or rows a table has.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubeloom.functions.numbers import exact_sum, from_exact, parse_number, wide_unit_sum
from cubeloom.functions.text import comparable_text, strip
from cubeloom.spec import DEFAULT_SPEC, CubeSpec


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows of the given columns."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "columna", "valor"
    )


def _stack(one_row: DataFrame, columns: list[str], fields: list[str]) -> DataFrame:
    """One row of '<field>__<column>' cells as one row per column."""
    cells = [
        F.struct(F.lit(c).alias("columna"), *[F.col(f"`{f}__{c}`").alias(f) for f in fields])
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame, top: int | None = None) -> DataFrame:
    """Nulls per column, most first; one aggregate over one scan."""
    columns = df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_count__{c}") for c in columns])
    out = _stack(counts, columns, ["null_count"]).orderBy(F.col("null_count").desc(), "columna")
    return out.limit(top) if top else out


def value_counts(df: DataFrame, columns: list[str], k: int | None = None) -> DataFrame:
    """Counts and share of every non-null value, optionally the k most frequent per column."""
    counts = (
        _as_text(df, columns)
        .filter(F.col("valor").isNotNull())
        .groupBy("columna", "valor")
        .agg(F.count("*").alias("cantidad"))
    )
    if k is not None:
        order = Window.partitionBy("columna").orderBy(F.col("cantidad").desc(), "valor")
        counts = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    # the share is taken over all rows, null ones too
    rows = df.agg(F.count("*")).scalar()
    return counts.withColumn("porcentaje", F.col("cantidad") / rows * 100)


def column_profile(df: DataFrame, top: int = 5) -> DataFrame:
    """Forensic profile of every column.

    Nulls and their share, distinct raw and comparable values, their gap
    ('ghost' values), the most frequent comparable values, and min, max and
    mean of finite numbers beside the count of others.
    """
    columns = df.columns
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]

    def cells(name: str) -> list[Column]:
        number = F.col(name).cast("double") if name in numbers else F.lit(None).cast("double")
        value = F.when(F.abs(number) < F.lit(float("inf")), number)
        return [
            F.count(F.lit(1)).alias(f"_rows__{name}"),
            F.count_if(F.col(name).isNull()).alias(f"valores_nulos__{name}"),
            F.count_if(number.isNotNull() & value.isNull()).alias(f"no_finitos__{name}"),
            F.min(value).alias(f"min__{name}"),
            F.max(value).alias(f"max__{name}"),
            F.round(exact_sum(value) / F.nullif(F.count(value), F.lit(0)), 2).alias(
                f"media__{name}"
            ),
        ]

    # nulls and numbers from one plain aggregate; (column, value) rows only for what needs them
    fields = ["_rows", "valores_nulos", "no_finitos", "min", "max", "media"]
    plain = _stack(df.agg(*[c for n in columns for c in cells(n)]), columns, fields)
    raw = _as_text(df, columns).groupBy("columna", "valor").agg(F.count("*").alias("n"))
    is_text = F.col("columna").isin(*texts) if texts else F.lit(False)
    comparable = F.when(is_text, comparable_text(F.col("valor"))).otherwise(F.col("valor"))
    by_value = raw.groupBy("columna", comparable.alias("norm")).agg(
        F.count("valor").alias("raw_values"), F.sum("n").alias("n")
    )
    profile = plain.join(
        by_value.groupBy("columna").agg(
            F.sum("raw_values").alias("nunique_raw"), F.count("norm").alias("_norm")
        ),
        "columna",
        "left",
    )
    order = Window.partitionBy("columna").orderBy(
        F.col("n").desc(), F.col("norm").asc_nulls_first()
    )
    # the filter on the rank keeps at most `top` rows per column
    best = (
        by_value.filter(is_text)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .groupBy("columna")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("rank", "norm", "n"))),
                    lambda v: F.concat_ws(
                        "=", F.coalesce(v["norm"], F.lit("<null>")), v["n"].cast("string")
                    ),
                ),
                "; ",
            ).alias("top_valores")
        )
    )
    out = profile.join(best, "columna", "left")
    return out.select(
        "columna",
        "valores_nulos",
        F.round(F.col("valores_nulos") / F.col("_rows") * 100, 2).alias("porcentaje_nulos"),
        F.coalesce("nunique_raw", F.lit(0)).alias("nunique_raw"),
        F.when(is_text, F.coalesce("_norm", F.lit(0))).alias("nunique_normalizado"),
        F.when(is_text, F.coalesce(F.col("nunique_raw") - F.col("_norm"), F.lit(0))).alias(
            "valores_fantasma"
        ),
        "top_valores",
        "no_finitos",
        "min",
        "max",
        "media",
    )


def _row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n"))


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, repeated rows after the first, and null cells in all."""
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    return _row_counts(df).agg(
        F.sum("_n").alias("total_registros"),
        F.lit(len(df.columns)).cast("bigint").alias("total_columnas"),
        F.sum(F.col("_n") - 1).alias("registros_duplicados"),
        F.sum(F.col("_n") * nulls).alias("valores_nulos_total"),
    )


def duplicated_rows(df: DataFrame) -> DataFrame:
    """All rows that occur more than once, each as often as it occurs.

    The rows are looked up by a semi join, which AQE splits when one row makes
    up much of the table; its copies are never gathered in one place.
    """
    names = {c: f"_key{i}" for i, c in enumerate(df.columns)}
    repeated = _row_counts(df).filter("_n > 1").select(*[F.col(c).alias(n) for c, n in names.items()])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return df.join(repeated, same, "left_semi")


def source_profile(
    df: DataFrame,
    dims: list[str],
    numbers: list[str],
    samples: int = 10,
) -> DataFrame:
    """Fill, distinct values, samples and numeric range of text columns, from one scan.

    The samples are the ``samples`` smallest values, because 'first' depends on the order of
    files.  Number columns are profiled by their distinct texts, each parsed once.
    """
    dims = [c for c in dims if c in df.columns]
    numbers = [c for c in numbers if c in df.columns and c not in dims]
    names = [*dims, *numbers]
    is_number = F.col("columna").isin(*numbers) if numbers else F.lit(False)
    number = F.when(is_number, parse_number(F.col("valor")))
    counted = (
        _as_text(df, names)
        .groupBy("columna", F.coalesce(strip(F.col("valor")), F.lit("")).alias("valor"))
        .agg(
            F.count("*").alias("n"),
            F.min(number).alias("number"),
            wide_unit_sum(number).alias("units"),
        )
    )
    filled = F.col("valor") != ""
    per_column = counted.groupBy("columna").agg(
        F.sum(F.when(filled, F.col("n")).otherwise(0)).alias("non_empty_count"),
        F.sum(F.when(filled, 0).otherwise(F.col("n"))).alias("empty_count"),
        F.when(~is_number, F.count_if(filled)).alias("distinct_count"),
        F.when(
            is_number,
            F.sum(F.when(filled & F.col("number").isNull(), F.col("n")).otherwise(0)),
        ).alias("numeric_parse_errors"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
        F.when(is_number, F.coalesce(from_exact(F.sum("units")), F.lit(0.0))).alias("sum"),
    )
    # Spark's window group limit keeps `samples` values per column and task for the ranking
    smallest = Window.partitionBy("columna").orderBy("valor")
    shown = (
        counted.where(filled & ~is_number)
        .withColumn("rank", F.row_number().over(smallest))
        .where(F.col("rank") <= samples)
        .groupBy("columna")
        .agg(F.array_join(F.array_sort(F.collect_list("valor")), ",").alias("sample_values"))
    )
    return per_column.join(shown, "columna", "left")


def source_period_counts(df: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows per period, blank periods apart (as null)."""
    period = F.nullif(strip(F.col(spec.period)), F.lit(""))
    return df.groupBy(period.alias(spec.period)).agg(F.count("*").alias("filas"))


def source_period_summary(
    counts: DataFrame, samples: int = 20, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """One row over :func:`source_period_counts`, with the first ``samples`` periods."""
    period = F.col(spec.period)
    first = counts.filter(period.isNotNull()).select(spec.period).orderBy(spec.period).limit(samples)
    sample = first.agg(F.array_join(F.array_sort(F.collect_list(spec.period)), ","))
    return counts.agg(
        F.sum("filas").alias("rows_scanned"),
        F.coalesce(F.sum(F.when(period.isNull(), F.col("filas"))), F.lit(0)).alias(
            "empty_period_rows"
        ),
        F.count(period).alias("distinct_period_count"),
        F.min(period).alias("min_period"),
        F.max(period).alias("max_period"),
    ).withColumn("sample_periods", sample.scalar())
