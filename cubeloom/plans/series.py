"""Monthly series, shares, snapshots and top-k lists over an aggregated cube."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeloom.functions.numbers import exact_sum, joined_units, rest, safe_ratio, units
from cubeloom.spec import DEFAULT_SPEC, CubeSpec


def _totals(df: DataFrame, value: str, *dims: str | Column, payroll: str | None = None) -> DataFrame:
    aggs = [exact_sum(F.col(value)).alias("asegurados")]
    if payroll:
        aggs.append(exact_sum(F.col(payroll)).alias("masa"))
    return df.groupBy(*dims).agg(*aggs)


def _period(spec: CubeSpec) -> Column:
    return F.col(spec.period).cast("date").alias("periodo")


def national_series(df: DataFrame, value: str, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return _totals(df, value, _period(spec)).orderBy("periodo")


def yoy_change(series: DataFrame) -> DataFrame:
    """Percent change against the row 12 rows earlier (by position, not by calendar).

    The series has one row per month, so the unpartitioned window sees some
    hundred rows whatever the size of the cube.
    """
    before = F.lag("asegurados", 12).over(Window.orderBy("periodo"))
    change = (F.col("asegurados") / F.nullif(before, F.lit(0.0)) - 1) * 100
    return series.select("periodo", "asegurados", change.alias("yoy_pct"))


def series_by_sex(
    df: DataFrame, value: str, payroll: str, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    base = _totals(df, value, _period(spec), F.col(spec.sex), payroll=payroll)
    return base.withColumn("salario_prom", safe_ratio(F.col("masa"), F.col("asegurados")))


def share_of_total(df: DataFrame, value: str, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Share of each sex in its month, from the aggregated rows only."""
    base = _totals(df, value, _period(spec), F.col(spec.sex))
    whole = F.sum("asegurados").over(Window.partitionBy("periodo"))
    share = safe_ratio(F.col("asegurados"), whole) * 100
    return base.withColumn("share_pct", share)


def latest_snapshot(
    df: DataFrame,
    value: str,
    dims: list[str],
    payroll: str | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Totals of the last period, from one scan: all periods are aggregated, the last is picked.

    The window has no partition; it sees one row per period and value of ``dims``.
    """
    totals = _totals(df, value, _period(spec), *dims, payroll=payroll)
    last = F.max("periodo").over(Window.partitionBy(F.lit(0)))
    return totals.withColumn("_last", last).where(F.col("periodo") == F.col("_last")).drop("_last")


def sector_snapshot_ratio(
    df: DataFrame, value: str, payroll: str, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    snap = latest_snapshot(df, value, [spec.sector_dims[0], spec.sex], payroll, spec)
    return snap.filter(F.col("asegurados") > 0).select(
        "periodo",
        F.col(spec.sector_dims[0]).alias("sector"),
        spec.sex,
        "asegurados",
        safe_ratio(F.col("masa"), F.col("asegurados")).alias("salario_prom"),
    )


def top_k_entities(
    df: DataFrame, value: str, k: int = 15, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """The k largest entities of the last period; ties go to the smaller code."""
    snap = latest_snapshot(df, value, [spec.entity], spec=spec)
    return (
        snap.select(spec.entity, "asegurados")
        .orderBy(F.col("asegurados").desc_nulls_last(), F.col(spec.entity).asc_nulls_last())
        .limit(k)
    )


def top_k_rows(df: DataFrame, value: str, k: int = 15, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Last-period rows by entity and sex of the k largest entities."""
    snap = latest_snapshot(df, value, [spec.entity, spec.sex], spec=spec)
    # summed without rounding; one row per entity and sex gets to the ranking
    value, own = F.col("asegurados"), Window.partitionBy(spec.entity)
    whole = joined_units(F.sum(units(value)).over(own), F.sum(rest(value)).over(own))
    order = Window.partitionBy(F.lit(0)).orderBy(
        F.col("_whole").desc_nulls_last(), F.col(spec.entity).asc_nulls_last()
    )
    ranked = snap.withColumn("_whole", whole).withColumn("_place", F.dense_rank().over(order))
    return ranked.where((F.col("_place") <= k) & F.col(spec.entity).isNotNull()).select(*snap.columns)



def conditional_ratio_by_month(
    df: DataFrame, value: str, payroll: str, range_column: str, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """All insured against those tied to an employer, and the ratio over the latter."""
    # a missing range is not the 'unlinked' label, so its rows count as linked
    linked = ~F.col(range_column).eqNullSafe(spec.unlinked)
    jobs = F.when(linked, F.col(value)).otherwise(0.0)
    paid = F.when(linked, F.col(payroll)).otherwise(0.0)
    return df.groupBy(F.trunc(F.col(spec.period).cast("date"), "month").alias("mes")).agg(
        exact_sum(F.col(value)).alias("total_asegurados"),
        exact_sum(jobs).alias("asegurados_con_patron"),
        exact_sum(paid).alias("masa_con_patron"),
        safe_ratio(exact_sum(paid), exact_sum(jobs)).alias("sbc_ajustado"),
    )
