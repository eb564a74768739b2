"""Small marts over the facts, each one map-side combined aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.functions.numbers import exact_sum, safe_ratio, total
from cubeloom.spec import DEFAULT_SPEC, CubeSpec

RATIO_NAME = "sbc_total_calculado"


def sum_of(*names: str) -> Column:
    return exact_sum(total([F.col(n) for n in names]))


def main_ratio(spec: CubeSpec) -> Column:
    return safe_ratio(sum_of(spec.payroll), sum_of(spec.jobs_paid))


def totals_by(facts: DataFrame, dims: list[str], spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    roles = (spec.insured, spec.non_workers, spec.jobs, spec.jobs_paid, spec.payroll)
    return facts.groupBy(spec.period, *dims).agg(
        *[sum_of(c).alias(c) for c in roles], main_ratio(spec).alias(RATIO_NAME)
    )


def mart_entity(facts: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return totals_by(facts, [spec.entity], spec)


def mart_sector1(facts: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return totals_by(facts, [spec.sector_dims[0]], spec)


def mart_sector4(facts: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return totals_by(facts, list(spec.sector_dims), spec)


def mart_entity_sex(facts: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Jobs, payroll and three ratios per month, entity and sex."""

    def ratio(name: str) -> Column:
        num, den = spec.ratios[name]
        return safe_ratio(sum_of(*num), sum_of(*den)).alias(f"{name}_calculado")

    return facts.groupBy(spec.period, spec.entity, spec.sex).agg(
        *[sum_of(c).alias(c) for c in (spec.jobs, spec.jobs_paid, spec.payroll)],
        main_ratio(spec).alias(RATIO_NAME),
        ratio("sbc_permanentes"),
        ratio("sbc_eventuales"),
    )


CONTROL_COLUMNS = (
    "periodo_informacion",
    "status",
    "row_count",
    "period_fingerprint_hash",
    "sum_asegurados",
    "sum_no_trabajadores",
    "sum_ta",
    "sum_ta_sal",
    "sum_masa_sal_ta",
    "run_id",
    "source_url",
    "loaded_at",
    "error_message",
)


def mart_period_control(control: DataFrame) -> DataFrame:
    return control.select(*CONTROL_COLUMNS)


def reserved_period_summary(
    facts: DataFrame, period: str | None = None, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """What is preserved per period; the optional period prunes partitions at the scan."""
    if period is not None:
        facts = facts.filter(F.col(spec.period) == period)

    def filled(name: str) -> Column:
        return F.coalesce(sum_of(name), F.lit(0.0))

    return (
        facts.groupBy(spec.period)
        .agg(
            F.count("*").alias("final_row_count"),
            filled(spec.jobs).alias("asegurados_total_sum_ta"),
            filled(spec.jobs_paid).alias("trabajadores_con_sbc_sum_ta_sal"),
            filled(spec.payroll).alias("masa_salarial_sum_masa_sal_ta"),
            safe_ratio(filled(spec.payroll), filled(spec.jobs_paid)).alias("sbc_promedio"),
        )
        .orderBy(spec.period)
    )


def register_views(
    spark: SparkSession,
    facts: DataFrame,
    control: DataFrame,
    spec: CubeSpec = DEFAULT_SPEC,
) -> None:
    """The marts under their view names for ``spark.sql``."""
    mart_period_control(control).createOrReplaceTempView("vw_period_control")
    mart_entity(facts, spec).createOrReplaceTempView("vw_empleo_mensual_entidad")
    mart_sector1(facts, spec).createOrReplaceTempView("vw_empleo_sector_1")
    mart_sector4(facts, spec).createOrReplaceTempView("vw_empleo_sector_4")
    mart_entity_sex(facts, spec).createOrReplaceTempView("vw_sbc_entidad_genero")
