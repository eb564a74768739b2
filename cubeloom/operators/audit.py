"""Data-quality audits.

The summaries share :func:`audit_rollup`, one pass that leaves one row per
period and flag; Catalyst drops the sums a report does not use.  Write the
rollup once (``materialize``) to serve all of them from a single scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeloom.functions.numbers import (
    exact_sum,
    from_exact,
    number_column,
    safe_ratio,
    wide_unit_sum,
)
from cubeloom.functions.text import WHITESPACE, strip
from cubeloom.operators.history import period_rollup, rows_of_crowded_keys
from cubeloom.session import materialize
from cubeloom.spec import DEFAULT_SPEC, CubeSpec

# ---------------------------------------------------------------- summaries


def _rollup_measures(spec: CubeSpec) -> tuple[str, ...]:
    return (
        spec.insured,
        spec.non_workers,
        spec.jobs,
        spec.jobs_paid,
        spec.payroll,
        *spec.job_parts,
        *spec.payroll_parts,
    )


def audit_rollup(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Counts, unit sums and ratio checks per period and flag; absent columns count as null."""
    paid = number_column(cube, spec.jobs_paid)
    stored = number_column(cube, spec.main_ratio)
    recomputed = safe_ratio(number_column(cube, spec.payroll), paid)

    def dim(name: str) -> Column:
        col = F.col(name) if name in cube.columns else F.lit(None)
        return col.cast("string").alias(name)

    return cube.groupBy(dim(spec.period), dim(spec.flag)).agg(
        F.count("*").alias("filas"),
        *[wide_unit_sum(number_column(cube, m)).alias(m) for m in _rollup_measures(spec)],
        F.count_if((F.coalesce(paid, F.lit(0.0)) == 0) & stored.isNotNull()).alias("zero_den"),
        F.max(F.abs(stored - recomputed)).alias("max_diff"),
    )


def _again(name: str) -> Column:
    """Sum of unit sums, which are DECIMAL."""
    return F.sum(name)


def _value(col: Column) -> Column:
    return from_exact(col)


def _sum(name: str) -> Column:
    return _value(_again(name))


def _sum0(*names: str) -> Column:
    out = F.coalesce(_again(names[0]), F.lit(0))
    for name in names[1:]:
        out = out + F.coalesce(_again(name), F.lit(0))
    return _value(out)


def _totals(spec: CubeSpec) -> list[Column]:
    roles = (spec.insured, spec.non_workers, spec.jobs, spec.jobs_paid, spec.payroll)
    ratio = safe_ratio(_sum(spec.payroll), _sum(spec.jobs_paid)).alias("sbc_total_calculado")
    return [*[_sum(c).alias(c) for c in roles], ratio]


def summary_general(rollup: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return rollup.agg(
        F.sum("filas").alias("filas"),
        F.count_distinct(spec.period).alias("periodos"),
        F.min(spec.period).alias("periodo_min"),
        F.max(spec.period).alias("periodo_max"),
        *_totals(spec),
    )


def summary_by_period(rollup: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return rollup.groupBy(spec.period).agg(F.sum("filas").alias("filas"), *_totals(spec))


def _composition(
    rollup: DataFrame,
    whole: str,
    parts: tuple[str, ...],
    names: tuple[str, ...],
    diff: str,
    spec: CubeSpec,
) -> DataFrame:
    """Four two-way sums and the gap to the official total, missing parts counted as 0."""
    pu, pc, tu, tc = parts
    pairs = ((pu, pc), (tu, tc), (pu, tu), (pc, tc))
    gap = _again(whole)
    for part in parts:
        gap = gap - F.coalesce(_again(part), F.lit(0))
    return rollup.groupBy(spec.period).agg(
        *[_sum0(*pair).alias(name) for pair, name in zip(pairs, names)],
        _value(gap).alias(diff),
    )


def job_composition(rollup: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    names = tuple(spec.derived_sums)[:4]
    return _composition(rollup, spec.jobs, spec.job_parts, names, "diff_ta_componentes", spec)


def payroll_composition(rollup: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    names = tuple(spec.derived_sums)[4:]
    diff = "diff_masa_sal_componentes"
    return _composition(rollup, spec.payroll, spec.payroll_parts, names, diff, spec)


def flag_distribution(rollup: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return rollup.groupBy(spec.flag).agg(
        F.sum("filas").alias("filas"),
        _sum(spec.jobs).alias("puestos"),
        _sum(spec.jobs_paid).alias("puestos_con_salario"),
        _sum(spec.payroll).alias("masa_sal_ta"),
    )


def flag_ratio_by_period(
    rollup: DataFrame,
    value: str = "1",
    decimals: int | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    ratio = safe_ratio(_sum(spec.payroll), _sum(spec.jobs_paid))
    if decimals is not None:
        ratio = F.round(ratio, decimals)
    return (
        rollup.filter(F.col(spec.flag) == value)
        .groupBy(spec.period)
        .agg(
            _sum(spec.jobs).alias(f"puestos_{spec.flag}_{value}"),
            _sum(spec.jobs_paid).alias(f"puestos_con_salario_{spec.flag}_{value}"),
            _sum(spec.payroll).alias(f"masa_sal_ta_{spec.flag}_{value}"),
            ratio.alias("sbc_plataformas"),
        )
    )


def ratio_validation(rollup: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Stored ratios against recomputed ones, and ratios that should not exist."""
    return rollup.agg(
        F.sum("filas").alias("filas_revisadas"),
        F.sum("zero_den").alias("filas_con_sbc_y_denominador_cero"),
        F.max("max_diff").alias("max_diff_sbc_total"),
        safe_ratio(_sum(spec.payroll), _sum(spec.jobs_paid)).alias("sbc_total_calculado"),
    )


# The names of the reports.
AUDIT_REPORTS = {
    "summary_general": summary_general,
    "summary_by_period": summary_by_period,
    "job_composition_by_period": job_composition,
    "salary_composition_by_period": payroll_composition,
    "sbc_validation": ratio_validation,
    "ptpd_distribution": flag_distribution,
    "ptpd_sbc_by_period": flag_ratio_by_period,
}



def deep_audit(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> dict[str, DataFrame]:
    """All summary reports by name, from one scan of the cube.

    The rollup (one row per period and flag) is written once; every report reads only that.
    """
    rollup = materialize(audit_rollup(cube, spec), "audit-rollup")
    return {name: report(rollup, spec=spec) for name, report in AUDIT_REPORTS.items()}


def long_report(reports: dict[str, DataFrame], spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """The numbers of several reports as (reporte, clave, metrica, valor); missing ones have no row."""

    def stacked(name: str, report: DataFrame) -> DataFrame:
        key = next((c for c in (spec.period, spec.flag) if c in report.columns), None)
        numbers = [
            c for c, kind in report.dtypes if c != key and not kind.startswith(("string", "date"))
        ]
        clave = F.lit("") if key is None else F.coalesce(F.col(key), F.lit(""))
        return (
            report.select(clave.alias("clave"), *[F.col(c).cast("double").alias(c) for c in numbers])
            .unpivot("clave", numbers, "metrica", "valor")
            .where(F.col("valor").isNotNull())
            .select(F.lit(name).alias("reporte"), "clave", "metrica", "valor")
        )

    return reduce(
        lambda a, b: a.unionByName(b), [stacked(n, r) for n, r in reports.items()]
    )


# ---------------------------------------------------------------- keys


def key_counts(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    return cube.groupBy(*spec.keys).agg(F.count("*").alias("cnt"))


def duplicate_keys(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Groups that share a key and the rows in excess (null when there is none)."""
    missing = [k for k in spec.keys if k not in cube.columns]
    if missing:
        return cube.sparkSession.range(1).select(
            F.lit("skipped_missing_key_columns").alias("status"),
            F.lit(", ".join(missing)).alias("missing_key_columns"),
            F.lit(None).cast("bigint").alias("llaves_duplicadas"),
            F.lit(None).cast("bigint").alias("filas_excedentes"),
        )
    groups = key_counts(cube, spec).filter("cnt > 1")
    return groups.agg(
        F.count("*").alias("llaves_duplicadas"), F.sum(F.col("cnt") - 1).alias("filas_excedentes")
    ).select(
        F.lit("ok").alias("status"),
        F.lit("").alias("missing_key_columns"),
        "llaves_duplicadas",
        "filas_excedentes",
    )


def duplicate_rows_in_groups(cube: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Every row of a duplicated key counts, the first one too."""
    groups = key_counts(cube, spec).filter("cnt > 1")
    return groups.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("rows_in_duplicate_groups"),
        F.count("*").alias("duplicate_groups"),
    )


# ---------------------------------------------------------------- values


def top_values(
    cube: DataFrame, k: int = 50, columns: list[str] | None = None, spec: CubeSpec = DEFAULT_SPEC
) -> DataFrame:
    """The k most frequent values of every column from one scan.

    Columns become (name, value) rows that are combined before the shuffle, and
    Spark's window group limit keeps at most k rows per column and task for the
    ranking.  Ties go to the smaller value, null first.
    """
    names = [c for c in columns or spec.top_value_columns if c in cube.columns]
    rows = cube.select(
        number_column(cube, spec.jobs).alias("_jobs"),
        *[F.col(c).cast("string").alias(c) for c in names],
    ).unpivot(["_jobs"], names, "column_name", "value")
    counts = rows.groupBy("column_name", "value").agg(
        F.count("*").alias("filas"), exact_sum(F.col("_jobs")).alias("ta")
    )
    order = Window.partitionBy("column_name").orderBy(
        F.col("filas").desc(), F.col("value").asc_nulls_first()
    )
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def accepted_values(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Values outside the allowed set with their row counts; null passes, as in a CHECK."""
    value = F.col(column).cast("string")
    return (
        df.filter(~value.isin(*allowed))
        .groupBy(F.lit(column).alias("column_name"), value.alias("value"))
        .agg(F.count("*").alias("filas"))
    )


def fact_constraint_violations(facts: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """What the facts may not contain: repeated keys and flags outside the allowed set.

    One row per period and kind with the number of rows concerned; both kinds
    come from the same per-key counts.
    """
    flag = F.col(spec.flag)
    kinds = F.array(
        F.struct(
            F.lit("unique_analytic_key").alias("constraint"),
            F.when(F.col("cnt") > 1, F.col("cnt")).otherwise(0).alias("filas"),
        ),
        F.struct(
            F.lit(f"accepted_{spec.flag}").alias("constraint"),
            F.when(~flag.isin(*spec.flag_values), F.col("cnt")).otherwise(0).alias("filas"),
        ),
    )
    return (
        key_counts(facts, spec)
        .select(spec.period, F.inline(kinds))
        .filter("filas > 0")
        .groupBy(spec.period, "constraint")
        .agg(F.sum("filas").alias("filas"))
    )


def stored_fact_violations(facts: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """:func:`fact_constraint_violations` of a stored table: only hashes of the keys are shuffled."""
    odd = facts.where(~F.col(spec.flag).isin(*spec.flag_values)).groupBy(spec.period)
    found = odd.agg(F.count("*").alias("filas")).select(
        spec.period, F.lit(f"accepted_{spec.flag}").alias("constraint"), "filas"
    )
    crowded = rows_of_crowded_keys(facts, list(spec.keys))
    if crowded is None:
        return found
    repeated = crowded.groupBy("_spread", *spec.keys).agg(F.count("*").alias("cnt")).where("cnt > 1")
    return found.unionByName(
        repeated.groupBy(spec.period)
        .agg(F.sum("cnt").alias("filas"))
        .select(spec.period, F.lit("unique_analytic_key").alias("constraint"), "filas")
    )


def whitespace_audit(df: DataFrame, column: str) -> DataFrame:
    """Every distinct value with its length, blank and control-character marks and count."""
    value = F.col("value")
    blanks = F.lit(WHITESPACE)
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("conteo"))
        .select(
            "value",
            strip(value).alias("valor_limpio"),
            F.length(value).cast("bigint").alias("longitud"),
            (value != F.ltrim(value, blanks)).alias("espacios_inicio"),
            (value != F.rtrim(value, blanks)).alias("espacios_fin"),
            (value.contains("\n") | value.contains("\r")).alias("saltos_linea"),
            value.contains("\t").alias("tabulaciones"),
            (value == "").alias("es_vacio"),
            "conteo",
        )
    )


def whitespace_totals(audit: DataFrame) -> DataFrame:
    """Distinct values per problem, and distinct values before and after trimming."""
    by_clean = audit.groupBy("valor_limpio").agg(
        F.count("*").alias("n"),
        *[
            F.count_if(c).alias(c)
            for c in ("espacios_inicio", "espacios_fin", "saltos_linea", "tabulaciones", "es_vacio")
        ],
    )
    return by_clean.agg(
        F.sum("n").alias("valores_unicos"),
        F.count("*").alias("valores_unicos_limpios"),
        *[
            F.sum(c).alias(c)
            for c in ("espacios_inicio", "espacios_fin", "saltos_linea", "tabulaciones", "es_vacio")
        ],
    )


# ---------------------------------------------------------------- period audit


def light_period_audit(
    cube: DataFrame,
    expected: DataFrame | None = None,
    declared: str | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Errors of every candidate period at once: ``status`` and a ';'-joined ``errors``.

    ``declared`` names the column with the period a row was delivered for
    (default: the period column itself).  ``expected`` adds periods that may
    have no rows at all.
    """
    return audit_of(period_rollup(cube, declared, spec), cube.columns, expected, spec)


def audit_of(
    rollup: DataFrame,
    columns: list[str],
    expected: DataFrame | None = None,
    spec: CubeSpec = DEFAULT_SPEC,
) -> DataFrame:
    """The audit from a period rollup and the column names of the cube it came from."""
    ratios = [c for c in columns if c.startswith(spec.ratio_prefix)]
    missing = [c for c in dict.fromkeys((*spec.keys, *spec.measures)) if c not in columns]
    layout = [f"missing_columns:{','.join(missing)}"] if missing else []
    layout += [f"forbidden_column:{c}" for c in spec.forbidden_columns if c in columns]
    full_key = all(k in columns for k in spec.keys)
    if expected is not None:
        wanted = expected.select(F.col(expected.columns[0]).alias("periodo")).distinct()
        rollup = wanted.join(rollup, "periodo", "left")
    as_declared = F.size("found").eqNullSafe(1) & F.array_contains("found", F.col("periodo"))
    errors = F.array_compact(
        F.array(
            *[F.lit(e) for e in layout],
            F.when(
                ~as_declared & F.lit(spec.period in columns),
                F.concat(F.lit("unexpected_periods:"), F.array_join("found", ",")),
            ),
            F.when(
                (F.col("repetidas") > 0) & F.lit(full_key),
                F.concat(F.lit("duplicate_analytic_keys:"), F.col("repetidas").cast("string")),
            ),
            *[
                F.when(F.col(f"inf_{c}") > 0, F.lit(f"infinite_{spec.ratio_prefix[:-1]}:{c}"))
                for c in ratios
            ],
        )
    )
    errors = F.when(F.col("filas").isNull(), F.array(F.lit("empty_dataframe"))).otherwise(errors)
    return rollup.select(
        "periodo",
        F.coalesce("filas", F.lit(0)).alias("filas"),
        F.when(F.size(errors) > 0, "failed").otherwise("success").alias("status"),
        F.array_join(errors, ";").alias("errors"),
    )


# ---------------------------------------------------------------- layout


def layout_report(headers: DataFrame, spec: CubeSpec = DEFAULT_SPEC) -> DataFrame:
    """Expected and forbidden columns of every file: ``headers`` has ``path`` and ``columns``."""
    checks = [(c, False) for c in spec.layout_columns]
    checks += [(c, True) for c in spec.forbidden_columns]
    expected = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.lit(f).alias("forbidden")) for c, f in checks]
    )
    rows = headers.select("path", "columns", F.explode(expected).alias("e")).select(
        "path",
        "e.column_name",
        F.array_contains("columns", F.col("e.column_name")).alias("present"),
        "e.forbidden",
    )
    status = (
        F.when(F.col("forbidden") & F.col("present"), "forbidden_present")
        .when(F.col("forbidden"), "absent_ok")
        .when(F.col("present"), "present")
        .otherwise("missing")
    )
    return rows.withColumn("status", status)
