"""Normalisation, cube and mart queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeloom.functions import text
from cubeloom.functions.numbers import exact_sum
from cubeloom.operators import cube as C
from cubeloom.operators import normalize as N
from cubeloom.operators.facts import latest_completed_manifest
from cubeloom.operators.profile import source_period_counts, source_period_summary
from cubeloom.plans import marts, series
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.spec import CubeSpec
from cubeloom.workload.oracle import (
    DIFFS_SQL,
    RATIOS_SQL,
    big,
    dbl,
    listed,
    over,
    plus,
    sums,
)
from cubeloom.workload.registry import query
from cubeloom.workload.star_cube import quoted as q
from cubeloom.workload.star_cube import raw_columns_for, star_cube, table

P = SPEC.period


def rows_with(spark: SparkSession, sf: str, keys, measures=()) -> DataFrame:
    """Normalised rows with some keys and measures only, so only their tables are joined."""
    keys = (P, *[k for k in keys if k != P])
    raw = star_cube(spark, sf, raw_columns_for(keys, measures))
    return raw.select(*[N.key_expression(raw, k) for k in keys], *measures)


def facts_with(spark: SparkSession, sf: str, keys, measures) -> DataFrame:
    """Facts at row grain: sums over them equal sums over the grouped facts."""
    return N.fact_defaults(rows_with(spark, sf, keys, measures))


# ---------------------------------------------------------------- dimension rules


@query(
    "fill_missing_dims",
    over(
        "raw",
        f'SELECT "{P}", {big("count(*)", "filas")}, {big("0", "with_uma")}, '
        f'{big("0", "with_flag")}, {big("count(sexo)", "with_sex")} FROM raw GROUP BY 1',
    ),
)
def fill_missing_dims(spark, sf):
    old_layout = star_cube(spark, sf, (P, "sexo"))
    filled = N.add_missing_dims(old_layout)
    return filled.groupBy(P).agg(
        F.count("*").alias("filas"),
        F.count("rango_uma").alias("with_uma"),
        F.count("ptpd").alias("with_flag"),
        F.count("sexo").alias("with_sex"),
    )


@query(
    "blank_to_null",
    over(
        "raw",
        "SELECT nullif(\"tamaño_patron\", '') AS \"tamaño_patron\", "
        "nullif(rango_edad, '') AS rango_edad, nullif(cve_municipio, '') AS cve_municipio, "
        f'{big("count(*)", "filas")} FROM raw GROUP BY 1, 2, 3',
    ),
)
def blank_to_null(spark, sf):
    dims = ("tamaño_patron", "rango_edad", "cve_municipio")
    raw = star_cube(spark, sf, dims)
    return (
        raw.select(*[text.blank_to_null(F.col(c)).alias(c) for c in dims])
        .groupBy(*dims)
        .agg(F.count("*").alias("filas"))
    )


@query(
    "code_prefix",
    over(
        "raw",
        "SELECT sector_economico_2, sector_economico_4, "
        "substring(sector_economico_2, 1, 2) AS sector_economico_2_2pos, "
        "substring(sector_economico_4, 1, 4) AS sector_economico_4_4_pos, "
        f'{big("count(*)", "filas")} FROM raw GROUP BY 1, 2, 3, 4',
    ),
)
def code_prefix(spark, sf):
    rows = N.normalize_dims(star_cube(spark, sf, ("sector_economico_2", "sector_economico_4")))
    names = ("sector_economico_2", "sector_economico_4", *SPEC.code_prefixes)
    return rows.groupBy(*names).agg(F.count("*").alias("filas"))


@query(
    "normalize_dims",
    over(
        "raw",
        "SELECT "
        + ", ".join(f"nullif({q(SPEC.raw_name.get(k, k))}, '') AS {q(k)}" for k in SPEC.keys)
        + ", substring(sector_economico_2, 1, 2) AS sector_economico_2_2pos, "
        "substring(sector_economico_4, 1, 4) AS sector_economico_4_4_pos FROM raw",
    ),
)
def normalize_dims(spark, sf):
    return N.normalize_dims(star_cube(spark, sf, (P, *SPEC.raw_dims)))


@query(
    "blank_to_label",
    over(
        "raw",
        "SELECT "
        + ", ".join(
            f"coalesce(nullif(trim({q(SPEC.raw_name[k])}), ''), 'NA') AS {q(k)}"
            for k in SPEC.label_dims
        )
        + f', {big("count(*)", "filas")} FROM raw GROUP BY 1, 2, 3, 4',
    ),
)
def blank_to_label(spark, sf):
    raw = star_cube(spark, sf, raw_columns_for(SPEC.label_dims))
    rows = N.label_dims(N.normalize_dims(raw))
    return rows.groupBy(*SPEC.label_dims).agg(F.count("*").alias("filas"))


@query(
    "sector_code_clean",
    over(
        "raw",
        "SELECT "
        + ", ".join(
            rf"coalesce(regexp_replace(trim({q(k)}), '^(-?[0-9]+)\.0+$', '\1'), '') AS {q(k)}"
            for k in SPEC.sector_dims
        )
        + f', {big("count(*)", "filas")} FROM raw GROUP BY 1, 2, 3',
    ),
)
def sector_code_clean(spark, sf):
    rows = N.label_dims(star_cube(spark, sf, SPEC.sector_dims))
    return rows.groupBy(*SPEC.sector_dims).agg(F.count("*").alias("filas"))


@query(
    "integer_code_repair",
    over(
        "raw",
        "SELECT "
        + ", ".join(
            rf"regexp_replace({q(k)}, '^([0-9]+)\.0$', '\1') AS {q(k)}"
            for k in SPEC.integer_code_dims
        )
        + f', {big("count(*)", "filas")} FROM raw GROUP BY 1, 2, 3, 4, 5, 6',
    ),
)
def integer_code_repair(spark, sf):
    rows = N.repair_integer_codes(star_cube(spark, sf, SPEC.integer_code_dims))
    return rows.groupBy(*SPEC.integer_code_dims).agg(F.count("*").alias("filas"))


@query(
    "integer_code_repair_counts",
    over(
        "raw",
        "SELECT "
        + ", ".join(
            rf"CAST(count(*) FILTER (WHERE regexp_matches({q(k)}, '^[0-9]+\.0$')) AS BIGINT) AS {q(k)}"
            for k in SPEC.integer_code_dims
        )
        + " FROM raw",
    ),
)
def integer_code_repair_counts(spark, sf):
    return N.integer_code_repair_counts(star_cube(spark, sf, SPEC.integer_code_dims))


# ---------------------------------------------------------------- formulas

_PARTS = tuple(dict.fromkeys(p for parts in SPEC.derived_sums.values() for p in parts))


@query(
    "derived_sums",
    over(
        "raw",
        f'SELECT "{P}", {listed(_PARTS, "CAST({0} AS DOUBLE) AS {0}")}, '
        + ", ".join(dbl(plus(parts), n) for n, parts in SPEC.derived_sums.items())
        + " FROM raw",
    ),
)
def derived_sums(spark, sf):
    return N.derived_sums(star_cube(spark, sf, (P, *_PARTS)))


_ENTITY_SUMS = (
    f"SELECT {P}, cve_entidad, {listed(SPEC.measures, 'SUM({0}) AS {0}')} FROM norm GROUP BY 1, 2"
)


@query(
    "ratio_metrics",
    over("norm", f"SELECT {P}, cve_entidad, {RATIOS_SQL} FROM g", g=_ENTITY_SUMS),
)
def ratio_metrics(spark, sf):
    parts = dict.fromkeys(c for num, den in SPEC.ratios.values() for c in (*num, *den))
    rows = rows_with(spark, sf, ("cve_entidad",), tuple(parts))
    totals = rows.groupBy(P, "cve_entidad").agg(*[exact_sum(F.col(c)).alias(c) for c in parts])
    return totals.select(
        P, "cve_entidad", *[c.alias(n) for n, c in C.ratio_columns().items()]
    )


@query(
    "reconciliation_diffs",
    over("norm", f"SELECT {P}, cve_entidad, {DIFFS_SQL} FROM g", g=_ENTITY_SUMS),
)
def reconciliation_diffs(spark, sf):
    parts = dict.fromkeys(c for a, b in SPEC.differences.values() for c in (*a, *b))
    rows = rows_with(spark, sf, ("cve_entidad",), tuple(parts))
    totals = rows.groupBy(P, "cve_entidad").agg(*[exact_sum(F.col(c)).alias(c) for c in parts])
    return totals.select(
        P, "cve_entidad", *[c.alias(n) for n, c in C.difference_columns().items()]
    )


@query(
    "recode_annotate",
    over(
        "raw",
        f"""SELECT "{P}", CASE WHEN sexo = '2' THEN '89' ELSE sexo END AS sexo,
        CASE WHEN "{P}" = '1997-01-31' THEN 'last month in wages'
             WHEN "{P}" = '1997-02-28' THEN 'first month in units'
             WHEN sexo = '2' THEN 'code 89' ELSE '' END AS comentarios,
        'mensual' AS periodicidad, {big("count(*)", "filas")} FROM raw GROUP BY 1, 2, 3, 4""",
    ),
)
def recode_annotate(spark, sf):
    rows = N.recode(star_cube(spark, sf, (P, "sexo")), "sexo", {"2": "89"})
    rules = [
        (F.col("sexo") == "89", "code 89"),
        (F.col(P) == "1997-02-28", "first month in units"),
        (F.col(P) == "1997-01-31", "last month in wages"),
    ]
    rows = N.annotate(rows, "comentarios", rules).withColumn("periodicidad", F.lit("mensual"))
    return rows.groupBy(P, "sexo", "comentarios", "periodicidad").agg(
        F.count("*").alias("filas")
    )


@query(
    "predicate_mix",
    over(
        "raw",
        f"""SELECT "{P}", cve_entidad, ptpd, {big("count(*)", "filas")}, {dbl("SUM(ta)", "ta")}
        FROM raw WHERE ("{P}" = '1998-05-31' OR "{P}" LIKE '%1999-1%'
        OR "{P}" IN ('1997-02-28', '2000-02-29')) AND ptpd = '1' GROUP BY 1, 2, 3""",
    ),
)
def predicate_mix(spark, sf):
    period = F.col(P)
    rows = star_cube(spark, sf, (P, "cve_entidad", "ptpd", "ta")).filter(
        (
            (period == "1998-05-31")
            | period.contains("1999-1")
            | period.isin("1997-02-28", "2000-02-29")
        )
        & (F.col("ptpd").cast("string") == "1")
    )
    return rows.groupBy(P, "cve_entidad", "ptpd").agg(
        F.count("*").alias("filas"), exact_sum(F.col("ta")).alias("ta")
    )


# ---------------------------------------------------------------- cube

_CUBE_SELECT = (
    f"SELECT {listed(SPEC.keys)}, {listed(SPEC.sums, 'CAST({0} AS DOUBLE) AS {0}')}, "
    f"{RATIOS_SQL}, {DIFFS_SQL}"
)


@query(
    "cube_aggregate",
    over("cube", f"{_CUBE_SELECT}, 'star' AS fuente, '2001-12-01T00:00:00Z' AS timestamp FROM cube"),
)
def cube_aggregate(spark, sf):
    cube = C.cube_aggregate(star_cube(spark, sf))
    return C.with_run_columns(cube, "star", "2001-12-01T00:00:00Z")


@query(
    "cube_small_amounts",
    f"""SELECT CAST(last_day(CAST(l_shipdate AS DATE)) AS VARCHAR) AS {P}, l_returnflag,
    CAST(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)))
      AS VARCHAR) || 'e-3' AS DOUBLE) AS ta,
    CAST(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)))
      AS VARCHAR) || 'e-5' AS DOUBLE) AS masa_sal_ta,
    count(*) AS filas FROM lineitem GROUP BY 1, 2""",
)
def cube_small_amounts(spark, sf):
    """Measures of seven and nine decimals: nothing of them is rounded away."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")

    def shifted(share: str, power: str):
        """The nearest double of a product of decimals and a power of ten."""
        product = price * F.col(share).cast("decimal(18,2)")
        return F.concat(product.cast("string"), F.lit(power)).cast("double")

    rows = table(spark, sf, "lineitem").select(
        F.last_day(F.col("l_shipdate").cast("date")).cast("string").alias(P),
        "l_returnflag",
        shifted("l_tax", "e-3").alias("ta"),
        shifted("l_discount", "e-5").alias("m"),
    )
    return rows.groupBy(P, "l_returnflag").agg(
        exact_sum(F.col("ta")).alias("ta"),
        exact_sum(F.col("m")).alias("masa_sal_ta"),
        F.count("*").alias("filas"),
    )


SMALL = CubeSpec(
    raw_dims=("cve_entidad", "sexo", "rango_salarial", "sector_economico_1"),
    optional_in_files=(),
)


@query(
    "merge_partial_cubes",
    over(
        "norm",
        f"SELECT {listed(SMALL.keys)}, {listed(SPEC.sums, 'CAST({0} AS DOUBLE) AS {0}')}, "
        f"{RATIOS_SQL}, {DIFFS_SQL} FROM g",
        g=f"SELECT {listed(SMALL.keys)}, {listed(SPEC.sums, 'SUM({0}) AS {0}')} "
        f"FROM norm GROUP BY {listed(SMALL.keys)}",
    ),
)
def merge_partial_cubes(spark, sf):
    """Three deliveries of overlapping keys, each aggregated alone, then merged."""
    raw = star_cube(spark, sf, (P, *SMALL.raw_dims, *SMALL.measures))
    part = F.col("no_trabajadores") % 3
    partials = [C.cube_aggregate(raw.filter(part == i), SMALL) for i in range(3)]
    return C.merge_cubes(*partials, spec=SMALL)


@query(
    "legacy_cube",
    over(
        "raw",
        f"""SELECT 'star' AS fuente, 't0' AS timestamp, "{P}",
        coalesce(nullif(cve_entidad, ''), 'no_ligados_a_patron') AS cve_entidad,
        coalesce(nullif(sexo, ''), 'no_ligados_a_patron') AS sexo,
        coalesce(nullif(rango_edad, ''), 'no_ligados_a_patron') AS rango_edad,
        coalesce(nullif(rango_uma, ''), 'no_ligados_a_patron') AS rango_uma,
        coalesce(nullif(sector_economico_1, ''), 'no_ligados_a_patron') AS sector_economico_1,
        {dbl("SUM(coalesce(ta, 0))", "total_asegurados")},
        {dbl("SUM(coalesce(masa_sal_ta, 0))", "masa_salarial_total")},
        {dbl("SUM(coalesce(tpu, 0) + coalesce(tpc, 0))", "trabajadores_permanentes")},
        {dbl("SUM(coalesce(teu, 0) + coalesce(tec, 0))", "trabajadores_eventuales")},
        {dbl("SUM(coalesce(masa_sal_tpu, 0) + coalesce(masa_sal_tpc, 0))", "masa_sal_permanentes")},
        {dbl("SUM(coalesce(masa_sal_teu, 0) + coalesce(masa_sal_tec, 0))", "masa_sal_eventuales")}
        FROM raw GROUP BY ALL""",
    ),
)
def legacy_cube(spark, sf):
    numbers = dict.fromkeys(m for parts in C.LEGACY_SUMS.values() for m in parts)
    raw = star_cube(spark, sf, (P, *SPEC.legacy_dims, *numbers))
    return C.legacy_cube(N.tokens_as_null(raw, list(SPEC.legacy_dims)), "star", "t0")


# ---------------------------------------------------------------- marts

_ROLES = ("asegurados", "no_trabajadores", "ta", "ta_sal", "masa_sal_ta")
_SBC = "CAST(SUM(masa_sal_ta) AS DOUBLE) / NULLIF(CAST(SUM(ta_sal) AS DOUBLE), 0)"


def _mart_sql(dims) -> str:
    return over(
        "facts",
        f"SELECT {P}, {listed(dims)}, {sums(_ROLES)}, {_SBC} AS sbc_total_calculado "
        f"FROM facts GROUP BY {P}, {listed(dims)}",
    )


@query("mart_entity", _mart_sql(("cve_entidad",)))
def mart_entity(spark, sf):
    return marts.mart_entity(facts_with(spark, sf, ("cve_entidad",), _ROLES))


@query("mart_sector1", _mart_sql(("sector_economico_1",)))
def mart_sector1(spark, sf):
    return marts.mart_sector1(facts_with(spark, sf, ("sector_economico_1",), _ROLES))


@query("mart_sector4", _mart_sql(SPEC.sector_dims))
def mart_sector4(spark, sf):
    return marts.mart_sector4(facts_with(spark, sf, SPEC.sector_dims, _ROLES))


def _sum_ratio(num: str, den: str) -> str:
    return f"CAST(SUM({num}) AS DOUBLE) / NULLIF(CAST(SUM({den}) AS DOUBLE), 0)"


@query(
    "mart_entity_sex",
    over(
        "facts",
        f"SELECT {P}, cve_entidad, sexo, {sums(('ta', 'ta_sal', 'masa_sal_ta'))}, "
        f"{_SBC} AS sbc_total_calculado, "
        f"{_sum_ratio('masa_sal_tpu + masa_sal_tpc', 'tpu_sal + tpc_sal')} "
        "AS sbc_permanentes_calculado, "
        f"{_sum_ratio('masa_sal_teu + masa_sal_tec', 'teu_sal + tec_sal')} "
        f"AS sbc_eventuales_calculado FROM facts GROUP BY {P}, cve_entidad, sexo",
    ),
)
def mart_entity_sex(spark, sf):
    parts = ("masa_sal_tpu", "masa_sal_tpc", "masa_sal_teu", "masa_sal_tec")
    paid = ("tpu_sal", "tpc_sal", "teu_sal", "tec_sal")
    measures = ("ta", "ta_sal", "masa_sal_ta", *parts, *paid)
    return marts.mart_entity_sex(facts_with(spark, sf, ("cve_entidad", "sexo"), measures))


@query(
    "reserved_period_summary",
    over(
        "facts",
        f"""SELECT {P}, {big("count(*)", "final_row_count")},
        {dbl("SUM(ta)", "asegurados_total_sum_ta")},
        {dbl("SUM(ta_sal)", "trabajadores_con_sbc_sum_ta_sal")},
        {dbl("SUM(masa_sal_ta)", "masa_salarial_sum_masa_sal_ta")},
        {_SBC} AS sbc_promedio FROM facts GROUP BY 1""",
    ),
)
def reserved_period_summary(spark, sf):
    facts = N.fact_defaults(C.cube_aggregate(star_cube(spark, sf)))
    return marts.reserved_period_summary(facts)


@query(
    "conditional_ratio_by_month",
    over(
        "raw",
        f"""SELECT date_trunc('month', CAST("{P}" AS DATE))::DATE AS mes,
        {dbl("SUM(ta)", "total_asegurados")},
        {dbl("SUM(CASE WHEN r <> 'no_ligados_a_patron' THEN ta ELSE 0 END)", "asegurados_con_patron")},
        {dbl("SUM(CASE WHEN r <> 'no_ligados_a_patron' THEN masa_sal_ta ELSE 0 END)", "masa_con_patron")},
        CAST(SUM(CASE WHEN r <> 'no_ligados_a_patron' THEN masa_sal_ta ELSE 0 END) AS DOUBLE)
        / NULLIF(CAST(SUM(CASE WHEN r <> 'no_ligados_a_patron' THEN ta ELSE 0 END) AS DOUBLE), 0)
        AS sbc_ajustado
        FROM (SELECT *, coalesce(rango_uma, 'no_ligados_a_patron') AS r FROM raw) GROUP BY 1""",
    ),
)
def conditional_ratio_by_month(spark, sf):
    raw = star_cube(spark, sf, (P, "rango_uma", "ta", "masa_sal_ta"))
    filled = N.fill_labels_and_numbers(raw, {"rango_uma": SPEC.unlinked}, {"ta": 0.0})
    return series.conditional_ratio_by_month(filled, "ta", "masa_sal_ta", "rango_uma")


# one month in seven delivered without a period
_BLANKED = f"CASE WHEN no_trabajadores = 7 THEN ' ' ELSE \"{P}\" || ' ' END"


def _source_with_blank_periods(spark, sf):
    raw = star_cube(spark, sf, (P, "no_trabajadores"))
    blank = F.when(F.col("no_trabajadores") == 7, " ").otherwise(F.concat(F.col(P), F.lit(" ")))
    return raw.select(blank.alias(P))


@query(
    "source_period_counts",
    over(
        "raw",
        f"SELECT nullif(trim({_BLANKED}), '') AS {P}, {big('count(*)', 'filas')} FROM raw GROUP BY 1",
    ),
)
def source_period_counts_query(spark, sf):
    return source_period_counts(_source_with_blank_periods(spark, sf))


@query(
    "source_period_summary",
    over(
        "raw",
        f"""SELECT {big("SUM(n)", "rows_scanned")},
        {big("coalesce(SUM(n) FILTER (WHERE p IS NULL), 0)", "empty_period_rows")},
        {big("count(p)", "distinct_period_count")},
        (SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT p FROM c WHERE p IS NOT NULL
         ORDER BY p LIMIT 20)) AS sample_periods,
        MIN(p) AS min_period, MAX(p) AS max_period FROM c""",
        c=f"SELECT nullif(trim({_BLANKED}), '') AS p, count(*) AS n FROM raw GROUP BY 1",
    ),
)
def source_period_summary_query(spark, sf):
    return source_period_summary(source_period_counts(_source_with_blank_periods(spark, sf)))


@query(
    "latest_completed_manifest",
    """SELECT k AS period, event_id, event_type, ts, done AS final_manifest_exists FROM (
       SELECT json_extract_string(props, '$.k') AS k, event_id, event_type, ts,
              event_type = 'error' AS done,
              row_number() OVER (PARTITION BY json_extract_string(props, '$.k')
                ORDER BY (event_type = 'error') DESC, ts DESC NULLS LAST, event_id DESC) AS rn
       FROM events) WHERE rn = 1 AND k IS NOT NULL""",
)
def latest_completed_manifest_query(spark, sf):
    """Events as run manifests: the JSON names the period, an 'error' event stands for completed."""
    latest = latest_completed_manifest(
        table(spark, sf, "events"),
        completed=F.col("event_type") == "error",
        period=F.get_json_object("props", "$.k"),
        created_at=F.col("ts"),
        tie=F.col("event_id"),
    )
    return latest.select(
        F.col("_period").alias("period"), "event_id", "event_type", "ts", "final_manifest_exists"
    )


# ---------------------------------------------------------------- series

SERIES_SQL = f"SELECT CAST({P} AS DATE) AS periodo, *, ta AS v, masa_sal_ta AS m FROM norm"


def _series_rows(spark, sf, *keys, payroll=True):
    return rows_with(spark, sf, keys, ("ta", "masa_sal_ta") if payroll else ("ta",))


@query(
    "national_series",
    over(
        "norm",
        f"SELECT periodo, {dbl('SUM(v)', 'asegurados')} FROM s GROUP BY 1",
        s=SERIES_SQL,
    ),
)
def national_series(spark, sf):
    return series.national_series(_series_rows(spark, sf, payroll=False), "ta")


@query(
    "yoy_change",
    over(
        "norm",
        "SELECT periodo, asegurados, (asegurados / nullif(lag(asegurados, 12) OVER "
        "(ORDER BY periodo), 0) - 1) * 100 AS yoy_pct FROM n",
        s=SERIES_SQL,
        n=f"SELECT periodo, {dbl('SUM(v)', 'asegurados')} FROM s GROUP BY 1",
    ),
)
def yoy_change(spark, sf):
    return series.yoy_change(series.national_series(_series_rows(spark, sf, payroll=False), "ta"))


@query(
    "series_by_sex",
    over(
        "norm",
        f"SELECT periodo, sexo, {dbl('SUM(v)', 'asegurados')}, {dbl('SUM(m)', 'masa')}, "
        "CAST(SUM(m) AS DOUBLE) / NULLIF(CAST(SUM(v) AS DOUBLE), 0) AS salario_prom "
        "FROM s GROUP BY 1, 2",
        s=SERIES_SQL,
    ),
)
def series_by_sex(spark, sf):
    return series.series_by_sex(_series_rows(spark, sf, "sexo"), "ta", "masa_sal_ta")


@query(
    "share_of_total",
    over(
        "norm",
        "SELECT b.periodo, b.sexo, b.asegurados, (b.asegurados / NULLIF(t.total, 0)) * 100 "
        "AS share_pct FROM b JOIN t USING (periodo)",
        s=SERIES_SQL,
        b=f"SELECT periodo, sexo, {dbl('SUM(v)', 'asegurados')} FROM s GROUP BY 1, 2",
        t="SELECT periodo, SUM(asegurados) AS total FROM b GROUP BY 1",
    ),
)
def share_of_total(spark, sf):
    return series.share_of_total(_series_rows(spark, sf, "sexo", payroll=False), "ta")


_LAST = "SELECT MAX(periodo) AS periodo FROM s"


@query(
    "latest_snapshot",
    over(
        "norm",
        f"SELECT periodo, cve_entidad, sexo, {dbl('SUM(v)', 'asegurados')} FROM s "
        "JOIN l USING (periodo) GROUP BY 1, 2, 3",
        s=SERIES_SQL,
        l=_LAST,
    ),
)
def latest_snapshot(spark, sf):
    rows = _series_rows(spark, sf, "cve_entidad", "sexo", payroll=False)
    return series.latest_snapshot(rows, "ta", ["cve_entidad", "sexo"])


@query(
    "sector_snapshot_ratio",
    over(
        "norm",
        f"SELECT periodo, sector_economico_1 AS sector, sexo, {dbl('SUM(v)', 'asegurados')}, "
        "CAST(SUM(m) AS DOUBLE) / NULLIF(CAST(SUM(v) AS DOUBLE), 0) AS salario_prom FROM s "
        "JOIN l USING (periodo) GROUP BY 1, 2, 3 HAVING SUM(v) > 0",
        s=SERIES_SQL,
        l=_LAST,
    ),
)
def sector_snapshot_ratio(spark, sf):
    rows = _series_rows(spark, sf, "sector_economico_1", "sexo")
    return series.sector_snapshot_ratio(rows, "ta", "masa_sal_ta")


_TOP = (
    f"SELECT cve_entidad, {dbl('SUM(v)', 'asegurados')} FROM s JOIN l USING (periodo) "
    "GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS LAST LIMIT 15"
)


@query("top_k_entities", over("norm", _TOP, s=SERIES_SQL, l=_LAST))
def top_k_entities(spark, sf):
    return series.top_k_entities(_series_rows(spark, sf, "cve_entidad", payroll=False), "ta")


@query(
    "top_k_semi_join",
    over(
        "norm",
        f"SELECT periodo, cve_entidad, sexo, {dbl('SUM(v)', 'asegurados')} FROM s "
        "JOIN l USING (periodo) WHERE cve_entidad IN (SELECT cve_entidad FROM t) GROUP BY 1, 2, 3",
        s=SERIES_SQL,
        l=_LAST,
        t=_TOP,
    ),
)
def top_k_semi_join(spark, sf):
    rows = _series_rows(spark, sf, "cve_entidad", "sexo", payroll=False)
    return series.top_k_rows(rows, "ta")
