"""Audit and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubeloom.functions.text import WHITESPACE
from cubeloom.operators import audit as A
from cubeloom.operators import profile as PR
from cubeloom.operators.history import distinct_keys
from cubeloom.operators.normalize import cube_rows
from cubeloom.spec import DEFAULT_SPEC as SPEC
from cubeloom.workload.cube_queries import P, _SBC, rows_with
from cubeloom.workload.oracle import big, dbl, listed, over, sums
from cubeloom.workload.registry import ORACLES, query
from cubeloom.workload.star_cube import quoted as q
from cubeloom.workload.star_cube import star_cube, table

# ---------------------------------------------------------------- summaries


def _audited(spark, sf):
    """Rows with a stored ratio: 0 without paid jobs, and off by a half on third lines.

    All 17 measures are there; a report scans only those it sums.
    """
    raw = star_cube(spark, sf, (P, "ptpd", *SPEC.measures))
    stored = F.when(F.col("ta_sal") == 0, 0.0).otherwise(
        F.col("masa_sal_ta") / F.nullif(F.col("ta_sal"), F.lit(0.0))
        + F.when(F.col("no_trabajadores") == 3, 0.5).otherwise(0.0)
    )
    return raw.withColumn("sbc_total", stored)


def _rollup(spark, sf):
    return A.audit_rollup(_audited(spark, sf))


_ROLES = ("asegurados", "no_trabajadores", "ta", "ta_sal", "masa_sal_ta")


@query(
    "audit_summary_general",
    over(
        "raw",
        f"""SELECT {big("count(*)", "filas")}, {big(f'count(DISTINCT "{P}")', "periodos")},
        MIN("{P}") AS periodo_min, MAX("{P}") AS periodo_max, {sums(_ROLES)},
        {_SBC} AS sbc_total_calculado FROM raw""",
    ),
)
def audit_summary_general(spark, sf):
    return A.summary_general(_rollup(spark, sf))


@query(
    "audit_summary_by_period",
    over(
        "raw",
        f'SELECT "{P}", {big("count(*)", "filas")}, {sums(_ROLES)}, '
        f"{_SBC} AS sbc_total_calculado FROM raw GROUP BY 1",
    ),
)
def audit_summary_by_period(spark, sf):
    return A.summary_by_period(_rollup(spark, sf))


def _composition_sql(whole, parts, names, diff):
    pu, pc, tu, tc = (f"coalesce({p}, 0)" for p in parts)
    pairs = ((pu, pc), (tu, tc), (pu, tu), (pc, tc))
    columns = ", ".join(dbl(f"SUM({a} + {b})", n) for (a, b), n in zip(pairs, names))
    gap = dbl(f"SUM({whole}) - SUM({pu} + {pc} + {tu} + {tc})", diff)
    return over("raw", f'SELECT "{P}", {columns}, {gap} FROM raw GROUP BY 1')


@query(
    "audit_job_composition",
    _composition_sql(
        "ta", SPEC.job_parts, tuple(SPEC.derived_sums)[:4], "diff_ta_componentes"
    ),
)
def audit_job_composition(spark, sf):
    return A.job_composition(_rollup(spark, sf))


@query(
    "audit_payroll_composition",
    _composition_sql(
        "masa_sal_ta",
        SPEC.payroll_parts,
        tuple(SPEC.derived_sums)[4:],
        "diff_masa_sal_componentes",
    ),
)
def audit_payroll_composition(spark, sf):
    return A.payroll_composition(_rollup(spark, sf))


@query(
    "audit_flag_distribution",
    over(
        "raw",
        f"""SELECT ptpd, {big("count(*)", "filas")}, {dbl("SUM(ta)", "puestos")},
        {dbl("SUM(ta_sal)", "puestos_con_salario")}, {dbl("SUM(masa_sal_ta)", "masa_sal_ta")}
        FROM raw GROUP BY 1""",
    ),
)
def audit_flag_distribution(spark, sf):
    return A.flag_distribution(_rollup(spark, sf))


@query(
    "audit_flag_ratio",
    over(
        "raw",
        f"""SELECT "{P}", {dbl("SUM(ta)", "puestos_ptpd_1")},
        {dbl("SUM(ta_sal)", "puestos_con_salario_ptpd_1")},
        {dbl("SUM(masa_sal_ta)", "masa_sal_ta_ptpd_1")}, {_SBC} AS sbc_plataformas
        FROM raw WHERE ptpd = '1' GROUP BY 1""",
    ),
)
def audit_flag_ratio(spark, sf):
    return A.flag_ratio_by_period(_rollup(spark, sf))


@query(
    "audit_flag_ratio_rounded",
    over(
        "raw",
        f"""SELECT "{P}", {dbl("SUM(ta)", "puestos_ptpd_1")},
        {dbl("SUM(ta_sal)", "puestos_con_salario_ptpd_1")},
        {dbl("SUM(masa_sal_ta)", "masa_sal_ta_ptpd_1")}, ROUND({_SBC}, 1) AS sbc_plataformas
        FROM raw WHERE ptpd = '1' GROUP BY 1""",
    ),
)
def audit_flag_ratio_rounded(spark, sf):
    return A.flag_ratio_by_period(_rollup(spark, sf), decimals=1)


@query(
    "audit_ratio_validation",
    over(
        "raw",
        f"""SELECT {big("count(*)", "filas_revisadas")},
        {big("SUM(CASE WHEN d = 0 AND stored IS NOT NULL THEN 1 ELSE 0 END)",
             "filas_con_sbc_y_denominador_cero")},
        MAX(ABS(stored - n / NULLIF(d, 0))) AS max_diff_sbc_total,
        {_SBC} AS sbc_total_calculado FROM a""",
        a="""SELECT *, CAST(masa_sal_ta AS DOUBLE) AS n, CAST(ta_sal AS DOUBLE) AS d,
        CASE WHEN ta_sal = 0 THEN 0.0 ELSE CAST(masa_sal_ta AS DOUBLE) / CAST(ta_sal AS DOUBLE)
        + CASE WHEN no_trabajadores = 3 THEN 0.5 ELSE 0.0 END END AS stored FROM raw""",
    ),
)
def audit_ratio_validation(spark, sf):
    return A.ratio_validation(_rollup(spark, sf))


def _deep_audit_sql() -> str:
    """The reports above, as one long table."""
    reports = {
        "summary_general": ("audit_summary_general", None),
        "summary_by_period": ("audit_summary_by_period", P),
        "job_composition_by_period": ("audit_job_composition", P),
        "salary_composition_by_period": ("audit_payroll_composition", P),
        "sbc_validation": ("audit_ratio_validation", None),
        "ptpd_distribution": ("audit_flag_distribution", "ptpd"),
        "ptpd_sbc_by_period": ("audit_flag_ratio", P),
    }

    def stacked(report: str, name: str, key: str | None) -> str:
        drop = [c for c in (key, *(("periodo_min", "periodo_max") if key is None and name.endswith("general") else ())) if c]
        without = f" EXCLUDE ({listed(drop)})" if drop else ""
        clave = f"coalesce({q(key)}, '')" if key else "''"
        return f"""SELECT '{report}' AS reporte, clave, metrica, valor FROM (UNPIVOT (
        SELECT {clave} AS clave, CAST(COLUMNS(*{without}) AS DOUBLE) FROM ({ORACLES[name]}))
        ON COLUMNS(* EXCLUDE (clave)) INTO NAME metrica VALUE valor)"""

    return " UNION ALL ".join(stacked(r, n, k) for r, (n, k) in reports.items())


@query("deep_audit", _deep_audit_sql())
def deep_audit(spark, sf):
    """Seven reports from one scan."""
    return A.long_report(A.deep_audit(_audited(spark, sf)))


# ---------------------------------------------------------------- keys


def repeated_rows(rows):
    """Rows with more than 45 jobs come twice: the cube itself has few duplicate keys."""
    return rows.unionByName(rows.filter("ta > 45"))


def _keyed(spark, sf):
    return repeated_rows(rows_with(spark, sf, SPEC.keys, ("ta",)))


_REPEATED = {"u": "SELECT * FROM norm UNION ALL SELECT * FROM norm WHERE ta > 45"}
_GROUPS = {"g": f"SELECT count(*) AS cnt FROM u GROUP BY {listed(SPEC.keys)} HAVING count(*) > 1"}


@query(
    "audit_duplicate_keys",
    over(
        "norm",
        f"SELECT 'ok' AS status, '' AS missing_key_columns, "
        f"{big('count(*)', 'llaves_duplicadas')}, {big('SUM(cnt - 1)', 'filas_excedentes')} FROM g",
        **_REPEATED,
        **_GROUPS,
    ),
)
def audit_duplicate_keys(spark, sf):
    return A.duplicate_keys(_keyed(spark, sf))


@query(
    "duplicate_rows_in_groups",
    over(
        "norm",
        f"SELECT {big('coalesce(SUM(cnt), 0)', 'rows_in_duplicate_groups')}, "
        f"{big('count(*)', 'duplicate_groups')} FROM g",
        **_REPEATED,
        **_GROUPS,
    ),
)
def duplicate_rows_in_groups(spark, sf):
    return A.duplicate_rows_in_groups(_keyed(spark, sf))


@query(
    "distinct_keys",
    over(
        "norm",
        f"SELECT {P}, {big('SUM(n)', 'filas')}, {big('count(*)', 'llaves_distintas')} FROM g GROUP BY 1",
        **_REPEATED,
        g=f"SELECT {P}, count(*) AS n FROM u GROUP BY {listed(SPEC.keys)}",
    ),
)
def distinct_keys_query(spark, sf):
    return distinct_keys(_keyed(spark, sf))


@query(
    "light_period_audit",
    over(
        "norm",
        f"""SELECT d AS periodo, {big("SUM(cnt)", "filas")},
        CASE WHEN count(*) = 0 THEN '' WHEN bool_or(found <> d) OR SUM(dup) > 0 OR SUM(inf) > 0
             THEN 'failed' ELSE 'success' END AS status,
        concat_ws(';',
          CASE WHEN bool_or(found <> d) THEN 'unexpected_periods:'
               || string_agg(DISTINCT found, ',' ORDER BY found) END,
          CASE WHEN SUM(dup) > 0 THEN 'duplicate_analytic_keys:' || CAST(SUM(dup) AS BIGINT) END,
          CASE WHEN SUM(inf) > 0 THEN 'infinite_sbc:sbc_total' END) AS errors
        FROM g GROUP BY d
        UNION ALL SELECT '1994-12-31', 0, 'failed', 'empty_dataframe'""",
        u=f"""SELECT *, {P} AS d FROM norm
        UNION ALL SELECT *, {P} AS d FROM norm WHERE ta > 49 AND {P} LIKE '1998-0%'
        UNION ALL SELECT *, '1999-12-31' AS d FROM norm WHERE {P} = '1999-11-30'""",
        g=f"""SELECT d, {P} AS found, count(*) AS cnt,
        CASE WHEN count(*) > 1 THEN count(*) ELSE 0 END AS dup,
        count(*) FILTER (WHERE ta_sal = 0 AND {P} LIKE '2000-%') AS inf
        FROM u GROUP BY d, {listed(SPEC.keys)}""",
    ),
)
def light_period_audit(spark, sf):
    """Deliveries with repeated keys in 1998, a foreign month in 1999 and infinite ratios in 2000."""
    rows = cube_rows(star_cube(spark, sf)).drop(*SPEC.derived_sums)
    ratio = F.when(
        (F.col("ta_sal") == 0) & F.col(P).startswith("2000-"), F.lit(float("inf"))
    ).otherwise(F.col("masa_sal_ta") / F.nullif(F.col("ta_sal"), F.lit(0.0)))
    rows = rows.withColumns({"sbc_total": ratio, "declared": F.col(P)})
    twice = rows.filter((F.col("ta") > 49) & F.col(P).startswith("1998-0"))
    foreign = rows.filter(F.col(P) == "1999-11-30").withColumn("declared", F.lit("1999-12-31"))
    expected = star_cube(spark, sf, (P,)).select(F.col(P).alias("declared")).unionByName(
        spark.range(1).select(F.lit("1994-12-31").alias("declared"))
    )
    delivered = rows.unionByName(twice).unionByName(foreign)
    return A.light_period_audit(delivered, expected, "declared")


# ---------------------------------------------------------------- values


@query(
    "top_values_per_column",
    over(
        "norm",
        "SELECT column_name, value, filas, ta, rank FROM ("
        "SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY filas DESC, "
        "value ASC NULLS FIRST) AS INTEGER) AS rank FROM v) WHERE rank <= 50",
        v=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {q(c)} AS value, {big('count(*)', 'filas')}, "
            f"{dbl('SUM(ta)', 'ta')} FROM norm GROUP BY 2"
            for c in SPEC.top_value_columns
        ),
    ),
)
def top_values_per_column(spark, sf):
    return A.top_values(rows_with(spark, sf, SPEC.top_value_columns, ("ta",)))


@query(
    "check_accepted_values",
    over(
        "raw",
        f"SELECT 'ptpd' AS column_name, f AS value, {big('count(*)', 'filas')} FROM ("
        "SELECT CASE WHEN no_trabajadores = 6 THEN 'x' || rango_salarial ELSE ptpd END AS f FROM raw) "
        "WHERE f NOT IN ('0', '1', 'no_disponible', 'no_aplica') GROUP BY 2 "
        f"UNION ALL SELECT 'status', o_orderstatus, {big('count(*)', 'filas')} FROM orders "
        "WHERE o_orderstatus NOT IN ('pending', 'loaded') GROUP BY 2",
    ),
)
def check_accepted_values(spark, sf):
    """Sixth lines carry illegal flags; order statuses are none of the control statuses."""
    raw = star_cube(spark, sf, ("ptpd", "rango_salarial", "no_trabajadores"))
    odd = F.when(
        F.col("no_trabajadores") == 6, F.concat(F.lit("x"), F.col("rango_salarial"))
    ).otherwise(F.col("ptpd"))
    flags = A.accepted_values(raw.select(odd.alias("ptpd")), "ptpd", SPEC.flag_values)
    orders = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"))
    return flags.unionByName(A.accepted_values(orders, "status", SPEC.control_statuses))


_BLANKS = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


@query(
    "whitespace_audit",
    f"""SELECT text AS value, trim(text, b) AS valor_limpio, {big("length(text)", "longitud")},
    text <> ltrim(text, b) AS espacios_inicio, text <> rtrim(text, b) AS espacios_fin,
    contains(text, chr(10)) OR contains(text, chr(13)) AS saltos_linea,
    contains(text, chr(9)) AS tabulaciones, text = '' AS es_vacio, {big("count(*)", "conteo")}
    FROM documents, (SELECT {_BLANKS} AS b) WHERE text IS NOT NULL GROUP BY text, b""",
)
def whitespace_audit(spark, sf):
    return A.whitespace_audit(table(spark, sf, "documents"), "text")


_MARKS = ("espacios_inicio", "espacios_fin", "saltos_linea", "tabulaciones", "es_vacio")


@query(
    "whitespace_totals",
    f"""SELECT {big("count(*)", "valores_unicos")},
    {big("count(DISTINCT c)", "valores_unicos_limpios")},
    {", ".join(big(f"count(*) FILTER (WHERE {m})", m) for m in _MARKS)} FROM (
    SELECT DISTINCT m AS v, trim(m, ' ') AS c, m <> ltrim(m, ' ') AS espacios_inicio,
    m <> rtrim(m, ' ') AS espacios_fin, false AS saltos_linea, false AS tabulaciones,
    m = '' AS es_vacio FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN ' ' || c_name
    WHEN c_custkey % 7 = 1 THEN c_mktsegment || '  ' WHEN c_custkey % 7 = 2 THEN ''
    ELSE c_mktsegment END AS m FROM customer))""",
)
def whitespace_totals(spark, sf):
    key = F.col("c_custkey") % 7
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    value = (
        F.when(key == 0, F.concat(F.lit(" "), name))
        .when(key == 1, F.concat(segment, F.lit("  ")))
        .when(key == 2, "")
        .otherwise(segment)
    )
    customers = table(spark, sf, "customer").select(value.alias("m"))
    return A.whitespace_totals(A.whitespace_audit(customers, "m"))


# ---------------------------------------------------------------- profiles

_PROFILED = (P, *SPEC.raw_dims)


@query(
    "profile_nulls",
    over(
        "raw",
        "SELECT columna, null_count FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS columna, {big(f'count(*) - count({q(c)})', 'null_count')} FROM raw"
            for c in (*_PROFILED, *SPEC.measures)
        )
        + ") ORDER BY null_count DESC, columna LIMIT 15",
    ),
)
def profile_nulls(spark, sf):
    return PR.null_counts(star_cube(spark, sf), top=15)


_COLUMN_NUMBERS = ("ta", "masa_sal_ta", "tpu")


def _profile_columns_sql() -> str:
    def text_column(c: str) -> str:
        return f"""SELECT '{c}' AS columna, {big(f"count(*) - count({q(c)})", "valores_nulos")},
        ROUND((count(*) - count({q(c)})) * 1.0 / count(*) * 100, 2) AS porcentaje_nulos,
        {big(f"count(DISTINCT {q(c)})", "nunique_raw")},
        {big("count(DISTINCT n)", "nunique_normalizado")},
        {big(f"count(DISTINCT {q(c)}) - count(DISTINCT n)", "valores_fantasma")},
        (SELECT string_agg(coalesce(n, '<null>') || '=' || k, '; ' ORDER BY k DESC, n NULLS FIRST)
         FROM (SELECT n, count(*) AS k FROM (SELECT CASE WHEN upper(trim({q(c)}))
         NOT IN ('', 'NAN', 'NONE') THEN upper(trim({q(c)})) END AS n FROM raw) GROUP BY n
         ORDER BY k DESC, n NULLS FIRST LIMIT 5)) AS top_valores,
        {big("0", "no_finitos")},
        CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS media
        FROM (SELECT {q(c)}, CASE WHEN upper(trim({q(c)})) NOT IN ('', 'NAN', 'NONE')
        THEN upper(trim({q(c)})) END AS n FROM raw)"""

    def number_column(c: str) -> str:
        return f"""SELECT '{c}', {big(f"count(*) - count({c})", "a")},
        ROUND((count(*) - count({c})) * 1.0 / count(*) * 100, 2),
        {big(f"count(DISTINCT {c})", "b")}, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), NULL,
        {big("0", "z")},
        {dbl(f"MIN({c})", "d")}, {dbl(f"MAX({c})", "e")},
        ROUND(CAST(SUM({c}) AS DOUBLE) / count({c}), 2) FROM raw"""

    parts = [text_column(c) for c in _PROFILED] + [number_column(c) for c in _COLUMN_NUMBERS]
    return over("raw", " UNION ALL ".join(parts))


@query("profile_columns", _profile_columns_sql())
def profile_columns(spark, sf):
    return PR.column_profile(star_cube(spark, sf, (*_PROFILED, *_COLUMN_NUMBERS)))


_TABLE_COLUMNS = (P, *SPEC.raw_dims, *SPEC.measures)
_TABLE_NULLS = " + ".join(f"CASE WHEN {q(c)} IS NULL THEN 1 ELSE 0 END" for c in _TABLE_COLUMNS)


@query(
    "profile_table",
    over(
        "raw",
        f"""SELECT {big("SUM(n)", "total_registros")}, {big(str(len(_TABLE_COLUMNS)), "total_columnas")},
        {big("SUM(n - 1)", "registros_duplicados")},
        {big(f"SUM(n * ({_TABLE_NULLS}))", "valores_nulos_total")} FROM g""",
        g=f"SELECT {listed(_TABLE_COLUMNS)}, count(*) AS n FROM raw GROUP BY {listed(_TABLE_COLUMNS)}",
    ),
)
def profile_table(spark, sf):
    return PR.table_profile(star_cube(spark, sf, _TABLE_COLUMNS))


@query(
    "duplicated_rows",
    over(
        "raw",
        f"SELECT {listed((P, *SPEC.raw_dims))}, {listed(SPEC.measures, 'CAST({0} AS DOUBLE) AS {0}')} "
        f"FROM (SELECT *, count(*) OVER (PARTITION BY {listed(_TABLE_COLUMNS)}) AS n "
        "FROM (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE no_trabajadores = 6)) WHERE n > 1",
    ),
)
def duplicated_rows(spark, sf):
    """Rows of all columns; sixth lines are delivered twice."""
    rows = star_cube(spark, sf, _TABLE_COLUMNS)
    return PR.duplicated_rows(rows.unionByName(rows.filter("no_trabajadores = 6")))


_COUNTED = ("cve_entidad", "sexo", "rango_edad", "sector_economico_1", "rango_uma")


@query(
    "value_counts_pct",
    over(
        "raw",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS columna, {q(c)} AS valor, {big("count(*)", "cantidad")},
            CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM raw) * 100 AS porcentaje
            FROM raw WHERE {q(c)} IS NOT NULL GROUP BY 2"""
            for c in _COUNTED
        ),
    ),
)
def value_counts_pct(spark, sf):
    return PR.value_counts(star_cube(spark, sf, _COUNTED), list(_COUNTED))


@query(
    "value_counts_top3",
    over(
        "raw",
        "SELECT columna, valor, cantidad, porcentaje, rank FROM (SELECT *, CAST(row_number() OVER "
        "(PARTITION BY columna ORDER BY cantidad DESC, valor) AS INTEGER) AS rank FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS columna, {q(c)} AS valor, {big("count(*)", "cantidad")},
            CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM raw) * 100 AS porcentaje
            FROM raw WHERE {q(c)} IS NOT NULL GROUP BY 2"""
            for c in _COUNTED
        )
        + ")) WHERE rank <= 3",
    ),
)
def value_counts_top3(spark, sf):
    return PR.value_counts(star_cube(spark, sf, _COUNTED), list(_COUNTED), k=3)


_SOURCE_DIMS = (P, "ptpd", "rango_edad", "cve_municipio", "sector_economico_4", "sexo")
_SOURCE_NUMBERS = ("ta", "masa_sal_ta")
_BAD_JOBS = "CASE WHEN no_trabajadores = 5 THEN 'n/d' WHEN no_trabajadores = 6 THEN ' ' ELSE {} END"


def _source_profile_sql() -> str:
    def dim(c: str) -> str:
        v = f"coalesce(trim({q(c)}), '')"
        return f"""SELECT '{c}' AS columna,
        {big(f"count(*) FILTER (WHERE {v} <> '')", "non_empty_count")},
        {big(f"count(*) FILTER (WHERE {v} = '')", "empty_count")},
        {big(f"count(DISTINCT nullif({v}, ''))", "distinct_count")},
        (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {v} AS v FROM raw
         WHERE {v} <> '' ORDER BY v LIMIT 10)) AS sample_values,
        CAST(NULL AS BIGINT) AS numeric_parse_errors, CAST(NULL AS DOUBLE) AS min,
        CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS sum FROM raw"""

    paid = f"""SELECT 'masa_sal_ta', {big("count(masa_sal_ta)", "a")},
    {big("count(*) - count(masa_sal_ta)", "b")}, CAST(NULL AS BIGINT), NULL, {big("0", "c")},
    {dbl("MIN(masa_sal_ta)", "d")}, {dbl("MAX(masa_sal_ta)", "e")},
    {dbl("SUM(masa_sal_ta)", "f")} FROM raw"""
    good = "CASE WHEN no_trabajadores NOT IN (5, 6) THEN ta END"
    number = f"""SELECT 'ta', {big("count(*) FILTER (WHERE no_trabajadores <> 6)", "a")},
    {big("count(*) FILTER (WHERE no_trabajadores = 6)", "b")}, CAST(NULL AS BIGINT), NULL,
    {big("count(*) FILTER (WHERE no_trabajadores = 5)", "c")},
    {dbl(f"MIN({good})", "d")}, {dbl(f"MAX({good})", "e")}, {dbl(f"SUM({good})", "f")} FROM raw"""
    return over("raw", " UNION ALL ".join([*[dim(c) for c in _SOURCE_DIMS], number, paid]))


@query("source_profile", _source_profile_sql())
def source_profile(spark, sf):
    """Text columns of the source; fifth lines carry bad numbers and sixth lines none."""
    raw = star_cube(spark, sf, (*_SOURCE_DIMS, "no_trabajadores", *_SOURCE_NUMBERS))
    jobs = F.expr(_BAD_JOBS.format("CAST(ta AS STRING)"))
    return PR.source_profile(
        raw.withColumn("ta", jobs), list(_SOURCE_DIMS), list(_SOURCE_NUMBERS)
    )
